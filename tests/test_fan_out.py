"""Pre-aggregated Gold outputs against the join chains they stand for.

Random Silver tables with hot keys, missing branches, unknown statuses and null
measures; the chains are executed row by row in DuckDB.
"""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pandas as pd
import pytest

from shelfmark.plans import gold, originals
from verification import oracle
from verification.cases import comparable

AS_OF = dt.date(2001, 6, 30)
STATUSES = ["Entregue", "Cancelado", "Processando", None]


def hot(rng: random.Random, prefix: str, n: int) -> str:
    """A key of which number 0 owns about a third of all rows."""
    return f"{prefix}{0 if rng.random() < 0.33 else rng.randrange(n)}"


def random_silver(seed: int) -> dict[str, pd.DataFrame]:
    """Amounts in cents, catalogue ratings in tenths, as the SQL expects."""
    rng = random.Random(seed)
    customers = [
        (f"C{i}", f"N{i}", f"city{i % 3}", "S", rng.choice([None, 30]), None) for i in range(12)
    ]
    books = [
        (f"B{i}", f"T{i % 5}", f"A{i % 4}", rng.choice(["x", "y", None]), rng.choice([None, 1000]),
         rng.choice([None, *range(0, 51)]))
        for i in range(14)
    ]
    orders = []
    for i in range(40):
        total = rng.choice([None, *[rng.randrange(1, 99999) for _ in range(5)]])
        valid = total is not None and rng.random() < 0.8
        date = AS_OF - dt.timedelta(days=rng.randrange(300)) if valid else None
        orders.append(
            (f"O{i}", hot(rng, "C", 11), date, total, rng.choice(["PIX", "Vale"]),
             rng.choice(STATUSES), rng.randrange(999), rng.randrange(999),
             None if total is None else total + rng.randrange(99), valid)
        )
    items = [
        (f"I{i}", hot(rng, "O", 36), hot(rng, "B", 12), rng.randrange(1, 9), rng.randrange(99999))
        for i in range(150)
    ]
    reviews = [
        (f"R{i}", hot(rng, "B", 13), hot(rng, "C", 10), rng.choice([None, 1, 2, 3, 4, 5]),
         rng.randrange(50), rng.randrange(20), rng.random() < 0.7)
        for i in range(90)
    ]
    frame = pd.DataFrame
    return {
        "dim_customers": frame(customers, columns=["customer_id", "full_name", "city", "state", "age", "registration_date"]),
        "dim_books": frame(books, columns=["book_id", "title", "author", "category", "price", "avg_rating"]),
        "fact_orders": frame(orders, columns=["order_id", "customer_id", "order_date", "total_amount", "payment_method", "order_status", "shipping_cost", "discount_applied", "net_amount", "is_valid_order"]),
        "fact_items": frame(items, columns=["order_item_id", "order_id", "book_id", "quantity", "calculated_subtotal"]),
        "fact_reviews": frame(reviews, columns=["review_id", "book_id", "customer_id", "rating", "review_length", "helpful_count", "is_valid_review"]),
    }


TYPES = {
    "dim_customers": "customer_id string, full_name string, city string, state string, age int, registration_date date",
    "dim_books": "book_id string, title string, author string, category string, price decimal(10,2), avg_rating decimal(2,1)",
    "fact_orders": "order_id string, customer_id string, order_date date, total_amount decimal(10,2), payment_method string, order_status string, shipping_cost decimal(10,2), discount_applied decimal(10,2), net_amount decimal(10,2), is_valid_order boolean",
    "fact_items": "order_item_id string, order_id string, book_id string, quantity int, calculated_subtotal decimal(10,2)",
    "fact_reviews": "review_id string, book_id string, customer_id string, rating int, review_length int, helpful_count int, is_valid_review boolean",
}
SCALED = {"price": 2, "avg_rating": 1, "total_amount": 2, "shipping_cost": 2, "discount_applied": 2, "net_amount": 2, "calculated_subtotal": 2}


def to_spark(spark, name, df):
    def value(column, v):
        if v is None or v != v:
            return None
        if column in SCALED:
            return Decimal(int(v)).scaleb(-SCALED[column])
        return int(v) if column in ("age", "quantity", "rating", "review_length", "helpful_count") else v

    rows = [tuple(value(c, v) for c, v in zip(df.columns, r)) for r in df.astype(object).values.tolist()]
    return spark.createDataFrame(rows, TYPES[name])


def duckdb_types(name):
    names = {"string": "VARCHAR", "int": "INTEGER", "date": "DATE", "boolean": "BOOLEAN"}
    for declared in TYPES[name].split(", "):
        column, kind = declared.split()
        yield column, names.get(kind, "BIGINT")


CHAINS = {
    "book_chain": oracle._BOOK_CHAIN,
    "customer_chain": oracle._CUSTOMER_CHAIN,
    "sales_chain": oracle._SALES_CHAIN,
    "place_chain": oracle._PLACE_CHAIN,
    **oracle._AUTHOR_PARTS,
}
CASES = {
    "sales_by_category": (oracle.SALES_BY_CATEGORY, lambda t: gold.sales_by_category(t["fact_items"], t["fact_orders"], t["dim_books"])),
    "top_selling_books": (oracle.TOP_BOOKS, lambda t: gold.top_selling_books(t["dim_books"], t["fact_items"], t["fact_orders"], t["fact_reviews"])),
    "customer_analytics": (oracle.CUSTOMERS, lambda t: gold.customer_analytics(t["dim_customers"], t["fact_orders"], t["fact_items"], t["fact_reviews"], AS_OF)),
    "sales_over_time": (oracle.OVER_TIME, lambda t: gold.sales_over_time(t["fact_orders"], t["fact_items"])),
    "daily_metrics": (oracle._GOLD_TABLES["daily_metrics"], lambda t: gold.daily_metrics(t["fact_orders"], t["fact_items"])),
    "payment_analysis": (oracle.PAYMENTS, lambda t: gold.payment_analysis(t["fact_orders"])),
    "geographic_analysis": (oracle.PLACES, lambda t: gold.geographic_analysis(t["dim_customers"], t["fact_orders"], t["fact_items"])),
    "review_analytics": (oracle.REVIEWED, lambda t: gold.review_analytics(t["dim_books"], t["fact_reviews"])),
    "author_performance": (oracle.AUTHORS, lambda t: gold.author_performance(t["dim_books"], t["fact_items"], t["fact_reviews"])),
}


# First generation: (SQL, chain it replaces, Spark output).
ORIGINALS = {
    "top_selling_books": (oracle.TOP_BOOKS.split("HAVING")[0], {"book_chain": oracle._SOLD_CHAIN},
        lambda t: originals.top_selling_books(t["dim_books"], t["fact_items"], t["fact_orders"], t["fact_reviews"])),
    "geographic_analysis": (
        oracle.PLACES.replace("coalesce(sum(quantity), 0)::BIGINT", "sum(quantity)::BIGINT"),
        {"place_chain": oracle._PLACE_CHAIN + " WHERE o.order_id IS NOT NULL"},
        lambda t: originals.geographic_analysis(t["dim_customers"], t["fact_orders"], t["fact_items"])),
    "customer_analytics": (
        oracle.CUSTOMERS.replace("coalesce(sum(quantity), 0)::DOUBLE", "sum(quantity)::DOUBLE"), {},
        lambda t: originals.customer_analytics(t["dim_customers"], t["fact_orders"], t["fact_items"], t["fact_reviews"], AS_OF)),
    "author_performance": (oracle.AUTHORS, {"author_chain": oracle._VALID_AUTHOR_CHAIN},
        lambda t: originals.author_performance(t["dim_books"], t["fact_items"], t["fact_orders"], t["fact_reviews"])),
}


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in map(tuple, rows)), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_outputs_equal_their_join_chains(spark, seed):
    data = random_silver(seed)
    con = duckdb.connect()
    for name, df in data.items():
        con.register(f"{name}_df", df)
        casts = ", ".join(f"CAST({c} AS {kind}) AS {c}" for c, kind in duckdb_types(name))
        con.execute(f"CREATE TABLE {name} AS SELECT {casts} FROM {name}_df")
    tables = {name: to_spark(spark, name, df).cache() for name, df in data.items()}
    for name, (sql, build) in CASES.items():
        chains = ", ".join(f"{k} AS ({v})" for k, v in CHAINS.items())
        cursor = con.execute(f"WITH {chains} {sql}")
        expected = normal([d[0] for d in cursor.description], cursor.fetchall())
        df = comparable(build(tables))
        assert normal(df.columns, df.collect()) == expected, name
    for name, (sql, changed, build) in ORIGINALS.items():
        chains = ", ".join(f"{k} AS ({v})" for k, v in (CHAINS | changed).items())
        cursor = con.execute(f"WITH {chains} {sql}")
        expected = normal([d[0] for d in cursor.description], cursor.fetchall())
        df = comparable(build(tables))
        assert normal(df.columns, df.collect()) == expected, f"first generation of {name}"
