"""Where the first generation of rules differs from the current one."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from shelfmark.plans import originals, silver
from shelfmark.sources.bronze import rows_as_raw

AS_OF = dt.date(2025, 6, 30)
LOADED = dt.datetime(2025, 6, 1)


def raw(spark, table, *data):
    return rows_as_raw(spark, table, data, LOADED)


def test_customers_whose_rows_differ_stay(spark):
    same = ("C1", "Ana", "a@b.com", "1", "2024-01-01", "x", "sp", "br", "1990-01-01")
    other = ("C1", "Ana", "a@b.com", " ", "soon", "x", "sp", "br", "1990-01-01")
    df = raw(spark, "raw_customers", same, same, other)
    got = originals.customers(df, AS_OF).select("phone", "data_quality_score").collect()
    assert sorted(tuple(r) for r in got) == [("", D("1.00")), ("1", D("1.00"))]
    assert silver.customers(df, AS_OF).count() == 1


def test_books_with_a_misspelt_category_or_a_signed_stock(spark):
    book = ("B1", "T", "A", "P", "2000", "i", "ficao", "1.00", "+3", "10", "pt", "4.0")
    df = raw(spark, "raw_books", book)
    old, new = originals.books(df, AS_OF).first(), silver.books(df, AS_OF).first()
    assert (old.category, old.is_available) == ("ficao", True)
    assert (new.category, new.is_available) == ("Ficção", False)


def test_orders_dated_day_first_are_invalid_and_signed_charges_count(spark):
    customers = raw(spark, "raw_customers", ("C1", *[None] * 8)).select("customer_id")
    df = raw(
        spark,
        "raw_orders",
        ("O1", "C1", "31/01/2024", "5", "pix", "entregue", "+2", "-1"),
        ("O2", "C1", "2024-1-5", "5", "pix", "entregue", "", None),
    )

    def by_id(table):
        return {r.order_id: (r.is_valid_order, r.shipping_cost, r.discount_applied) for r in table.collect()}

    zero = D("0.00")
    assert by_id(originals.orders(df, customers, AS_OF)) == {
        "O1": (False, D("2.00"), zero),
        "O2": (True, zero, zero),
    }
    assert by_id(silver.orders(df, customers, AS_OF)) == {
        "O1": (True, zero, zero),
        "O2": (False, zero, zero),
    }


def test_items_with_unreadable_parts_have_no_computed_subtotal(spark):
    parents = spark.createDataFrame([("O1", "B1")], "order_id string, book_id string")
    df = raw(
        spark,
        "raw_order_items",
        ("I1", "O1", "B1", "two", "5.00", "5.00"),
        ("I2", "O1", "B1", "2", "-5.00", "-10.00"),
    )

    def by_id(table):
        return {r.order_item_id: (r.calculated_subtotal, r.subtotal_matches) for r in table.collect()}

    old = by_id(originals.order_items(df, parents, parents))
    assert old == {"I1": (None, False), "I2": (D("-10.00"), True)}
    new = by_id(silver.order_items(df, parents, parents))
    assert new == {"I1": (D("5.00"), True), "I2": (D("0.00"), False)}


def test_reviews_with_an_unusable_date_were_valid(spark):
    parents = spark.createDataFrame([("B1", "C1")], "book_id string, customer_id string")
    df = raw(spark, "raw_reviews", ("R1", "B1", "C1", "5", "ok", "invalid-date", "1"))
    assert originals.reviews(df, parents, parents, AS_OF).first().is_valid_review
    assert not silver.reviews(df, parents, parents, AS_OF).first().is_valid_review
