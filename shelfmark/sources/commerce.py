"""The wholesale star-schema tables seen as the five raw feeds.

The tables are clean, so typing is undone and defects of every kind the Silver
rules handle are written in, chosen by arithmetic on the row's own key.  Every
row of every table is used, and no step compares rows with each other except
the key joins that place customers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread
from .bronze import Bronze, as_landed

# Day the derived data is looked at: some order dates lie after it.
AS_OF = dt.date(2001, 6, 30)
LOADED = dt.datetime(2001, 1, 1)

CATEGORY_OF_TYPE = {
    "STANDARD": "Fantasia",
    "ECONOMY": "Ficção",
    "MEDIUM": "Ficção Científica",
    "SMALL": "Romance Clássico",
    "PROMO": "Terror",
}
OTHER_CATEGORY = "Poesia"


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _pick(key: Column, options: list[Column]) -> Column:
    """One of the options, by key modulo their number."""
    index = F.pmod(key, F.lit(len(options)))
    chain = F
    for i, option in enumerate(options[:-1]):
        chain = chain.when(index == i, option)
    return chain.otherwise(options[-1])


def _every(key: Column, n: int) -> Column:
    return F.pmod(key, F.lit(n)) == 0


def _cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def _money_text(cents: str) -> Column:
    """A column of cents as ``units.cc``."""
    return F.concat(
        F.expr(f"{cents} div 100").cast("string"),
        F.lit("."),
        F.lpad(F.expr(f"{cents} % 100").cast("string"), 2, "0"),
    )


def _day_text(day: Column, pattern: str) -> Column:
    return F.date_format(day, pattern)


def raw_customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    placed = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    # Every tenth customer arrives twice; the later row differs.
    arrivals = F.sequence(F.lit(0), F.when(_every(key, 10), 1).otherwise(0))
    rows = placed.withColumn("copy", F.explode(arrivals))
    text_key = key.cast("string")
    place = F.concat_ws(" ", "r_name", "n_name")
    registered = F.date_add(F.lit(dt.date(1994, 1, 1)), F.pmod(key * 37, F.lit(2500)).cast("int"))
    born = F.date_add(F.lit(dt.date(1940, 1, 1)), F.pmod(key * 61, F.lit(22000)).cast("int"))
    address = F.concat(F.lit("customer"), text_key, F.lit("@mail.example.com"))
    phone = F.concat(F.lit("(11) 9"), F.lpad(text_key, 8, "0"))
    seconds = F.pmod(key, F.lit(1000))
    delay = F.when(_every(key, 20), F.lit(0)).otherwise(F.col("copy") * 86400)
    df = rows.select(
        F.when(~_every(key, 211), F.concat(F.lit("C"), text_key)).alias("customer_id"),
        _pick(
            key,
            [
                F.concat(F.lit("  "), F.replace("c_name", F.lit("#"), F.lit("   ")), F.lit(" ")),
                F.col("c_name"),
                F.upper("c_name"),
                F.col("c_name"),
            ],
        ).alias("full_name"),
        _pick(
            key,
            [
                F.lit(""),
                F.concat(F.lit("customer"), text_key, F.lit("@invalid")),
                F.concat(F.lit(" "), F.upper(address), F.lit(" ")),
                F.lit(None).cast("string"),
                address,
                F.upper(address),
                address,
            ],
        ).alias("email"),
        _pick(
            key + F.col("copy"),
            [
                F.lit(None).cast("string"),
                F.lit(""),
                F.lit("  "),
                phone,
                F.concat(phone, F.lit(" ")),
            ],
        ).alias("phone"),
        _pick(
            key,
            [
                _day_text(registered, "yyyy/MM/dd"),
                _day_text(registered, "dd/MM/yyyy"),
                F.lit("not a date"),
                F.lit("1999-02-30"),
                _day_text(registered, "yyyy-MM-dd"),
                _day_text(registered, "yyyy-MM-dd"),
                F.lit(None).cast("string"),
            ],
        ).alias("registration_date"),
        _pick(
            key + F.col("copy"),
            [F.lower(place), F.upper(place), F.concat(F.lit(" "), place, F.lit("  "))],
        ).alias("city"),
        _pick(key, [F.lower("r_name"), F.col("r_name"), F.concat(F.lit(" "), "r_name")]).alias(
            "state"
        ),
        _pick(
            key, [F.lit("brasil"), F.lit(" Brazil "), F.lit("BR"), F.lit("Chile"), F.lit(" Peru")]
        ).alias("country"),
        _pick(
            key,
            [
                _day_text(born, "dd/MM/yyyy"),
                F.lit("unknown"),
                F.lit("29/02/1984"),
                _day_text(born, "yyyy-MM-dd"),
                _day_text(born, "yyyy-MM-dd"),
            ],
        ).alias("birth_date"),
        F.timestamp_seconds(F.unix_seconds(F.lit(LOADED)) + seconds + delay).alias("created_at"),
    )
    return as_landed(df, "raw_customers")


def raw_books(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    text_key = key.cast("string")
    category = F.lit(OTHER_CATEGORY)
    for kind, name in reversed(CATEGORY_OF_TYPE.items()):
        category = F.when(F.col("p_type") == kind, F.lit(name)).otherwise(category)
    price = F.col("price_text")
    priced = part.withColumn("cents", _cents(F.col("p_retailprice"))).withColumn(
        "price_text", _money_text("cents")
    )
    df = priced.select(
        F.concat(F.lit("B"), text_key).alias("book_id"),
        F.concat(F.lit(" "), "p_name", F.lit(" "), text_key).alias("title"),
        F.when(_every(key, 89), F.lit("")).otherwise(F.concat("p_brand", F.lit(" "))).alias(
            "author"
        ),
        F.concat(F.lit("Publisher "), F.pmod("p_size", F.lit(5)).cast("string")).alias(
            "publisher"
        ),
        F.when(_every(key, 23), F.lit("3000"))
        .when(_every(key, 29), F.lit("n/a"))
        .when(_every(key, 31), F.lit("-5"))
        .otherwise((F.pmod(key, F.lit(51)) + 1950).cast("string"))
        .alias("publication_year"),
        F.when(_every(key, 19), F.lit(""))
        .otherwise(F.concat(F.lit("978-"), F.lpad(text_key, 10, "0")))
        .alias("isbn"),
        F.when(_every(key, 17), F.lit("FICAO"))
        .otherwise(
            _pick(key, [F.upper(category), F.lower(category), F.concat(F.lit(" "), category)])
        )
        .alias("category"),
        F.when(_every(key, 50), F.concat(F.lit("-"), price))
        .when(_every(key, 41), F.lit("abc"))
        .when(_every(key, 43), F.lit(""))
        .otherwise(price)
        .alias("price"),
        F.when(_every(key, 37), F.lit("none"))
        .when(_every(key, 113), F.lit("3000000000"))
        .otherwise(F.pmod(key * 7, F.lit(300)).cast("string"))
        .alias("stock_quantity"),
        F.when(_every(key, 47), F.lit("0"))
        .when(_every(key, 59), F.lit("x"))
        .otherwise((F.col("p_size") * 10).cast("string"))
        .alias("pages"),
        _pick(
            key,
            [F.lit(v) for v in ("PT", "pt-br", "Português", "en", "English", " es ")],
        ).alias("language_code"),
        F.when(_every(key, 61), F.lit("bad"))
        .otherwise(
            F.concat(
                F.floor(F.pmod(key, F.lit(60)) / 10).cast("string"),
                F.lit("."),
                F.pmod(key, F.lit(10)).cast("string"),
            )
        )
        .alias("rating"),
        F.lit(LOADED).alias("created_at"),
    )
    return as_landed(df, "raw_books")


def raw_orders(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    priority = F.substring("o_orderpriority", 1, 1)
    by_priority = [
        ("1", ["PIX", " pix", "Pix "]),
        ("2", ["Cartão de Crédito", "cartao de credito", "CARTAO CREDITO"]),
        ("3", ["Cartão de Débito", "cartao debito", "CARTÃO DE DÉBITO"]),
        ("4", ["Boleto", " boleto", "BOLETO"]),
    ]
    payment = _pick(key, [F.lit("cartao"), F.lit("Transferência"), F.lit(" Vale ")])
    for digit, spelled in reversed(by_priority):
        payment = F.when(priority == digit, _pick(key, [F.lit(s) for s in spelled])).otherwise(
            payment
        )
    delivered = [F.lit("ENTREGUE"), F.lit("entregue ")]
    moving = [F.lit("Em Transito"), F.lit("em trânsito")]
    other = [F.lit("processando"), F.lit("CANCELADO"), F.lit("Devolvido")]
    status = (
        F.when(F.col("o_orderstatus") == "F", _pick(key, delivered))
        .when(F.col("o_orderstatus") == "O", _pick(key, moving))
        .otherwise(_pick(key, other))
    )
    df = orders.withColumn("cents", _cents(F.col("o_totalprice"))).select(
        F.concat(F.lit("O"), key.cast("string")).alias("order_id"),
        F.when(_every(key, 97), F.lit("C-unknown"))
        .otherwise(F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
        .alias("customer_id"),
        F.when(_every(key, 33), F.lit("2001-02-30"))
        .when(_every(key, 35), _day_text(day, "yyyyMMdd"))
        .when(F.pmod(key, F.lit(4)) == 1, _day_text(day, "dd/MM/yyyy"))
        .otherwise(_day_text(day, "yyyy-MM-dd"))
        .alias("order_date"),
        F.when(_every(key, 40), F.lit(""))
        .when(_every(key, 53), F.lit(None).cast("string"))
        .when(_every(key, 57), F.lit("-5.00"))
        .when(_every(key, 71), F.lit("abc"))
        .otherwise(_money_text("cents"))
        .alias("total_amount"),
        F.when(_every(key, 83), F.lit("")).otherwise(payment).alias("payment_method"),
        F.when(~_every(key, 101), status).alias("order_status"),
        F.when(_every(key, 11), F.lit(None).cast("string"))
        .when(_every(key, 13), F.lit("-3.00"))
        .when(_every(key, 17), F.lit(""))
        .otherwise(F.concat(F.pmod(key, F.lit(30)).cast("string"), F.lit(".50")))
        .alias("shipping_cost"),
        F.when(_every(key, 19), F.lit("x"))
        .otherwise(F.pmod(key, F.lit(7)).cast("string"))
        .alias("discount_applied"),
        F.lit(LOADED).alias("created_at"),
    )
    return as_landed(df, "raw_orders")


def raw_order_items(lineitem: DataFrame) -> DataFrame:
    order, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    mark = order + line
    # Shared values are columns of their own, so that each is computed once.
    priced = (
        lineitem.withColumns(
            {
                "count": F.col("l_quantity").cast("bigint"),
                "extended": _cents(F.col("l_extendedprice")),
            }
        )
        .withColumn("unit", F.expr("extended div count"))
        .withColumn(
            "line_total", F.expr("unit * count") + F.when(_every(mark, 29), 500).otherwise(0)
        )
        .withColumn("unit_text", _money_text("unit"))
    )
    parts = [order, part, F.col("l_suppkey"), line]
    row_id = F.concat_ws("-", *[p.cast("string") for p in parts])
    df = priced.select(
        F.concat(F.lit("I"), row_id).alias("order_item_id"),
        F.when(_every(order + part, 103), F.lit("O-unknown"))
        .otherwise(F.concat(F.lit("O"), order.cast("string")))
        .alias("order_id"),
        F.when(_every(part + line, 107), F.lit("B-unknown"))
        .otherwise(F.concat(F.lit("B"), part.cast("string")))
        .alias("book_id"),
        F.when(_every(mark, 37), F.lit("0"))
        .when(_every(mark, 41), F.lit("two"))
        .when(_every(mark, 43), F.lit(None).cast("string"))
        .when(_every(mark, 61), F.lit("99999999999"))
        .otherwise(F.col("count").cast("string"))
        .alias("quantity"),
        F.when(_every(mark, 47), F.concat(F.lit("-"), "unit_text"))
        .when(_every(mark, 53), F.lit(""))
        .otherwise(F.col("unit_text"))
        .alias("unit_price"),
        F.when(_every(mark, 59), F.lit("n/a"))
        .otherwise(_money_text("line_total"))
        .alias("subtotal"),
        F.lit(LOADED).alias("created_at"),
    )
    return as_landed(df, "raw_order_items")


def raw_reviews(events: DataFrame) -> DataFrame:
    key = F.col("event_id")
    # Events are stamped 24 years after the orders.
    day = F.add_months(F.col("ts").cast("date"), -288)
    df = events.select(
        F.concat(F.lit("R"), key.cast("string")).alias("review_id"),
        F.when(_every(key, 109), F.lit("B-unknown"))
        .otherwise(F.concat(F.lit("B"), F.floor(key / 5).cast("string")))
        .alias("book_id"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("customer_id"),
        F.when(_every(key, 67), F.lit("five"))
        .otherwise((F.pmod(F.floor("value"), F.lit(8)) - 1).cast("string"))
        .alias("rating"),
        F.when(_every(key, 31), F.lit("   "))
        .when(~_every(key, 37), F.concat(F.lit(" "), "event_type", F.lit(" "), "props"))
        .alias("review_text"),
        F.when(_every(key, 41), F.lit("invalid-date"))
        .when(_every(key, 43), F.lit("2003-01-01"))
        .when(_every(key, 47), F.lit(None).cast("string"))
        .when(_every(key, 45), _day_text(day, "dd/MM/yyyy"))
        .when(_every(key, 5), _day_text(day, "dd-MM-yyyy"))
        .otherwise(_day_text(day, "yyyy-MM-dd"))
        .alias("review_date"),
        F.when(_every(key, 23), F.lit("-1"))
        .when(_every(key, 29), F.lit(""))
        .otherwise(F.pmod(key, F.lit(60)).cast("string"))
        .alias("helpful_count"),
        F.lit(LOADED).alias("created_at"),
    )
    return as_landed(df, "raw_reviews")


def bronze_from(spark: SparkSession, folder: str) -> Bronze:
    """The raw feeds over the tables in a folder."""

    def table(name: str) -> DataFrame:
        return read_table(spark, folder, name)

    return Bronze(
        customers=raw_customers(table("customer"), table("nation"), table("region")),
        books=raw_books(spread(table("part"))),  # few bytes, much work on each row
        orders=raw_orders(table("orders")),
        items=raw_order_items(table("lineitem")),
        reviews=raw_reviews(table("events")),
    )
