"""Canonical values by table, and mergeable distinct counts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import canonical
from shelfmark.operators import bitmaps, mapping
from shelfmark.session import setting

RULES = {
    "country": (canonical.country, ["brasil", " BR ", "Chile", "", None]),
    "category": (canonical.category, ["FICAO", "Ficção", " terror", "Poesia", None]),
    "order_status": (canonical.order_status, ["ENTREGUE ", "em transito", "Devolvido", None]),
    "language_code": (canonical.language, ["PT", "português", " es ", None]),
    "payment_method": (canonical.payment_method, ["cartao", "Cartão de Debito", "cart. credito", "Vale", None]),
}


@pytest.mark.parametrize("field", RULES)
def test_the_table_says_what_the_rules_say(spark, field):
    rule, values = RULES[field]
    df = spark.createDataFrame([(v,) for v in values], f"{field} string")
    got = mapping.with_canonical(df, mapping.known_spellings(spark), field, "clean")
    assert got.columns == [field, "clean"]
    expected = df.select(field, rule(F.col(field)).alias("clean")).collect()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected))


def test_a_spelling_is_added_by_a_row(spark):
    df = spark.createDataFrame([("Brésil",), ("BR",), ("Peru",)], "country string")
    more = spark.createDataFrame([("country", "bresil", "Brasil"), ("country", "BRESIL", "Zz")], mapping.SCHEMA)
    table = mapping.known_spellings(spark).unionByName(more)
    got = {r.country: r.clean for r in mapping.with_canonical(df, table, "country", "clean").collect()}
    assert got == {"Brésil": "Brasil", "BR": "Brasil", "Peru": "Peru"}


def test_a_large_table_is_joined_by_key(spark):
    df = spark.range(100).selectExpr("cast(id as string) AS country")
    table = spark.range(5000).selectExpr("'country' AS field", "cast(id as string) AS spelling", "concat('x', id) AS canonical")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        got = mapping.with_canonical(df, table, "country", "clean")
        assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
        assert got.where("clean = concat('x', country)").count() == 100


def test_sets_of_days_give_the_distinct_keys_of_months(spark):
    rows = [(k, d, f"m{d // 4}") for d in range(12) for k in [*range(d, d + 30), 70_000 + d % 5]] + [(None, 3, "m0")]
    df = spark.createDataFrame(rows, "key long, day int, month string")
    daily = bitmaps.key_sets(df, "key", "day", "month")
    assert daily.agg(F.max(F.octet_length("keys"))).first()[0] == 4096
    got = dict(map(tuple, bitmaps.distinct_keys(daily, "n", "month").collect()))
    assert got == {m: len({k for k, _, n in rows if n == m and k is not None}) for m in ("m0", "m1", "m2")}
    assert bitmaps.distinct_keys(daily, "n").first().n == len({k for k, *_ in rows if k is not None})
