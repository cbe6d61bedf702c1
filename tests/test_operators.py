"""Operators on small tables, against plain Python."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import aggregates, combine, dedup, ranking, referential, surrogate


def test_keep_first_takes_the_earliest_and_settles_ties(spark):
    rows = [
        ("a", 2, "x"),
        ("a", 1, "z"),
        ("a", 1, "y"),
        ("b", 5, None),
        ("b", 5, "q"),
        (None, 0, "n"),
    ]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    got = {tuple(r) for r in dedup.keep_first(df, "k", ["t"]).collect()}
    assert got == {("a", 1, "y"), ("b", 5, None)}


def test_keep_first_with_a_hot_key_against_brute_force(spark):
    rng = random.Random(4)
    rows = [
        ("hot" if rng.random() < 0.4 else f"k{rng.randrange(50)}", rng.randrange(30), rng.randrange(9))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(8)
    expected = {}
    for k, t, v in rows:
        expected[k] = min(expected.get(k, (99, 99)), (t, v))
    got = {r.k: (r.t, r.v) for r in dedup.keep_first(df, "k", ["t"]).collect()}
    assert got == expected


def test_distinct_rows_and_duplicate_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1)], "k string, v int")
    assert dedup.distinct_rows(df).count() == 4
    assert [tuple(r) for r in dedup.duplicate_keys(df, "k").collect()] == [("a", 3)]


def test_referenced_and_orphan_rows_part_the_table(spark):
    child = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None), ("4", "a")], "id string, k string")
    parent = spark.createDataFrame([("a",), ("a",), ("c",)], "k string")
    kept = referential.keep_referenced(child, parent, "k")
    lost = referential.orphans(child, parent, "k")
    assert sorted(r.id for r in kept.collect()) == ["1", "4"]
    assert sorted(r.id for r in lost.collect()) == ["2", "3"]


def test_surrogate_keys_are_dense_and_repeatable(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    once = surrogate.with_surrogate_key(df, "sk", "k", buckets=16)
    again = surrogate.with_surrogate_key(df.repartition(3), "sk", "k", buckets=16)
    first = {r.k: r.sk for r in once.collect()}
    assert sorted(first.values()) == list(range(1, 5001))
    assert first == {r.k: r.sk for r in again.collect()}


def test_ordered_keys_follow_the_order_with_many_equal_values(spark):
    rng = random.Random(5)
    rows = [(f"n{i}", 0 if rng.random() < 0.4 else rng.randrange(100)) for i in range(2000)]
    df = spark.createDataFrame(rows, "name string, amount int").repartition(8)
    keyed = surrogate.with_ordered_key(df, "id", [F.desc("amount"), F.asc("name")])
    expected = [name for name, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    got = {r.id: r.name for r in keyed.collect()}
    assert [got[i] for i in range(1, 2001)] == expected


def test_ranking(spark):
    rows = [("g", "a", 1), ("g", "b", 3), ("g", "c", 3), ("h", "a", 0), ("h", None, 0)]
    df = spark.createDataFrame(rows, "g string, v string, n int")
    top = ranking.top_per_group(df, ["g"], [F.desc("n"), F.asc_nulls_last("v")])
    assert {(r.g, r.v) for r in top.collect()} == {("g", "b"), ("h", "a")}
    assert [r.v for r in ranking.top_n(df, [F.desc("n"), F.asc("v")], 2).collect()] == ["b", "c"]
    votes = spark.createDataFrame(
        [("g", "a"), ("g", "b"), ("g", "b"), ("h", None), ("h", "z"), ("i", None)], "g string, v string"
    )
    got = {r.g: r.v for r in ranking.most_frequent(votes, "g", "v").collect()}
    assert got == {"g": "b", "h": "z", "i": None}


@pytest.mark.parametrize(
    "amounts, expected",
    [(["135.40", "171.75"], "153.58"), (["0.01", "0.02"], "0.02"), ([None, "1.00"], "1.00"), ([None], None)],
)
def test_means_are_exact_and_round_half_up(spark, amounts, expected):
    df = spark.createDataFrame([(a,) for a in amounts], "a string").select(F.col("a").cast("decimal(10,2)").alias("a"))
    got = df.agg(aggregates.mean(F.col("a"), 2).alias("m")).first().m
    assert (None if got is None else str(got)) == expected


def test_ratio_by_zero_is_null(spark):
    row = spark.range(1).select(aggregates.ratio(F.lit(1), F.lit(0), 2).alias("r")).first()
    assert row.r is None


def test_labelled_union_and_scalar(spark):
    a, b = spark.range(2), spark.range(3)
    counts = {k: df.agg(F.count("*").alias("n")) for k, df in {"a": a, "b": b}.items()}
    assert {tuple(r) for r in combine.labelled_union(counts, "t").collect()} == {("a", 2), ("b", 3)}
    shares = a.select((F.col("id") / aggregates.scalar(counts["b"], "n")).alias("s"))
    assert max(r.s for r in shares.collect()) == pytest.approx(1 / 3)


def test_dates_as_text_or_date(spark):
    from shelfmark.functions.dates import day

    row = spark.range(1).select(day("2024-02-29").alias("a"), day(dt.date(2024, 2, 29)).alias("b")).first()
    assert row.a == row.b == dt.date(2024, 2, 29)


def test_rows_are_kept_by_the_keys_that_are_lost(spark, tmp_path):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, "x"), (5, "x"), (6, "b"), (None, "b")]
    child = spark.createDataFrame(rows, "id int, k string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("unused",)], "k string")
    written = []

    def store(lost):
        lost.write.parquet(f"{tmp_path}/lost{len(written)}")
        written.append(spark.read.parquet(f"{tmp_path}/lost{len(written)}"))
        return written[-1]

    kept = referential.keep_unless_lost(child, parent, "k", store)
    expected = referential.keep_referenced(child, parent, "k")
    in_order = lambda df: sorted(df.select("id", "k").collect(), key=str)
    assert in_order(kept) == in_order(expected) and kept.count() == 5
    assert [r.k for r in written[0].collect()] == ["x"]
    # Whole rows are not shuffled where few keys are lost.
    assert "hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
    none = referential.keep_unless_lost(child, parent.where("k = 'none'"), "k", store)
    assert none.count() == 0
