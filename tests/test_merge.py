"""Deliveries merged into stored tables, whatever breaks off in between."""

from __future__ import annotations

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from shelfmark.plans import silver
from shelfmark.sources.bronze import rows_as_raw
from shelfmark.streaming import ingest, merge

from . import fixture_rows as rows

SCHEMA = "key string, value string, seen int"


def table_of(spark, path: str) -> list[tuple]:
    df = spark.createDataFrame([], SCHEMA)
    return sorted(map(tuple, merge.read_merged(spark, path, df.schema).collect()))


def files_of(path: str) -> set[str]:
    return set(glob.glob(f"{path}/bucket=*/*.parquet"))


def test_first_by_order_stays_whenever_it_arrives(spark, tmp_path):
    table = str(tmp_path / "t")
    assert table_of(spark, table) == []
    deliveries = [
        [("a", "late", 5), ("b", "only", 1), (None, "nobody", 0), ("a", "later", 6)],
        [("a", "early", 2), ("c", "new", 3), ("b", "again", 9)],
    ]
    for number, arrived in enumerate(deliveries):
        for _ in range(2):  # the whole delivery again changes nothing
            merge.merge_into(spark.createDataFrame(arrived, SCHEMA), number, table, "key", ["seen"], 4)
    assert table_of(spark, table) == [("a", "early", 2), ("b", "only", 1), ("c", "new", 3)]


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = str(tmp_path / "t")
    first = spark.range(200).selectExpr("cast(id as string) key", "'x' value", "1 seen")
    merge.merge_into(first, 0, table, "key", ["seen"], 8)
    before = files_of(table)
    merge.merge_into(spark.createDataFrame([("7", "y", 0)], SCHEMA), 1, table, "key", ["seen"], 8)
    gone, new = before - files_of(table), files_of(table) - before
    assert len(gone) == len(new) == 1 and len(before & files_of(table)) == 7
    assert ("7", "y", 0) in table_of(spark, table) and len(table_of(spark, table)) == 200


def test_a_delivery_that_broke_off_while_replacing(spark, tmp_path, monkeypatch):
    """Buckets are gone, the staged ones are complete: they are put in place."""
    table = str(tmp_path / "t")
    merge.merge_into(spark.createDataFrame([("a", "1", 5), ("b", "1", 5)], SCHEMA), 0, table, "key", ["seen"], 1)
    second = spark.createDataFrame([("b", "2", 1), ("c", "2", 1)], SCHEMA)
    with monkeypatch.context() as patch:
        patch.setattr(merge, "remove", lambda *_: None)
        merge.merge_into(second, 1, table, "key", ["seen"], 1)
    for path in glob.glob(f"{table}/bucket=*/*"):
        (tmp_path / path).unlink()
    merge.merge_into(second, 1, table, "key", ["seen"], 1)
    assert table_of(spark, table) == [("a", "1", 5), ("b", "2", 1), ("c", "2", 1)]


@pytest.mark.parametrize("folder", [False, True])
def test_streamed_customers_equal_the_batch_table(spark, tmp_path, folder):
    raw = rows_as_raw(spark, "raw_customers", rows.CUSTOMERS, rows.LOADED)
    # The same customers again, some hours earlier and with another name.
    again = raw.where("customer_id IN ('CUST001', 'CUST003')").withColumns(
        {"full_name": F.lit("Earlier Name"), "created_at": F.col("created_at") - F.expr("INTERVAL 5 HOURS")}
    )
    inbox, table, progress = (str(tmp_path / n) for n in ("inbox", "dim", "progress"))
    for part in (raw, again, again):
        part.repartition(3 if folder else 1).write.mode("append").parquet(inbox)
        stream = ingest.arriving_customers(ingest.read_stream(spark, raw.schema, inbox), rows.AS_OF)
        merge.merge_available(stream, table, progress, "customer_id", ["arrival"], 4)
    got = merge.read_merged(spark, table, stream.schema).drop("arrival")
    batch = silver.customers(raw.unionByName(again), rows.AS_OF)
    assert got.columns == batch.columns
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()
    assert got.where("full_name = 'Earlier Name'").count() == again.select("customer_id").distinct().count()


EVENTS = "event_id long, ts timestamp, event_type string, value double"


def test_daily_totals_over_restarts_and_late_events(spark, tmp_path):
    inbox, table, progress = (str(tmp_path / n) for n in ("inbox", "daily", "progress"))

    def deliver(*events):
        data = [(k, dt.datetime(2024, 1, day, hour), kind, value) for k, (day, hour, kind, value) in enumerate(events)]
        spark.createDataFrame([*data, (99, None, "click", 1.0)], EVENTS).coalesce(1).write.mode("append").parquet(inbox)
        arriving = ingest.read_stream(spark, spark.read.parquet(inbox).schema, inbox)
        ingest.keep_daily_totals(arriving, "1 day", table, progress)
        stored = merge.read_merged(spark, table, ingest.DAILY_SCHEMA)
        return {
            r.metric_date.day: (r.total_events, r.purchases, str(r.total_value))
            for r in stored.collect()
        }

    got = deliver((1, 5, "click", 1.25), (1, 9, "purchase", 2.5), (3, 8, "view", float("nan")))
    assert got == {1: (2, 1, "3.75"), 3: (1, 0, "None")}
    # In the next delivery day 3 is still open; day 1 was dropped a day after its end.
    got = deliver((3, 1, "purchase", 4.0), (1, 23, "click", 100.0), (6, 1, "click", 1.0))
    assert got == {1: (2, 1, "3.75"), 3: (2, 1, "4.00"), 6: (1, 0, "1.00")}
    assert deliver() == got


def test_closed_days_come_once_when_appended(spark, tmp_path):
    inbox, target, progress = (str(tmp_path / n) for n in ("inbox", "closed", "progress"))
    for day in (1, 2, 5):
        data = [(day, dt.datetime(2024, 1, day, 3), "click", 1.0)]
        spark.createDataFrame(data, EVENTS).write.mode("append").parquet(inbox)
        arriving = ingest.read_stream(spark, spark.read.parquet(inbox).schema, inbox)
        ingest.append_available(ingest.daily_totals(arriving, "1 day"), target, progress)
    assert sorted(r.metric_date.day for r in spark.read.parquet(target).collect()) == [1, 2]
