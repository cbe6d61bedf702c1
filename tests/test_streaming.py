"""Streams give the batch result, once, over several arrivals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shelfmark.plans import silver
from shelfmark.sources.bronze import rows_as_raw
from shelfmark.streaming import ingest

from . import fixture_rows as rows

HEADER = "order_id,customer_id,order_date,total_amount,payment_method,order_status,shipping_cost,discount_applied"


def as_line(row) -> str:
    return ",".join("" if v is None else v for v in row)


def test_orders_arriving_in_two_deliveries(spark, tmp_path):
    inbox, target, progress = (tmp_path / n for n in ("inbox", "orders", "progress"))
    inbox.mkdir()
    customers = silver.customers(
        rows_as_raw(spark, "raw_customers", rows.CUSTOMERS, rows.LOADED), rows.AS_OF
    )

    def run():
        raw = ingest.landed_stream(
            spark, "raw_orders", str(inbox), rows.LOADED, "csv", header="true", emptyValue=""
        )
        ingest.append_available(
            ingest.cleaned_orders(raw, customers, rows.AS_OF), str(target), str(progress)
        )
        return spark.read.parquet(str(target))

    known = [r for r in rows.ORDERS if r[3] != ""]
    stranger = ("ORD999", "C999", "2024-01-01", "5.00", "PIX", "Entregue", "0", "0")
    (inbox / "1.csv").write_text("\n".join([HEADER, *map(as_line, known[:5])]))
    assert run().count() == 5
    (inbox / "2.csv").write_text("\n".join([HEADER, *map(as_line, [*known[5:], stranger])]))
    arrived = run()
    assert run().count() == len(known)  # nothing new, nothing repeated
    batch = silver.orders(
        rows_as_raw(spark, "raw_orders", known, rows.LOADED), customers, rows.AS_OF
    )
    assert arrived.exceptAll(batch).isEmpty() and batch.exceptAll(arrived).isEmpty()


def test_copies_in_a_later_delivery_are_dropped(spark, tmp_path):
    inbox, target, progress = (str(tmp_path / n) for n in ("inbox", "keys", "progress"))
    schema = "customer_id string, full_name string, created_at timestamp"
    start = dt.datetime(2025, 1, 1)

    def deliver(*arrivals):
        data = [(k, n, start + dt.timedelta(hours=h)) for k, n, h in arrivals]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(inbox)

    def run():
        arriving = ingest.read_stream(spark, spark.read.parquet(inbox).schema, inbox)
        kept = ingest.first_arrivals(arriving, "customer_id", "2 days")
        ingest.append_available(kept, target, progress)
        return sorted(tuple(r) for r in spark.read.parquet(target).select("customer_id", "full_name").collect())

    deliver(("a", "first", 0), (None, "no key", 0), ("b", "first", 1))
    assert run() == [("a", "first"), ("b", "first")]
    deliver(("a", "again", 5), ("c", "first", 6))
    assert run() == [("a", "first"), ("b", "first"), ("c", "first")]
    assert spark.read.parquet(target).where(F.col("customer_id").isNull()).isEmpty()
