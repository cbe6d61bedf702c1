"""Continuous landing and cleaning.

The column rules look at one row at a time, so they run on a stream as they
are.  Every function returns a streaming DataFrame until ``append_available``
starts it; progress is kept in the checkpoint folder, so a lost executor or a
restart repeats no row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import AsOf
from ..plans.silver import customer_columns, known_orders, known_reviews, order_columns, review_columns, typed
from ..schemas import SILVER
from ..sources.bronze import as_landed, text_schema
from ..sources.layers import conform
from .merge import merge_available


def read_stream(
    spark: SparkSession, schema: T.StructType, folder: str, format: str = "parquet", **options: str
) -> DataFrame:
    """Files of a folder as they arrive, with a declared schema."""
    return spark.readStream.format(format).schema(schema).options(**options).load(folder)


def landed_stream(
    spark: SparkSession,
    table: str,
    folder: str,
    load_time: dt.datetime,
    format: str = "csv",
    **options: str,
) -> DataFrame:
    """Delivered text files as rows of a raw table."""
    delivered = read_stream(spark, text_schema(table), folder, format, **options)
    return as_landed(delivered, table, load_time)


def first_arrivals(raw: DataFrame, key: str, lateness: str) -> DataFrame:
    """First row to arrive per key, for copies that follow within ``lateness``.

    State is dropped once the watermark passes, so it does not grow with the
    stream.  Unlike the batch rule this keeps the first arrival, which need not
    be the row with the earliest load time.
    """
    present = raw.where(raw[key].isNotNull())
    return present.withWatermark("created_at", lateness).dropDuplicatesWithinWatermark([key])


def cleaned_orders(raw: DataFrame, customers: DataFrame, as_of: AsOf) -> DataFrame:
    """Arriving orders of the customers known so far."""
    return typed(known_orders(raw, customers), order_columns(as_of), "fact_orders")


def cleaned_reviews(
    raw: DataFrame, books: DataFrame, customers: DataFrame, as_of: AsOf
) -> DataFrame:
    """Arriving reviews of known books by known customers."""
    return typed(known_reviews(raw, books, customers), review_columns(as_of), "fact_reviews")


def arriving_customers(raw: DataFrame, as_of: AsOf) -> DataFrame:
    """Arriving customers as Silver rows, and ``arrival``, which orders a customer's rows as
    the batch rule does: by load time, then by the raw columns.

    Merged by it (``merge.merge_into``), the table equals the batch table after every
    delivery, also where the earliest row of a customer arrives last."""
    ties = [c for c in text_schema("raw_customers").names if c != "customer_id"]
    ordered = raw.where(F.col("customer_id").isNotNull()).withColumn("arrival", F.struct("created_at", *ties))
    cleaned = [rule.alias(name) for name, rule in customer_columns(as_of).items()]
    return conform(ordered.select(*cleaned, "arrival"), SILVER["dim_customers"] | {"arrival": ordered.schema["arrival"].dataType})


def daily_totals(events: DataFrame, lateness: str) -> DataFrame:
    """Totals of events (ts, event_type, value) per day of their own time.

    The state holds the days that may still change: a day is dropped from it once an event
    more than ``lateness`` after its end has been seen, and events of dropped days are left
    out.  With the output mode ``update`` every delivery gives the days it changed, with
    ``append`` each day once it can't change any more."""
    amount = F.col("value").try_cast("decimal(18,2)")
    return (
        events.where(F.col("ts").isNotNull())
        .withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 day").alias("day"))
        .agg(
            F.count("*").alias("total_events"),
            F.count_if(F.col("event_type") == "purchase").alias("purchases"),
            F.sum(amount).cast("decimal(28,2)").alias("total_value"),
            F.max("ts").alias("last_event"),
        )
        .select(F.to_date("day.start").alias("metric_date"), "total_events", "purchases", "total_value", "last_event")
    )


DAILY_SCHEMA = T.StructType(
    [
        T.StructField("metric_date", T.DateType()),
        T.StructField("total_events", T.LongType()),
        T.StructField("purchases", T.LongType()),
        T.StructField("total_value", T.DecimalType(28, 2)),
        T.StructField("last_event", T.TimestampType()),
        T.StructField("order", T.LongType()),
    ]
)


def keep_daily_totals(events: DataFrame, lateness: str, table: str, checkpoint: str) -> None:
    """Bring a stored table of daily totals up to date with what has arrived, then stop.

    A day's totals only grow, so of two rows of a day the larger count is the later one."""
    changed = daily_totals(events, lateness).withColumn("order", -F.col("total_events"))
    merge_available(changed, table, checkpoint, "metric_date", ["order"], buckets=8, mode="update")


def append_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Process everything that has arrived into Parquet files, then stop."""
    (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
        .awaitTermination()
    )
