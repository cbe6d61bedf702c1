"""Dense surrogate keys without passing the table through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoints


def _number_within(df: DataFrame, bucket: str, order: Sequence[Column], name: str) -> DataFrame:
    """1..N over (bucket, order): position in the bucket plus earlier buckets.

    Only one row per bucket is gathered for the running offset.
    """
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(bucket)
        .agg(F.count("*").alias("_size"))
        .select(bucket, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.row_number().over(Window.partitionBy(bucket).orderBy(*order))
    return (
        df.withColumn("_position", position)
        .join(F.broadcast(offsets), bucket)
        .select(
            (F.col("_position") + F.col("_offset")).cast("bigint").alias(name),
            *[c for c in df.columns if c != bucket],
        )
    )


def with_surrogate_key(df: DataFrame, name: str, key: str, buckets: int = 65536) -> DataFrame:
    """Number rows 1..N in a stable order derived from the business key.

    The same rows get the same numbers on every run.  The number of buckets
    bounds both the gathered offsets and the share of the rows in one task.
    """
    ties = [F.col(c) for c in df.columns if c != key]
    hashed = df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    return _number_within(hashed, "_bucket", [F.col(key), *ties], name)


def with_position_key(stored: DataFrame, name: str) -> DataFrame:
    """Number the rows of a stored Parquet table 1..N by their places in its files.

    A row's number is its place in its file plus the rows of the files before it, so no row
    is shuffled; only the files' row counts are gathered, which Parquet keeps.  Where the
    table was written sorted (``order_by``), the numbers follow that order."""
    file = F.col("_metadata.file_path")
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        stored.groupBy(file.alias("_file"))
        .agg(F.count("*").alias("_rows"))
        .select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    return (
        stored.select("*", file.alias("_file"), F.col("_metadata.row_index").alias("_place"))
        .join(files, "_file")
        .select((F.col("_before") + F.col("_place") + 1).alias(name), *stored.columns)
    )


def with_ordered_key(df: DataFrame, name: str, order: Sequence[Column]) -> DataFrame:
    """Number rows 1..N in the stated order.

    Rows are range-partitioned by the order and checkpointed, which fixes the
    partitions; only their sizes are gathered.  ``order`` must be total.
    """
    ensure_checkpoints(df.sparkSession)
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    return _number_within(ranged.checkpoint(), "_range", order, name)
