"""Stored tables that deliveries are merged into, one row per key.

A table is kept in buckets of its key.  A delivery rewrites the buckets that its keys fall
into and no other file.  The merged buckets are staged first, in a folder named by the
delivery's number, and then put in the place of the old ones, so:

* a delivery that broke off while staging is merged again, from untouched buckets;
* one that broke off while replacing is replaced again, from the staged buckets;
* one that is repeated as a whole changes nothing, since which row of a key stays does not
  depend on how often or in what order rows arrive.

Memory and work follow the delivery and the buckets it touches.  Choose so many buckets
that one of them is a few files' worth.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import keep_first
from ..sources.files import exists, is_complete, remove

BUCKETS = 64


def _stored_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])


def read_merged(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The table's present rows; none before the first delivery."""
    if not exists(spark, table):
        return spark.createDataFrame([], schema)
    return spark.read.schema(_stored_schema(schema)).parquet(table).drop("bucket")


def merge_into(
    arrived: DataFrame, number: int, table: str, key: str, order: Sequence[str], buckets: int = BUCKETS
) -> None:
    """Merge a numbered delivery; of each key the first row by ``order`` stays, whether it
    was stored or has just arrived."""
    spark = arrived.sparkSession
    staged = f"{table}_staged/{number}"
    schema = _stored_schema(arrived.schema)
    if not is_complete(spark, staged):
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        rows = keep_first(arrived, key, order).withColumn("bucket", bucket)
        if exists(spark, table):
            # At most one row for each bucket comes to the driver.
            reached = arrived.where(F.col(key).isNotNull()).select(bucket.alias("bucket")).distinct()
            touched = [r.bucket for r in reached.collect()]
            stored = spark.read.schema(schema).parquet(table).where(F.col("bucket").isin(touched))
            rows = keep_first(stored.unionByName(rows), key, order)
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(staged)
    (
        spark.read.schema(schema)
        .parquet(staged)
        .repartition("bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket")
        .parquet(table)
    )
    remove(spark, f"{table}_staged/{number - 1}")


def merge_available(
    stream: DataFrame, table: str, checkpoint: str, key: str, order: Sequence[str],
    buckets: int = BUCKETS, mode: str = "append",
) -> None:
    """Merge everything that has arrived, then stop.  A restart goes on where the last run
    stopped and numbers an unfinished delivery as before."""

    def merge(batch: DataFrame, number: int) -> None:
        merge_into(batch, number, table, key, order, buckets)

    (
        stream.writeStream.foreachBatch(merge)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
