"""Layer namespaces and table writing.

A layer is a folder below one root, or a database of the session's catalog.
Every write replaces the table, so a run can be repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import setting

LAYERS = ("bronze", "staging", "silver", "gold")


def conform(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Exactly the declared columns, in order, in their declared types."""
    return df.select([F.col(name).cast(kind).alias(name) for name, kind in schema.items()])


def stamped(df: DataFrame, run_time: dt.datetime) -> DataFrame:
    """Add the audit columns of a written table."""
    now = F.lit(run_time).cast("timestamp")
    return df.withColumns({"created_at": now, "updated_at": now})


def sorted_for_writing(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Rows in files that follow each other in the stated order."""
    return df.repartitionByRange(*order_by).sortWithinPartitions(*order_by) if order_by else df


def months_together(df: DataFrame, month: str) -> DataFrame:
    """Rows of a month in few files: small months share a task, large ones are split by
    Spark's own target size."""
    return df.hint("rebalance", month)


class PathLayers:
    """Parquet tables at ``<root>/<layer>/<table>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def location(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def write(
        self, layer: str, table: str, df: DataFrame, partition_by: Sequence[str] = (), order_by: Sequence[str] = ()
    ) -> DataFrame:
        """Replace the table and return it as read back."""
        rows = sorted_for_writing(df, order_by)
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(self.location(layer, table))
        return self.read(layer, table)

    def replace_months(self, layer: str, table: str, df: DataFrame, month: str) -> DataFrame:
        """Replace the months that ``df`` has rows of; the files of others stay as they are."""
        (
            months_together(df, month)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(month)
            .parquet(self.location(layer, table))
        )
        columns = [f for f in df.schema.fields if f.name != month]
        schema = T.StructType([*columns, df.schema[month]])  # a month looks like a date or number
        return self.spark.read.schema(schema).parquet(self.location(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self.location(layer, table))


class CatalogLayers:
    """Tables in one catalog database per layer, e.g. ``silver_layer.fact_orders``.

    New databases are kept in the warehouse, or each in a folder below ``location``."""

    def __init__(self, spark: SparkSession, naming: str = "{layer}_layer", location: str | None = None):
        self.spark = spark
        self.naming = naming
        for layer in LAYERS:
            place = f" LOCATION '{location}/{layer}'" if location else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}{place}")

    def name(self, layer: str, table: str) -> str:
        return f"{self.naming.format(layer=layer)}.{table}"

    def write(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        bucket_by: tuple[int, str] | None = None,
        order_by: Sequence[str] = (),
    ) -> DataFrame:
        """Replace the table.

        ``bucket_by=(n, column)`` stores it hash-bucketed and sorted, so that
        joins of equally bucketed tables on that column need no shuffle.
        """
        writer = sorted_for_writing(df, order_by).write.mode("overwrite").format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket_by:
            count, column = bucket_by
            writer = writer.bucketBy(count, column).sortBy(column)
        writer.saveAsTable(self.name(layer, table))
        return self.read(layer, table)

    def replace_months(self, layer: str, table: str, df: DataFrame, month: str) -> DataFrame:
        """Replace the months that ``df`` has rows of; the files of others stay as they are."""
        name = self.name(layer, table)
        rows = months_together(df, month)
        if self.spark.catalog.tableExists(name):
            with setting(self.spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
                rows.select(self.spark.table(name).columns).write.mode("overwrite").insertInto(name)
        else:
            rows.write.format("parquet").partitionBy(month).saveAsTable(name)
        return self.read(layer, table)

    def store_views(self, layer: str, statements: Mapping[str, str]) -> None:
        """Keep views in the layer's database, where every session finds them."""
        for view, statement in statements.items():
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, view)} AS {statement}")

    def database(self, layer: str) -> str:
        return self.naming.format(layer=layer)

    def publish_keyed(self, layer: str, table: str, key: str) -> None:
        """A stored view ``<table>_keyed`` that numbers the table's rows by their places in
        its files; every session sees it."""
        name = self.name(layer, table)
        self.spark.sql(
            f"""CREATE OR REPLACE VIEW {name}_keyed AS
            SELECT files.before + place + 1 AS {key}, rows.* EXCEPT (file, place)
            FROM (SELECT *, _metadata.file_path AS file, _metadata.row_index AS place FROM {name}) AS rows
            JOIN (SELECT file, coalesce(sum(n) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING
                    AND 1 PRECEDING), 0) AS before
                  FROM (SELECT _metadata.file_path AS file, count(*) AS n FROM {name} GROUP BY ALL)) AS files
            ON rows.file = files.file"""
        )

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))


def publish_views(outputs: Mapping[str, DataFrame]) -> None:
    """Create or replace one session view per output."""
    for name, df in outputs.items():
        df.createOrReplaceTempView(name)
