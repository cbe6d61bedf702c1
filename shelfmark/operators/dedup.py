"""Duplicate handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Earliest row per key; rows without a key are dropped.

    Ties on ``order`` are settled by the remaining columns, in schema order.
    Spark limits each key to one row before it shuffles, so a key with very
    many copies costs no more than any other.
    """
    ties = [c for c in df.columns if c != key and c not in order]
    first = Window.partitionBy(key).orderBy(*order, *ties)
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_rn", F.row_number().over(first))
        .where("_rn = 1")
        .drop("_rn")
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows that differ in at least one column."""
    return df.distinct()


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
    )
