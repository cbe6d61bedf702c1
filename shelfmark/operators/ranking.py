"""Top rows, overall and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of the stated order; each task keeps only ``n``."""
    return df.orderBy(*order).limit(n)


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int = 1
) -> DataFrame:
    """First ``n`` rows of each group, reduced before the shuffle."""
    ranked = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )


def best_first(score: Column, *columns: str) -> Column:
    """Struct whose minimum is the row of highest score; smaller known values win ties.

    ``min`` of it finds a group's best row in one aggregate, folding each
    task's rows before the shuffle.
    """
    ties = []
    for name in columns:
        ties += [F.col(name).isNull().alias(f"no_{name}"), F.col(name).alias(name)]
    return F.struct((-score).alias("rank"), *ties)


def most_frequent(df: DataFrame, group: str, value: str) -> DataFrame:
    """Most frequent value per group; the smaller known value wins a tie."""
    counted = df.groupBy(group, value).agg(F.count("*").alias("_n"))
    best = F.min(best_first(F.col("_n"), value)).alias("_best")
    return counted.groupBy(group).agg(best).select(group, F.col(f"_best.{value}").alias(value))
