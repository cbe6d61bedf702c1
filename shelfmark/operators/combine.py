"""Stacking of report branches."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_union(parts: Mapping[str, DataFrame], label: str) -> DataFrame:
    """All rows of all parts, each marked with the part's name."""
    marked = [df.select(F.lit(name).alias(label), "*") for name, df in parts.items()]
    return reduce(DataFrame.unionByName, marked)
