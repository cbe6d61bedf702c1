"""First-match-wins selection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(branches: Iterable[tuple[Column, Column]], otherwise: Column) -> Column:
    """Value of the first branch whose condition holds, else ``otherwise``.

    One CASE expression, so that Spark evaluates what the conditions share
    only once per row.
    """
    chain = F
    for condition, value in branches:
        chain = chain.when(condition, value)
    return otherwise if chain is F else chain.otherwise(otherwise)
