"""Referential checks between tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_referenced(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key exists in the parent.

    No broadcast hint: Spark broadcasts the parent's keys only when their
    measured size is under its limit and otherwise joins by key, splitting
    hot keys of the child.
    """
    return child.join(parent.select(key), key, "left_semi")


def keep_unless_lost(
    child: DataFrame, parent: DataFrame, key: str, store: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The rows of ``keep_referenced``, found by the keys that the parent lacks.

    Only different keys of the child meet the parent; whole rows are compared with
    the lost keys, which ``store`` writes and reads back so that their size is known:
    Spark broadcasts few of them and joins many by key.  The child is read twice.
    """
    present = child.where(F.col(key).isNotNull())
    keys = present.select(key).distinct()
    return present.join(store(orphans(keys, parent, key)), key, "left_anti")


STATUS, KEPT, REJECTED = "status", "kept", "rejected"


def flag_referenced(child: DataFrame, parents: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """All child rows, with ``missing`` (the keys without a parent row) and ``status``.

    A parent row counts once however often its key occurs, so no child row multiplies."""
    flagged, missing = child, []
    for number, (parent, key) in enumerate(parents):
        known = parent.select(key).where(F.col(key).isNotNull()).distinct().withColumn(f"_known{number}", F.lit(True))
        flagged = flagged.join(known, key, "left")
        missing.append(F.when(F.col(f"_known{number}").isNull(), F.lit(key)))
    lost = F.array_compact(F.array(*missing))
    return flagged.select(
        *child.columns, lost.alias("missing"), F.when(F.size(lost) == 0, KEPT).otherwise(REJECTED).alias(STATUS)
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key is missing from the parent."""
    return child.join(parent.select(key), key, "left_anti")
