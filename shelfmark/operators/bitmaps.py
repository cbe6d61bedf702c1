"""Exact distinct counts that can be merged.

A set of dense keys (see ``surrogate``) is kept as bitmaps, one of fixed size for each bucket
of neighbouring keys.  Stored by day, the sets of any longer period follow by or-ing
those of its days, without the facts and without an error, which neither
counts (of which days share customers) nor sketches allow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_sets(rows: DataFrame, key: str, *period: Column | str) -> DataFrame:
    """The keys met in each period: its columns, ``bucket`` and ``keys``.

    Each task sends a bitmap of 4 KB at most for a period and bucket, however many rows it
    has of them."""
    present = rows.where(F.col(key).isNotNull())
    return present.groupBy(*period, F.bitmap_bucket_number(key).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("keys")
    )


def distinct_keys(sets: DataFrame, name: str, *period: Column | str) -> DataFrame:
    """How many different keys the sets of each period hold together."""
    columns: Sequence[Column] = [F.col(p) if isinstance(p, str) else p for p in period]
    merged = sets.groupBy(*columns, "bucket").agg(F.bitmap_or_agg("keys").alias("keys"))
    names = [c for c in merged.columns if c not in ("bucket", "keys")]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("keys")).alias(name))
