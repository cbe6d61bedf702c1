"""Customer segmentation and report bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .choose import first_match


def recency_status(
    days: Column,
    bands: Sequence[tuple[int, str]] = fixed.RECENCY_BANDS,
    otherwise: str = fixed.RECENCY_OTHERWISE,
) -> Column:
    """Label of the first band whose day limit is not exceeded."""
    return first_match(((days <= limit, F.lit(label)) for limit, label in bands), F.lit(otherwise))


def spend_tier(
    spent: Column,
    tiers: Sequence[tuple[int, str]] = fixed.SPEND_TIERS,
    otherwise: str = fixed.SPEND_OTHERWISE,
) -> Column:
    """Label of the first tier whose minimum is reached."""
    return first_match(((spent >= low, F.lit(label)) for low, label in tiers), F.lit(otherwise))


def score_band(score: Column) -> Column:
    bands = ((score >= F.lit(low), F.lit(label)) for low, label in fixed.SCORE_BANDS)
    return first_match(bands, F.lit(fixed.SCORE_BAND_OTHERWISE))
