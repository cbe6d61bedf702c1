"""Free spellings to canonical values.

Spellings are looked up trimmed, in lower case and without accents, because the
tables being reproduced compare text that way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .choose import first_match
from .text import fold


def canonicalise(
    value: Column,
    spellings: Mapping[str, Sequence[str]],
    otherwise: Column | None = None,
) -> Column:
    """Canonical value for a known spelling, else ``otherwise`` (trimmed input)."""
    folded = fold(value)
    fallback = F.trim(value) if otherwise is None else otherwise
    # The spellings are literals, so folding them is constant-folded away.
    known = [
        (folded.isin([fold(F.lit(v)) for v in variants]), F.lit(name))
        for name, variants in spellings.items()
    ]
    return first_match(known, fallback)


def country(value: Column) -> Column:
    return canonicalise(value, fixed.COUNTRIES)


def category(value: Column) -> Column:
    return canonicalise(value, fixed.CATEGORIES)


def order_status(value: Column) -> Column:
    return canonicalise(value, fixed.STATUSES)


def language(value: Column) -> Column:
    return canonicalise(value, fixed.LANGUAGES, otherwise=F.upper(F.trim(value)))


def payment_method(value: Column) -> Column:
    """Card payments are also recognised by their wildcard shape."""
    folded = fold(value)
    wildcards = [(folded.like(p), F.lit(name)) for name, p in fixed.PAYMENT_WILDCARDS.items()]
    loose = first_match(wildcards, F.trim(value))
    return canonicalise(value, fixed.PAYMENTS, otherwise=loose)
