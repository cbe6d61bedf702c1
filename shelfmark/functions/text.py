"""Cleaning of names, contacts and places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed

# Letters compared as their unaccented form when spellings are looked up.
_ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñ"
_PLAIN = "aaaaaeeeeiiiiooooouuuucn"


def clean_name(value: Column) -> Column:
    """Collapse runs of whitespace, then trim."""
    return F.trim(F.regexp_replace(value, r"\s+", " "))


def clean_email(value: Column) -> Column:
    """Lower-case, trimmed address; an empty one becomes null."""
    return F.when(value != "", F.lower(F.trim(value)))


def is_valid_email(value: Column) -> Column:
    """Shape check on the address as it arrived; null counts as invalid."""
    return matches(value, fixed.EMAIL)


def clean_phone(value: Column, blank_to_null: bool = True) -> Column:
    """Trimmed phone; blanks become null unless asked to stay."""
    trimmed = F.trim(value)
    return F.nullif(trimmed, F.lit("")) if blank_to_null else trimmed


def sentence_case(value: Column) -> Column:
    """First letter upper, everything after it lower."""
    trimmed = F.trim(value)
    head = F.substring(trimmed, 1, 1)
    tail = F.substr(trimmed, F.lit(2))
    return F.concat(F.upper(head), F.lower(tail))


def state_code(value: Column) -> Column:
    """Two-letter upper-case code."""
    return F.upper(F.left(F.trim(value), F.lit(2)))


def text_length(value: Column) -> Column:
    """Characters left after trimming."""
    return F.char_length(F.trim(value))


def matches(value: Column, pattern: str) -> Column:
    """Regex test that answers false, never null, for a missing value."""
    return F.coalesce(value.rlike(pattern), F.lit(False))


def has_text(value: Column) -> Column:
    """True when the value is present and not the empty string."""
    return F.coalesce(value != "", F.lit(False))


def fold(value: Column) -> Column:
    """Comparison form of a text: trimmed, lower-case, without accents."""
    return F.translate(F.lower(F.trim(value)), _ACCENTED, _PLAIN)
