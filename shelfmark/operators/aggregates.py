"""Aggregate expressions that stay exact and never divide by zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wide enough for the total of any fact, also when rows are multiplied by those
# of another, and small enough that a quotient keeps far more digits than are
# ever reported.
TOTAL = "decimal(28,2)"
WHOLE_TOTAL = "decimal(28,0)"


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient; null when the denominator is zero or null."""
    return F.round(numerator / F.nullif(denominator, F.lit(0)), digits)


def total(value: Column) -> Column:
    """Exact sum of amounts."""
    return F.sum(value).cast(TOTAL)


def total_or_zero(value: Column) -> Column:
    return F.coalesce(total(value), F.lit(0).cast(TOTAL))


def mean(value: Column, digits: int) -> Column:
    """Rounded mean of decimal or integer values, computed on exact decimals."""
    return ratio(total(value), F.count(value), digits)


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds; zero, not null, for none."""
    return F.count_if(condition)


def times(value: Column, rows: Column, kind: str = TOTAL) -> Column:
    """A value repeated on ``rows`` rows; wide, since both may be very large."""
    return (value.cast(kind) * rows.cast("decimal(19,0)")).cast(kind)


def scalar(df: DataFrame, column: str) -> Column:
    """The single value of a one-row aggregate, for use in another query."""
    return df.select(column).scalar()
