"""Dates that arrive in several spellings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .text import matches

AsOf = dt.date | str


def day(value: AsOf) -> Column:
    """A date literal."""
    return F.lit(dt.date.fromisoformat(value) if isinstance(value, str) else value)


def parse_date(
    value: Column,
    shapes: Sequence[fixed.DateShape],
    not_after: AsOf | None = None,
) -> Column:
    """Read the first spelling whose shape fits; null when none does.

    A text of the right shape that is no calendar day is null as well.  With
    ``not_after`` later days are null too.
    """
    parsed = F.coalesce(
        *[F.when(value.rlike(s.shape), F.try_to_date(value, s.pattern)) for s in shapes]
    )
    if not_after is None:
        return parsed
    return F.when(parsed <= day(not_after), parsed)


def has_date_shape(value: Column, shapes: Sequence[fixed.DateShape]) -> Column:
    """True when the text looks like one of the spellings, calendar day or not."""
    return matches(value, "|".join(s.shape for s in shapes))


def registration_date(value: Column) -> Column:
    return parse_date(value, fixed.REGISTRATION_DATES)


def birth_date(value: Column) -> Column:
    return parse_date(value, fixed.BIRTH_DATES)


def order_date(value: Column, as_of: AsOf) -> Column:
    return parse_date(value, fixed.ORDER_DATES, not_after=as_of)


def review_date(value: Column, as_of: AsOf) -> Column:
    return parse_date(value, fixed.REVIEW_DATES, not_after=as_of)


def whole_years(start: Column, end: Column) -> Column:
    """Completed years from one date to another, negative when it lies before.

    Counted in calendar fields, so that no time zone plays a part: a month is
    complete when its day is reached, and twelve of them make a year.
    """
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    days = F.dayofmonth(end) - F.dayofmonth(start)
    unfinished = F.when((months > 0) & (days < 0), 1).when((months < 0) & (days > 0), -1)
    return ((months - F.coalesce(unfinished, F.lit(0))) / 12).cast("int")


def age_in_years(birth: Column, as_of: AsOf) -> Column:
    """Completed years between a birth date and ``as_of``."""
    return whole_years(birth, day(as_of))


def days_since(date: Column, as_of: AsOf) -> Column:
    return F.date_diff(day(as_of), date)


def year_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def month_name(date: Column) -> Column:
    """Full month name, e.g. ``January``."""
    return F.date_format(date, "MMMM")
