"""Numbers that arrive as text.

Text that is no number reads as null and the rule's fallback applies.  With
``lenient=True`` the leading numeric part is used, or zero where there is none,
which is how permissive SQL servers cast text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .dates import AsOf, day
from .text import has_text

MONEY = "decimal(10,2)"
_LEADING_DIGITS = r"^\s*([0-9]+)"
_LEADING_NUMBER = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+))"


def to_decimal(value: Column, sql_type: str = MONEY, lenient: bool = False) -> Column:
    """Decimal of the given type, or null."""
    if not lenient:
        return value.try_cast(sql_type)
    leading = F.regexp_extract(value, _LEADING_NUMBER, 1).try_cast(sql_type)
    return F.when(value.isNotNull(), F.coalesce(leading, F.lit(0).cast(sql_type)))


def to_count(value: Column) -> Column:
    """Whole number written with digits only, else null.

    A number beyond the declared column's range is null as well; it never
    turns into a rule's default (see ``too_wide``).
    """
    number = F.when(value.rlike(fixed.DIGITS), value.try_cast("bigint"))
    return F.when(number <= fixed.LARGEST_COUNT, number.cast("int"))


def too_wide(value: Column) -> Column:
    """Whether a whole number is written that no count column can hold."""
    return value.rlike(fixed.DIGITS) & to_count(value).isNull()


def valid_year(value: Column, as_of: AsOf, lenient: bool = False) -> Column:
    """Publication year from 1000 up to the year of ``as_of``."""
    text = F.regexp_extract(value, _LEADING_DIGITS, 1) if lenient else value
    year = text.try_cast("int")
    return F.when(year.between(F.lit(fixed.OLDEST_PUBLICATION_YEAR), F.year(day(as_of))), year)


def non_negative_money(value: Column, lenient: bool = False) -> Column:
    """Amount of zero or more; negative or unreadable text is null."""
    amount = to_decimal(value, lenient=lenient)
    return F.when(amount >= 0, amount)


def money_if_present(value: Column, lenient: bool = False) -> Column:
    """Like ``non_negative_money``, but empty text is null even when lenient."""
    return F.when(has_text(value), non_negative_money(value, lenient))


def money_or_zero(value: Column) -> Column:
    """Plainly written unsigned amount, else zero."""
    plain = F.when(value.rlike(fixed.UNSIGNED_DECIMAL), to_decimal(value))
    return F.coalesce(plain, F.lit(0).cast(MONEY))


def signed_money_or_zero(value: Column, lenient: bool = False) -> Column:
    """Amount as written, sign included; missing or empty text is zero."""
    return F.when(has_text(value), to_decimal(value, lenient=lenient)).otherwise(
        F.lit(0).cast(MONEY)
    )


def count_or_zero(value: Column) -> Column:
    """Whole number as written, zero for other text, null for one too wide."""
    return F.when(value.rlike(fixed.DIGITS), to_count(value)).otherwise(F.lit(0))


def positive_count_or(value: Column, default: int | None) -> Column:
    """Whole number above zero, else ``default``; null for one too wide."""
    count = to_count(value)
    other = F.when(~F.coalesce(too_wide(value), F.lit(False)), F.lit(default).cast("int"))
    return F.when(count > 0, count).otherwise(other)


def catalogue_rating(value: Column, lenient: bool = False) -> Column:
    """Catalogue rating 0.0-5.0."""
    rating = to_decimal(value, "decimal(2,1)", lenient)
    return F.when(rating.between(0, 5), rating)


def review_rating(value: Column) -> Column:
    """Reader rating, one of 1-5."""
    rating = to_count(value)
    return F.when(rating.between(1, 5), rating)
