"""Business rules over raw columns.

The rules deliberately read the text as it arrived, not the cleaned column of
the same name: a negative shipping cost, say, is reported as zero but still
counts in the net amount.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .dates import AsOf, order_date, review_date
from .numbers import MONEY, review_rating, signed_money_or_zero, to_count, to_decimal, too_wide
from .text import has_text


def _certain(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_available(stock: Column, price: Column, lenient: bool = False) -> Column:
    """In stock and priced above zero; a stock too wide for its column is one."""
    stocked = _certain(to_count(stock) > 0) | _certain(too_wide(stock))
    return stocked & _certain(to_decimal(price, lenient=lenient) > 0)


def has_positive_amount(total: Column, lenient: bool = False) -> Column:
    return _certain(has_text(total) & (to_decimal(total, lenient=lenient) > 0))


def net_amount(total: Column, shipping: Column, discount: Column, lenient: bool = False) -> Column:
    """Total plus shipping minus discount; null without a total."""
    net = (
        to_decimal(total, lenient=lenient)
        + signed_money_or_zero(shipping, lenient)
        - signed_money_or_zero(discount, lenient)
    )
    return F.when(has_text(total), net.try_cast(MONEY))


def is_valid_order(total: Column, date: Column, as_of: AsOf, lenient: bool = False) -> Column:
    """A positive total and a readable date that is not in the future."""
    return has_positive_amount(total, lenient) & order_date(date, as_of).isNotNull()


def calculated_subtotal(quantity: Column, price: Column, lenient: bool = False) -> Column:
    """Quantity times price; a written zero quantity stays zero here, and one too wide for
    its column has no subtotal."""
    count = F.when(~_certain(too_wide(quantity)), F.coalesce(to_count(quantity), F.lit(1)))
    amount = to_decimal(price, lenient=lenient)
    amount = F.when(amount >= 0, amount).otherwise(F.lit(0).cast(MONEY))
    return (count * amount).try_cast(MONEY)


def subtotal_matches(
    subtotal: Column, quantity: Column, price: Column, lenient: bool = False
) -> Column:
    gap = F.abs(
        to_decimal(subtotal, lenient=lenient) - calculated_subtotal(quantity, price, lenient)
    )
    return _certain(gap < F.lit(fixed.SUBTOTAL_TOLERANCE))


def is_valid_review(
    rating: Column,
    text: Column,
    date: Column,
    strict_as_of: AsOf | None = None,
) -> Column:
    """Rating 1-5, some text, and a date that is not marked unusable.

    ``strict_as_of`` asks for more: the date must be readable and not in the
    future at that day.
    """
    if strict_as_of is None:
        dated = _certain(date != fixed.UNUSABLE_REVIEW_DATE)
    else:
        dated = review_date(date, strict_as_of).isNotNull()
    return review_rating(rating).isNotNull() & _certain(F.trim(text) != "") & dated
