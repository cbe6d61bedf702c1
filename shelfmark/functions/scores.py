"""Per-row quality scores between 0.00 and 1.00, from raw columns."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .dates import AsOf, has_date_shape
from .numbers import catalogue_rating, to_decimal, valid_year
from .rules import has_positive_amount
from .text import has_text, is_valid_email

SCORE = "decimal(3,2)"


def quality_score(weighted: Iterable[tuple[Column, Decimal]]) -> Column:
    """Sum of the weights whose condition holds."""
    nothing = F.lit(0).cast(SCORE)
    total = nothing
    for condition, weight in weighted:
        total = total + F.when(condition, F.lit(weight).cast(SCORE)).otherwise(nothing)
    return total.cast(SCORE)


def customer_score(c) -> Column:
    """``c`` maps a raw column name to its Column."""
    rules = [
        has_text(c("customer_id")),
        is_valid_email(c("email")),
        has_text(c("phone")),
        has_date_shape(c("registration_date"), fixed.REGISTRATION_DATES),
        has_date_shape(c("birth_date"), fixed.BIRTH_DATES),
    ]
    return quality_score((rule, fixed.CUSTOMER_WEIGHT) for rule in rules)


def book_score(c, as_of: AsOf, lenient: bool = False) -> Column:
    w = fixed.BOOK_WEIGHT
    return quality_score(
        [
            (c("book_id").isNotNull(), w),
            (has_text(c("title")), w),
            (has_text(c("author")), w),
            (valid_year(c("publication_year"), as_of, lenient).isNotNull(), w),
            (has_text(c("isbn")), fixed.BOOK_ISBN_WEIGHT),
            (to_decimal(c("price"), lenient=lenient) > 0, w),
            (catalogue_rating(c("rating"), lenient).isNotNull(), w),
        ]
    )


def order_score(c, lenient: bool = False) -> Column:
    rules = [
        c("order_id").isNotNull(),
        c("customer_id").isNotNull(),
        has_text(c("order_date")),
        has_positive_amount(c("total_amount"), lenient),
        has_text(c("payment_method")),
    ]
    return quality_score((rule, fixed.ORDER_WEIGHT) for rule in rules)
