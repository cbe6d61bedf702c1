"""Bronze to Silver: typed, cleaned, scored and referentially sound tables.

Each fact is one projection and the joins that check its keys; only the customer
table is deduplicated.  Stored facts are not shuffled: their different keys are
checked first, and the rows then meet only the keys that have no parent.  Rows that break a business rule are kept
and flagged.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import canonical, dates, numbers, rules, scores, text
from ..functions.dates import AsOf
from ..operators.dedup import keep_first
from ..operators.referential import keep_referenced, keep_unless_lost
from ..operators.surrogate import with_surrogate_key
from ..schemas import KEYS, SILVER
from ..sources.bronze import Bronze
from ..sources.layers import CatalogLayers, PathLayers, conform, stamped


Columns = dict[str, Column]
# (child, parent, key) -> child rows whose key the parent has
Check = Callable[[DataFrame, DataFrame, str], DataFrame]


def customer_columns(as_of: AsOf) -> Columns:
    c = F.col
    born = dates.birth_date(c("birth_date"))
    return {
        "customer_id": c("customer_id"),
        "full_name": text.clean_name(c("full_name")),
        "email": text.clean_email(c("email")),
        "email_valid": text.is_valid_email(c("email")),
        "phone": text.clean_phone(c("phone")),
        "registration_date": dates.registration_date(c("registration_date")),
        "city": text.sentence_case(c("city")),
        "state": text.state_code(c("state")),
        "country": canonical.country(c("country")),
        "birth_date": born,
        "age": dates.age_in_years(born, as_of),
        "data_quality_score": scores.customer_score(c),
    }


def book_columns(as_of: AsOf, lenient: bool = False) -> Columns:
    c = F.col
    return {
        "book_id": c("book_id"),
        "title": F.trim("title"),
        "author": F.trim("author"),
        "publisher": F.trim("publisher"),
        "publication_year": numbers.valid_year(c("publication_year"), as_of, lenient),
        "isbn": F.trim("isbn"),
        "category": canonical.category(c("category")),
        "price": numbers.non_negative_money(c("price"), lenient),
        "stock_quantity": numbers.count_or_zero(c("stock_quantity")),
        "pages": numbers.positive_count_or(c("pages"), None),
        "language_code": canonical.language(c("language_code")),
        "avg_rating": numbers.catalogue_rating(c("rating"), lenient),
        "is_available": rules.is_available(c("stock_quantity"), c("price"), lenient),
        "data_quality_score": scores.book_score(c, as_of, lenient),
    }


def order_columns(as_of: AsOf, lenient: bool = False) -> Columns:
    c = F.col
    amounts = (c("total_amount"), c("shipping_cost"), c("discount_applied"))
    return {
        "order_id": c("order_id"),
        "customer_id": c("customer_id"),
        "order_date": dates.order_date(c("order_date"), as_of),
        "total_amount": numbers.money_if_present(c("total_amount"), lenient),
        "payment_method": canonical.payment_method(c("payment_method")),
        "order_status": canonical.order_status(c("order_status")),
        "shipping_cost": numbers.money_or_zero(c("shipping_cost")),
        "discount_applied": numbers.money_or_zero(c("discount_applied")),
        "net_amount": rules.net_amount(*amounts, lenient),
        "is_valid_order": rules.is_valid_order(
            c("total_amount"), c("order_date"), as_of, lenient
        ),
        "data_quality_score": scores.order_score(c, lenient),
    }


def item_columns(lenient: bool = False) -> Columns:
    c = F.col
    priced = (c("quantity"), c("unit_price"))
    return {
        "order_item_id": c("order_item_id"),
        "order_id": c("order_id"),
        "book_id": c("book_id"),
        "quantity": numbers.positive_count_or(c("quantity"), 1),
        "unit_price": numbers.non_negative_money(c("unit_price"), lenient),
        "subtotal": numbers.non_negative_money(c("subtotal"), lenient),
        "calculated_subtotal": rules.calculated_subtotal(*priced, lenient),
        "subtotal_matches": rules.subtotal_matches(c("subtotal"), *priced, lenient),
    }


def review_columns(as_of: AsOf, strict_dates: bool = False) -> Columns:
    c = F.col
    read = (c("rating"), c("review_text"), c("review_date"))
    return {
        "review_id": c("review_id"),
        "book_id": c("book_id"),
        "customer_id": c("customer_id"),
        "rating": numbers.review_rating(c("rating")),
        "review_text": F.trim("review_text"),
        "review_date": dates.review_date(c("review_date"), as_of),
        "helpful_count": numbers.count_or_zero(c("helpful_count")),
        "review_length": text.text_length(c("review_text")),
        "is_valid_review": rules.is_valid_review(*read, as_of if strict_dates else None),
    }


def typed(df: DataFrame, columns: Columns, table: str) -> DataFrame:
    """The cleaned columns in the declared types of a Silver table."""
    return conform(df.select([rule.alias(name) for name, rule in columns.items()]), SILVER[table])


def known_orders(raw: DataFrame, customers: DataFrame, keep: Check = keep_referenced) -> DataFrame:
    return keep(raw.where(F.col("order_id").isNotNull()), customers, "customer_id")


def known_items(
    raw: DataFrame, orders: DataFrame, books: DataFrame, keep: Check = keep_referenced
) -> DataFrame:
    """Orders are checked last, which leaves the items partitioned by order."""
    present = raw.where(F.col("order_item_id").isNotNull())
    return keep(keep(present, books, "book_id"), orders, "order_id")


def known_reviews(
    raw: DataFrame, books: DataFrame, customers: DataFrame, keep: Check = keep_referenced
) -> DataFrame:
    present = raw.where(F.col("review_id").isNotNull())
    return keep(keep(present, books, "book_id"), customers, "customer_id")


def customers(raw: DataFrame, as_of: AsOf) -> DataFrame:
    """One cleaned row per customer, the earliest one received."""
    first = keep_first(raw, "customer_id", ["created_at"])
    return typed(first, customer_columns(as_of), "dim_customers")


def books(raw: DataFrame, as_of: AsOf, lenient: bool = False) -> DataFrame:
    """Catalogue; every row with an id is kept."""
    present = raw.where(F.col("book_id").isNotNull())
    return typed(present, book_columns(as_of, lenient), "dim_books")


def orders(
    raw: DataFrame,
    customers: DataFrame,
    as_of: AsOf,
    lenient: bool = False,
    keep: Check = keep_referenced,
) -> DataFrame:
    """Orders of known customers, invalid ones flagged."""
    return typed(known_orders(raw, customers, keep), order_columns(as_of, lenient), "fact_orders")


def order_items(
    raw: DataFrame,
    orders: DataFrame,
    books: DataFrame,
    lenient: bool = False,
    keep: Check = keep_referenced,
) -> DataFrame:
    """Items of known orders and known books."""
    return typed(known_items(raw, orders, books, keep), item_columns(lenient), "fact_order_items")


def reviews(
    raw: DataFrame,
    books: DataFrame,
    customers: DataFrame,
    as_of: AsOf,
    strict_dates: bool = False,
    keep: Check = keep_referenced,
) -> DataFrame:
    """Reviews of known books by known customers."""
    known = known_reviews(raw, books, customers, keep)
    return typed(known, review_columns(as_of, strict_dates), "fact_reviews")


STORED_AS = {
    "customers": "dim_customers",
    "books": "dim_books",
    "orders": "fact_orders",
    "items": "fact_order_items",
    "reviews": "fact_reviews",
}


@dataclass
class Silver:
    """The five Silver tables, each built when first asked for.

    With ``layers`` a table is written once and read back, so that what builds
    on it starts from a stored, correctly sized table and survives the loss of
    an executor.  Without, the tables are views over Bronze.
    """

    bronze: Bronze
    as_of: dt.date
    layers: PathLayers | CatalogLayers | None = None
    layer: str = "silver"
    lenient: bool = False
    strict_review_dates: bool = False
    # With a run time, tables are stored for good: sorted by business key and stamped.
    run_time: dt.datetime | None = None

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        if self.layers is None:
            return df
        if self.run_time is None:
            return self.layers.write(self.layer, name, df)
        return self.layers.write(self.layer, name, stamped(df, self.run_time), order_by=[KEYS[name][1]])

    def _check(self, child: str) -> Check:
        """How rows without a parent are dropped: with ``layers`` the lost keys are stored."""
        if self.layers is None:
            return keep_referenced

        def keep(rows: DataFrame, parent: DataFrame, key: str) -> DataFrame:
            lost = f"{child}_without_{key}"
            return keep_unless_lost(rows, parent, key, partial(self.layers.write, "staging", lost))

        return keep

    @cached_property
    def customers(self) -> DataFrame:
        return self._stored("dim_customers", customers(self.bronze.customers, self.as_of))

    @cached_property
    def books(self) -> DataFrame:
        return self._stored("dim_books", books(self.bronze.books, self.as_of, self.lenient))

    @cached_property
    def orders(self) -> DataFrame:
        check = self._check("fact_orders")
        built = orders(self.bronze.orders, self.customers, self.as_of, self.lenient, check)
        return self._stored("fact_orders", built)

    @cached_property
    def items(self) -> DataFrame:
        check = self._check("fact_order_items")
        built = order_items(self.bronze.items, self.orders, self.books, self.lenient, check)
        return self._stored("fact_order_items", built)

    @cached_property
    def reviews(self) -> DataFrame:
        parents = (self.books, self.customers)
        check = self._check("fact_reviews")
        built = reviews(self.bronze.reviews, *parents, self.as_of, self.strict_review_dates, check)
        return self._stored("fact_reviews", built)

    def is_intact(self) -> bool:
        """Whether every table stored so far can still be read."""
        try:
            for short, table in STORED_AS.items():
                if self.layers is not None and short in self.__dict__:
                    self.layers.read(self.layer, table)
        except AnalysisException:
            return False
        return True

    def tables(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers,
            "books": self.books,
            "orders": self.orders,
            "items": self.items,
            "reviews": self.reviews,
        }


def keyed(table: str, df: DataFrame, run_time: dt.datetime) -> DataFrame:
    """A Silver table as stored for good: surrogate key first, audit columns last."""
    surrogate, business = KEYS[table]
    return stamped(with_surrogate_key(df, surrogate, business), run_time)
