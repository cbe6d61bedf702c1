"""First-generation rules and outputs, for results produced before the fixes.

Only what differs from ``silver`` and ``gold`` is here; the first generation of
the other outputs gives the same results as the current one.  Where the old
rules cast text without looking at it first, text that is no number is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import canonical, scores, text
from ..functions import fixed_values as fixed
from ..functions.dates import AsOf, day
from ..functions.numbers import MONEY, to_decimal
from ..operators.aggregates import WHOLE_TOTAL, ratio, times, total
from ..operators.dedup import distinct_rows
from . import gold
from .silver import (
    book_columns,
    customer_columns,
    item_columns,
    known_items,
    known_orders,
    known_reviews,
    order_columns,
    review_columns,
    typed,
)

# The misspelling of this category was not known yet.
CATEGORIES = {**fixed.CATEGORIES, "Ficção": ("ficção", "ficcao")}
# The old date check also took months and days without leading zeros.
_LOOSE_DAY = "yyyy-M-d"


def _whole(value: Column) -> Column:
    return value.try_cast("int")


def _certain(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def customers(raw: DataFrame, as_of: AsOf) -> DataFrame:
    """Distinct cleaned rows: a customer whose rows differ appears several times."""
    c = F.col
    rules = [
        text.has_text(c("customer_id")),
        text.is_valid_email(c("email")),
        text.has_text(c("phone")),
        c("registration_date").isNotNull(),
        c("birth_date").isNotNull(),
    ]
    columns = customer_columns(as_of) | {
        "phone": text.clean_phone(c("phone"), blank_to_null=False),
        "data_quality_score": scores.quality_score((r, fixed.CUSTOMER_WEIGHT) for r in rules),
    }
    present = raw.where(c("customer_id").isNotNull())
    return distinct_rows(typed(present, columns, "dim_customers"))


def books(raw: DataFrame, as_of: AsOf) -> DataFrame:
    """Fewer category spellings; any readable stock number counts."""
    c = F.col
    in_stock = (_whole(c("stock_quantity")) > 0) & (to_decimal(c("price")) > 0)
    columns = book_columns(as_of) | {
        "category": canonical.canonicalise(c("category"), CATEGORIES),
        "is_available": _certain(in_stock),
    }
    return typed(raw.where(c("book_id").isNotNull()), columns, "dim_books")


def orders(raw: DataFrame, customers: DataFrame, as_of: AsOf) -> DataFrame:
    """Charges need only be readable; only year-first dates make an order valid."""
    c = F.col

    def charge(value: Column) -> Column:
        amount = to_decimal(value)
        return F.when(amount >= 0, amount).otherwise(F.lit(0).cast(MONEY))

    dated = F.try_to_date(c("order_date"), _LOOSE_DAY) <= day(as_of)
    paid = text.has_text(c("total_amount")) & (to_decimal(c("total_amount")) > 0)
    columns = order_columns(as_of) | {
        "shipping_cost": charge(c("shipping_cost")),
        "discount_applied": charge(c("discount_applied")),
        "is_valid_order": _certain(paid & dated),
    }
    return typed(known_orders(raw, customers), columns, "fact_orders")


def order_items(raw: DataFrame, orders: DataFrame, books: DataFrame) -> DataFrame:
    """The computed subtotal is the bare product; null where a part is unreadable."""
    c = F.col
    product = (_whole(c("quantity")) * to_decimal(c("unit_price"))).try_cast(MONEY)
    gap = F.abs(to_decimal(c("subtotal")) - product)
    columns = item_columns() | {
        "calculated_subtotal": product,
        "subtotal_matches": _certain(gap < F.lit(fixed.SUBTOTAL_TOLERANCE)),
    }
    return typed(known_items(raw, orders, books), columns, "fact_order_items")


def reviews(
    raw: DataFrame, books: DataFrame, customers: DataFrame, as_of: AsOf
) -> DataFrame:
    """Any date text makes a review valid, also one marked unusable."""
    c = F.col
    rating = _whole(c("rating"))
    valid = rating.between(1, 5) & (F.trim("review_text") != "") & c("review_date").isNotNull()
    columns = review_columns(as_of) | {
        "rating": F.when(rating.between(1, 5), rating),
        "is_valid_review": _certain(valid),
    }
    return typed(known_reviews(raw, books, customers), columns, "fact_reviews")


def _item_sales(items: DataFrame, counted_orders: DataFrame) -> DataFrame:
    """Per book: item rows, copies and revenue of the counted orders, copies of all."""
    marked = items.join(
        counted_orders.select("order_id", F.lit(True).alias("counted")), "order_id", "left"
    )
    counted = F.col("counted")
    return marked.groupBy("book_id").agg(
        F.count("*").alias("item_rows"),
        F.count("counted").alias("counted_rows"),
        F.sum(F.when(counted, F.col("quantity"))).alias("copies"),
        F.sum("quantity").alias("all_copies"),
        total(F.when(counted, F.col("calculated_subtotal"))).alias("revenue"),
    )


def top_selling_books(
    books: DataFrame, items: DataFrame, orders: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Items of completed sales only, multiplied by the book's reviews."""
    sold = items.join(gold.completed_sales(orders).select("order_id"), "order_id", "left_semi")
    per_order = sold.groupBy("order_id", "book_id").agg(
        F.sum("quantity").alias("copies"), F.sum("calculated_subtotal").alias("revenue")
    )
    per_book = per_order.groupBy("book_id").agg(
        F.count("*").alias("times_ordered"),
        F.sum("copies").alias("copies"),
        total("revenue").alias("revenue"),
    )
    repeats = gold.at_least_one(F.col("review_rows"))
    return (
        books.join(per_book, "book_id")
        .join(gold.reviews_per(reviews, "book_id"), "book_id", "left")
        .select(
            *gold.BOOK_COLUMNS,
            "times_ordered",
            times(F.col("copies"), repeats, WHOLE_TOTAL).alias("total_copies_sold"),
            times(F.col("revenue"), repeats).alias("total_revenue"),
            gold.mean_rating().alias("customer_avg_rating"),
            F.coalesce("total_reviews", F.lit(0)).alias("total_reviews"),
        )
    )


def customer_analytics(
    customers: DataFrame, orders: DataFrame, items: DataFrame, reviews: DataFrame, as_of: AsOf
) -> DataFrame:
    """Without items the quantity is null rather than zero."""
    current = gold.customer_analytics(customers, orders, items, reviews, as_of)
    quantity = F.nullif(F.col("total_books_quantity"), F.lit(0))
    return current.withColumn("total_books_quantity", quantity)


def geographic_analysis(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Only customers with valid orders count."""
    people = F.count("customer_id")
    revenue = total("spent")
    return (
        customers.select("customer_id", "state", "city")
        .join(gold.spend_per_customer(orders, items), "customer_id")
        .groupBy("state", "city")
        .agg(
            people.alias("total_customers"),
            F.sum("total_orders").alias("total_orders"),
            F.sum("quantity").alias("total_books_sold"),
            revenue.alias("total_revenue"),
            ratio(revenue, F.sum("spent_rows"), 2).alias("avg_order_value"),
            ratio(revenue, people, 2).alias("revenue_per_customer"),
            ratio(F.sum("total_orders").cast("decimal(20,0)"), people, 2).alias(
                "orders_per_customer"
            ),
        )
    )


def author_performance(
    books: DataFrame, items: DataFrame, orders: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Items of valid orders only; a book whose items are all invalid drops out.

    The best book and the main category still look at everything.
    """
    sold = _item_sales(items, gold.valid_orders(orders))
    rows = F.col("counted_rows")
    kept = F.col("item_rows").isNull() | (rows > 0)
    performance = gold.fold_into_authors(gold.book_rows(books, sold, reviews, rows, kept))
    return performance.where("total_books > 0")
