"""Gold outputs over the Silver tables.

The plain outputs reproduce the join chains the business reports were defined
with: where several facts hang off one key, sums are multiplied by the number
of matching rows of the other facts.  The chains are never executed.  Each fact
is aggregated to the output key first and its sums are scaled by the row counts
of the others, which gives the same numbers in linear work and without large
intermediate results.  ``gold_by_grain`` holds the unmultiplied companions.

Grouping before joining also keeps a key that owns much of a fact from landing
in one task: each task folds its share of that key before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, segments
from ..functions import fixed_values as fixed
from ..functions.dates import AsOf
from ..operators.aggregates import (
    WHOLE_TOTAL,
    count_where,
    mean,
    ratio,
    scalar,
    times,
    total,
    total_or_zero,
)
from ..operators.ranking import best_first
from ..operators.surrogate import with_ordered_key
from ..schemas import GOLD
from ..sources.layers import conform


def valid_orders(orders: DataFrame) -> DataFrame:
    return orders.where("is_valid_order")


def completed_sales(orders: DataFrame) -> DataFrame:
    """Valid orders not cancelled; an unknown status is left out as well."""
    return valid_orders(orders).where(F.col("order_status") != fixed.CANCELLED)


def at_least_one(rows: Column) -> Column:
    """Rows a key contributes to a left join: one even without a match."""
    return F.greatest(F.coalesce(rows, F.lit(0)), F.lit(1))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count("*").alias("item_rows"), F.sum("quantity").alias("item_quantity")
    )


def reviews_per(reviews: DataFrame, key: str) -> DataFrame:
    return reviews.groupBy(key).agg(
        F.count("*").alias("review_rows"),
        F.countDistinct("review_id").alias("total_reviews"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_rows"),
    )


def mean_rating() -> Column:
    return ratio(F.col("rating_sum").cast("decimal(20,0)"), F.col("rating_rows"), 1)


def sales_by_category(items: DataFrame, orders: DataFrame, books: DataFrame) -> DataFrame:
    """Completed sales per category.

    Orders are joined last: counting distinct orders groups by (category,
    order) first, which the partitioning of that join already serves.
    """
    return (
        items.join(books.select("book_id", "category"), "book_id")
        .join(completed_sales(orders).select("order_id"), "order_id")
        .groupBy("category")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            F.count("order_item_id").alias("total_items_sold"),
            F.sum("quantity").alias("total_quantity"),
            total("calculated_subtotal").alias("total_revenue"),
            mean(F.col("calculated_subtotal"), 2).alias("avg_order_value"),
            ratio(total("calculated_subtotal"), F.sum("quantity"), 2).alias("avg_price_per_unit"),
        )
    )


def _items_per_book(items: DataFrame, counted_orders: DataFrame) -> DataFrame:
    """Copies, revenue and item rows per book, and in how many of the counted
    orders it appears.

    Grouping by (book, order) first reuses the partitioning of the order join.
    """
    marked = items.join(
        counted_orders.select("order_id", F.lit(1).alias("counted")), "order_id", "left"
    )
    per_order = marked.groupBy("order_id", "book_id").agg(
        F.max("counted").alias("counted"),
        F.count("*").alias("item_rows"),
        F.sum("quantity").alias("copies"),
        F.sum("calculated_subtotal").alias("revenue"),
    )
    return per_order.groupBy("book_id").agg(
        F.count("counted").alias("times_ordered"),
        F.sum("item_rows").alias("item_rows"),
        F.sum("copies").alias("copies"),
        total("revenue").alias("revenue"),
    )


def top_selling_books(
    books: DataFrame, items: DataFrame, orders: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Books with copies sold.

    Copies and revenue count the items of every order and are multiplied by the
    book's reviews; only ``times_ordered`` looks at order validity.
    """
    repeats = at_least_one(F.col("review_rows"))
    return (
        books.join(_items_per_book(items, completed_sales(orders)), "book_id", "left")
        .join(reviews_per(reviews, "book_id"), "book_id", "left")
        .select(
            *BOOK_COLUMNS,
            F.coalesce("times_ordered", F.lit(0)).alias("times_ordered"),
            _or_zero(times(F.col("copies"), repeats, WHOLE_TOTAL)).alias("total_copies_sold"),
            _or_zero(times(F.col("revenue"), repeats)).alias("total_revenue"),
            mean_rating().alias("customer_avg_rating"),
            F.coalesce("total_reviews", F.lit(0)).alias("total_reviews"),
        )
        .where("total_copies_sold > 0")
    )


BOOK_COLUMNS = ("book_id", "title", "author", "category", "price", "avg_rating")
_CUSTOMER_COLUMNS = ("customer_id", "full_name", "city", "state", "age", "registration_date")


def with_segments(df: DataFrame, days: str, spent: str) -> DataFrame:
    """Add recency status and spend tier."""
    return df.withColumns(
        {
            "customer_status": segments.recency_status(F.col(days)),
            "customer_tier": segments.spend_tier(F.col(spent)),
        }
    )


def _order_rows(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Valid orders with the row count and quantity of their items."""
    return (
        valid_orders(orders)
        .join(items_per_order(items), "order_id", "left")
        .withColumn("order_rows", at_least_one(F.col("item_rows")))
    )


def spend_per_customer(orders: DataFrame, items: DataFrame) -> DataFrame:
    rows = F.col("order_rows")
    return (
        _order_rows(orders, items)
        .groupBy("customer_id")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            total(times(F.col("total_amount"), rows)).alias("spent"),
            F.sum(F.when(F.col("total_amount").isNotNull(), rows)).alias("spent_rows"),
            F.sum("item_quantity").alias("quantity"),
            F.max("order_date").alias("last_order_date"),
        )
    )


def purchases_per_customer(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Per customer: amounts of valid orders once for each item, quantity and books.

    Orders meet items once.  The joined rows fold into (customer, book), which counts each
    book once, and those into customers; orders are counted without their items.
    """
    valid = valid_orders(orders)
    bought = (
        valid.select("order_id", "customer_id", "total_amount", "order_date")
        .join(items.select("order_id", "book_id", "quantity"), "order_id", "left")
        .groupBy("customer_id", "book_id")
        .agg(
            total("total_amount").alias("spent"),
            F.count("total_amount").alias("spent_rows"),
            F.sum("quantity").alias("quantity"),
            F.max("order_date").alias("last_order_date"),
        )
        .groupBy("customer_id")
        .agg(
            total("spent").alias("spent"),
            F.sum("spent_rows").alias("spent_rows"),
            F.sum("quantity").alias("quantity"),
            F.max("last_order_date").alias("last_order_date"),
            F.count("book_id").alias("unique_books_purchased"),
        )
    )
    counted = valid.groupBy("customer_id").agg(F.countDistinct("order_id").alias("total_orders"))
    return bought.join(counted, "customer_id")


def customer_analytics(
    customers: DataFrame, orders: DataFrame, items: DataFrame, reviews: DataFrame, as_of: AsOf
) -> DataFrame:
    """Customers with valid orders: spend, recency, tier.

    Spend is multiplied by the items of each order and by the customer's
    reviews, quantity by the reviews; cancelled orders count.
    """
    repeats = at_least_one(F.col("review_rows"))
    spent = times(F.col("spent"), repeats)
    joined = (
        customers.select(*_CUSTOMER_COLUMNS)
        .join(purchases_per_customer(orders, items), "customer_id")
        .join(reviews_per(reviews, "customer_id"), "customer_id", "left")
    )
    measured = joined.select(
        *_CUSTOMER_COLUMNS,
        "total_orders",
        spent.alias("total_spent"),
        ratio(F.col("spent"), F.col("spent_rows"), 2).alias("avg_order_value"),
        ratio(spent, F.col("total_orders"), 2).alias("avg_per_order"),
        "unique_books_purchased",
        _or_zero(times(F.col("quantity"), repeats, WHOLE_TOTAL)).alias("total_books_quantity"),
        F.coalesce("total_reviews", F.lit(0)).alias("total_reviews_written"),
        mean_rating().alias("avg_rating_given"),
        "last_order_date",
        dates.days_since(F.col("last_order_date"), as_of).alias("days_since_last_order"),
    )
    return with_segments(measured, "days_since_last_order", "total_spent")


def at_risk_customers(analytics: DataFrame) -> DataFrame:
    """Customers worth re-engaging."""
    return analytics.where(F.col("customer_status") == fixed.AT_RISK)


def _sales_with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Completed sales that have items, amounts multiplied by their item rows."""
    rows = F.col("item_rows")
    amounts = ["total_amount", "shipping_cost", "discount_applied", "net_amount"]
    return (
        completed_sales(orders)
        .join(items_per_order(items), "order_id")
        .withColumns({f"{a}_rows": times(F.col(a), rows) for a in amounts})
        .withColumn("amount_rows", F.when(F.col("total_amount").isNotNull(), rows))
    )


def _period_measures(revenue: str) -> list[Column]:
    return [
        F.countDistinct("order_id").alias("total_orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum("item_quantity").alias("total_items_sold"),
        total("total_amount_rows").alias(revenue),
        total("shipping_cost_rows").alias("total_shipping"),
        total("discount_applied_rows").alias("total_discounts"),
        total("net_amount_rows").alias("net_revenue"),
        ratio(total("total_amount_rows"), F.sum("amount_rows"), 2).alias("avg_order_value"),
    ]


def sales_over_time(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Completed sales per month; order amounts count once per item."""
    day = F.col("order_date")
    return (
        _sales_with_items(orders, items)
        .groupBy(
            dates.year_month(day).alias("yearmonth"),
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            dates.month_name(day).alias("month_name"),
        )
        .agg(
            *_period_measures("gross_revenue"),
            ratio(total("total_amount_rows"), F.countDistinct("customer_id"), 2).alias(
                "revenue_per_customer"
            ),
        )
    )


def daily_metrics(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Completed sales per day, in the types of the stored table."""
    daily = (
        _sales_with_items(orders, items)
        .groupBy(F.col("order_date").alias("metric_date"))
        .agg(*_period_measures("total_revenue"))
    )
    return conform(daily, GOLD["agg_daily_metrics"])


def payment_analysis(orders: DataFrame) -> DataFrame:
    """Completed sales per payment method, with shares of all valid orders."""
    everything = valid_orders(orders).agg(
        F.countDistinct("order_id").alias("orders"), total("total_amount").alias("revenue")
    )
    hundred = F.lit(100).cast("decimal(3,0)")
    return (
        completed_sales(orders)
        .groupBy("payment_method")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            total("total_amount").alias("total_revenue"),
            mean(F.col("total_amount"), 2).alias("avg_order_value"),
            total("discount_applied").alias("total_discounts"),
        )
        .withColumns(
            {
                "percentage_of_orders": ratio(
                    F.col("total_orders") * hundred, scalar(everything, "orders"), 2
                ),
                "percentage_of_revenue": ratio(
                    F.col("total_revenue") * hundred, scalar(everything, "revenue"), 2
                ),
            }
        )
    )


def geographic_analysis(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Places with valid orders; order amounts count once per item."""
    people = F.count("customer_id")
    revenue = total("spent")
    return (
        customers.select("customer_id", "state", "city")
        .join(spend_per_customer(orders, items), "customer_id", "left")
        .groupBy("state", "city")
        .agg(
            people.alias("total_customers"),
            F.coalesce(F.sum("total_orders"), F.lit(0)).alias("total_orders"),
            F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_books_sold"),
            total_or_zero("spent").alias("total_revenue"),
            ratio(revenue, F.sum("spent_rows"), 2).alias("avg_order_value"),
            ratio(revenue, people, 2).alias("revenue_per_customer"),
            ratio(F.sum("total_orders").cast("decimal(20,0)"), people, 2).alias(
                "orders_per_customer"
            ),
        )
        .where("total_orders > 0")
    )


def review_analytics(books: DataFrame, reviews: DataFrame) -> DataFrame:
    """Valid reviews per book."""
    stars = F.col("rating")
    liked = count_where(stars >= 4)
    per_book = (
        reviews.where("is_valid_review")
        .groupBy("book_id")
        .agg(
            F.count("review_id").alias("total_reviews"),
            mean(stars, 2).alias("avg_rating"),
            count_where(stars == 5).alias("five_star_reviews"),
            count_where(stars == 4).alias("four_star_reviews"),
            count_where(stars == 3).alias("three_star_reviews"),
            count_where(stars <= 2).alias("low_star_reviews"),
            ratio((liked * 100).cast("decimal(20,0)"), F.count("review_id"), 2).alias(
                "positive_review_percentage"
            ),
            mean(F.col("review_length"), 0).alias("avg_review_length"),
            F.sum("helpful_count").alias("total_helpful_votes"),
        )
    )
    return books.select("book_id", "title", "author", "category").join(per_book, "book_id")


def premium_catalogue(analytics: DataFrame, minimum_reviews: int) -> DataFrame:
    """Highly rated books with enough reviews."""
    return analytics.where(
        (F.col("avg_rating") >= F.lit(fixed.PREMIUM_RATING))
        & (F.col("total_reviews") >= minimum_reviews)
    )


def delivered_orders(orders: DataFrame, month: str) -> DataFrame:
    """Delivered orders of a month given as ``yyyy-MM``."""
    first = F.to_date(F.lit(f"{month}-01"))
    day = F.col("order_date")
    return orders.where(
        (day >= first) & (day < F.add_months(first, 1)) & (F.col("order_status") == fixed.DELIVERED)
    )


def book_rows(
    books: DataFrame, sold: DataFrame, reviews: DataFrame, rows: Column, kept: Column
) -> DataFrame:
    """Per book: its sales, and how often its row repeats in the author's join.

    ``sold`` has per-book ``copies`` and ``revenue`` for the sums and
    ``all_copies`` for the choice of the best book; ``rows`` counts the joined
    item rows; ``kept`` tells whether the book takes part at all.
    """
    repeats = at_least_one(F.col("review_rows"))
    joined = F.when(kept, times(at_least_one(rows), repeats, WHOLE_TOTAL))
    return (
        books.select("book_id", "title", "author", "category", "avg_rating")
        .join(sold, "book_id", "left")
        .join(reviews_per(reviews, "book_id"), "book_id", "left")
        .select(
            "author",
            "category",
            "title",
            "book_id",
            kept.cast("int").alias("kept"),
            F.coalesce("all_copies", F.lit(0)).alias("copies"),
            times(F.col("copies"), repeats, WHOLE_TOTAL).alias("joined_copies"),
            times(F.col("revenue"), repeats).alias("joined_revenue"),
            (F.col("avg_rating") * joined).cast("decimal(28,1)").alias("rating_rows_sum"),
            F.when(F.col("avg_rating").isNotNull(), joined).alias("rating_rows"),
            F.when(kept, F.col("total_reviews")).alias("total_reviews"),
        )
    )


def fold_into_authors(rows: DataFrame) -> DataFrame:
    """One chain of groupings: books fold into (author, category), those into authors."""
    by_category = rows.groupBy("author", "category").agg(
        F.count("*").alias("books"),
        F.sum("kept").alias("kept"),
        F.sum("joined_copies").alias("copies"),
        total("joined_revenue").alias("revenue"),
        F.sum("rating_rows_sum").alias("rating_rows_sum"),
        F.sum("rating_rows").alias("rating_rows"),
        F.sum("total_reviews").alias("reviews"),
        F.min(best_first(F.col("copies"), "title", "book_id")).alias("best"),
    )
    known = F.col("author").isNotNull()
    return (
        by_category.groupBy("author")
        .agg(
            F.sum("kept").alias("total_books"),
            _or_zero(F.sum("copies").cast(WHOLE_TOTAL)).alias("total_copies_sold"),
            total_or_zero("revenue").alias("total_revenue"),
            ratio(
                F.sum("rating_rows_sum").cast("decimal(28,1)"),
                F.sum("rating_rows").cast(WHOLE_TOTAL),
                2,
            ).alias("avg_book_rating"),
            F.coalesce(F.sum("reviews"), F.lit(0)).alias("total_reviews"),
            F.min("best").alias("best"),
            F.min(best_first(F.col("books"), "category")).alias("main"),
        )
        .select(
            F.col("author").alias("author_name"),
            "total_books",
            "total_copies_sold",
            "total_revenue",
            "avg_book_rating",
            "total_reviews",
            F.when(known, F.col("best.title")).alias("most_popular_book"),
            F.when(known, F.col("main.category")).alias("most_popular_category"),
        )
    )


def author_performance(books: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per author: sales of all orders multiplied by reviews, best book, main category.

    Order validity plays no part.  Ties go to the smaller title or category.
    """
    sold = items.groupBy("book_id").agg(
        F.count("*").alias("item_rows"),
        F.sum("quantity").alias("copies"),
        F.sum("quantity").alias("all_copies"),
        total("calculated_subtotal").alias("revenue"),
    )
    rows = book_rows(books, sold, reviews, F.col("item_rows"), F.lit(True))
    return fold_into_authors(rows)


def author_performance_table(performance: DataFrame) -> DataFrame:
    """The stored form: authors numbered by falling revenue."""
    order = [F.desc("total_revenue"), F.asc("author_name")]
    return conform(
        with_ordered_key(performance, "author_id", order), GOLD["agg_author_performance"]
    )


def popular_book(books: DataFrame, items: DataFrame) -> DataFrame:
    """Best-selling title per author over all orders."""
    sold = items.groupBy("book_id").agg(F.sum("quantity").alias("copies"))
    best = best_first(F.coalesce("copies", F.lit(0)), "title", "book_id")
    return (
        books.select("book_id", "author", "title")
        .join(sold, "book_id", "left")
        .groupBy("author")
        .agg(F.min(best).alias("best"))
        .select(
            "author",
            F.col("best.title").alias("most_popular_book"),
            (-F.col("best.rank")).alias("copies"),
        )
    )


def presentation_order(output: str) -> list[Column]:
    """Sort order in which an output is shown.  Keep it out of further queries."""
    orders = {
        "sales_by_category": ([F.desc("total_revenue")], "category"),
        "top_selling_books": ([F.desc("total_copies_sold"), F.desc("total_revenue")], "book_id"),
        "customer_analytics": ([F.desc("total_spent")], "customer_id"),
        "sales_over_time": ([], "yearmonth"),
        "payment_analysis": ([F.desc("total_revenue")], "payment_method"),
        "geographic_analysis": ([F.desc("total_revenue"), F.asc("state")], "city"),
        "review_analytics": ([F.desc("avg_rating"), F.desc("total_reviews")], "book_id"),
        "daily_metrics": ([], "metric_date"),
        "author_performance": ([F.desc("total_revenue")], "author_name"),
    }
    ranking, key = orders[output]
    return [*ranking, F.asc(key)]
