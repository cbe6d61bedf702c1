"""Gold outputs at their own grain: nothing is multiplied by a join.

Items count only when their order does, and order amounts count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.dates import AsOf
from ..operators.aggregates import mean, ratio, total, total_or_zero
from ..operators.ranking import best_first
from ..schemas import GOLD
from ..sources.layers import conform
from .gold import completed_sales, items_per_order, reviews_per, valid_orders, with_segments


def _rating_mean(digits: int) -> Column:
    return ratio(F.col("rating_sum").cast("decimal(20,0)"), F.col("rating_rows"), digits)


def _book_sales(items: DataFrame, counted_orders: DataFrame) -> DataFrame:
    """Items of the counted orders per book."""
    sold = items.join(counted_orders.select("order_id"), "order_id", "left_semi")
    per_order = sold.groupBy("order_id", "book_id").agg(
        F.sum("quantity").alias("copies"), F.sum("calculated_subtotal").alias("revenue")
    )
    return per_order.groupBy("book_id").agg(
        F.count("*").alias("times_ordered"),
        F.sum("copies").alias("total_copies_sold"),
        total("revenue").alias("total_revenue"),
    )


def top_selling_books(
    books: DataFrame, items: DataFrame, orders: DataFrame, reviews: DataFrame
) -> DataFrame:
    return (
        books.join(_book_sales(items, completed_sales(orders)), "book_id")
        .join(reviews_per(reviews, "book_id"), "book_id", "left")
        .where("total_copies_sold > 0")
        .select(
            "book_id",
            "title",
            "author",
            "category",
            "price",
            "avg_rating",
            "times_ordered",
            "total_copies_sold",
            "total_revenue",
            _rating_mean(1).alias("customer_avg_rating"),
            F.coalesce("total_reviews", F.lit(0)).alias("total_reviews"),
        )
    )


def _customer_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    return (
        valid_orders(orders)
        .join(items_per_order(items), "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("total_orders"),
            total("total_amount").alias("total_spent"),
            mean(F.col("total_amount"), 2).alias("avg_order_value"),
            F.coalesce(F.sum("item_quantity"), F.lit(0)).alias("total_books_quantity"),
            F.max("order_date").alias("last_order_date"),
        )
    )


def customer_analytics(
    customers: DataFrame, orders: DataFrame, items: DataFrame, reviews: DataFrame, as_of: AsOf
) -> DataFrame:
    valid = valid_orders(orders)
    spent = valid.groupBy("customer_id").agg(
        F.count("*").alias("total_orders"),
        total("total_amount").alias("total_spent"),
        mean(F.col("total_amount"), 2).alias("avg_order_value"),
        F.max("order_date").alias("last_order_date"),
    )
    # Orders meet items once; folding by book first counts each book once.
    books_bought = (
        valid.select("order_id", "customer_id")
        .join(items.select("order_id", "book_id", "quantity"), "order_id")
        .groupBy("customer_id", "book_id")
        .agg(F.sum("quantity").alias("quantity"))
        .groupBy("customer_id")
        .agg(F.count("book_id").alias("unique_books_purchased"), F.sum("quantity").alias("quantity"))
    )
    measured = (
        customers.select(
            "customer_id", "full_name", "city", "state", "age", "registration_date"
        )
        .join(spent, "customer_id")
        .join(books_bought, "customer_id", "left")
        .join(reviews_per(reviews, "customer_id"), "customer_id", "left")
        .select(
            "customer_id",
            "full_name",
            "city",
            "state",
            "age",
            "registration_date",
            "total_orders",
            "total_spent",
            "avg_order_value",
            F.coalesce("unique_books_purchased", F.lit(0)).alias("unique_books_purchased"),
            F.coalesce("quantity", F.lit(0)).alias("total_books_quantity"),
            F.coalesce("total_reviews", F.lit(0)).alias("total_reviews_written"),
            _rating_mean(1).alias("avg_rating_given"),
            "last_order_date",
            dates.days_since(F.col("last_order_date"), as_of).alias("days_since_last_order"),
        )
    )
    return with_segments(measured, "days_since_last_order", "total_spent")


def _period(orders: DataFrame, items: DataFrame, revenue: str, *period: Column) -> DataFrame:
    """Completed sales per period; orders without items count too."""
    return (
        completed_sales(orders)
        .join(items_per_order(items), "order_id", "left")
        .groupBy(*period)
        .agg(
            F.count("*").alias("total_orders"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.coalesce(F.sum("item_quantity"), F.lit(0)).alias("total_items_sold"),
            total("total_amount").alias(revenue),
            total("shipping_cost").alias("total_shipping"),
            total("discount_applied").alias("total_discounts"),
            total("net_amount").alias("net_revenue"),
            mean(F.col("total_amount"), 2).alias("avg_order_value"),
        )
    )


def sales_over_time(orders: DataFrame, items: DataFrame) -> DataFrame:
    day = F.col("order_date")
    monthly = _period(
        orders,
        items,
        "gross_revenue",
        dates.year_month(day).alias("yearmonth"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        dates.month_name(day).alias("month_name"),
    )
    return monthly.withColumn(
        "revenue_per_customer", ratio(F.col("gross_revenue"), F.col("unique_customers"), 2)
    )


def daily_metrics(orders: DataFrame, items: DataFrame) -> DataFrame:
    daily = _period(orders, items, "total_revenue", F.col("order_date").alias("metric_date"))
    return conform(daily, GOLD["agg_daily_metrics"])


def geographic_analysis(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    people = F.count("customer_id")
    spent = total("total_spent")
    count = F.sum("total_orders")
    return (
        customers.select("customer_id", "state", "city")
        .join(_customer_orders(orders, items), "customer_id", "left")
        .groupBy("state", "city")
        .agg(
            people.alias("total_customers"),
            F.coalesce(count, F.lit(0)).alias("total_orders"),
            F.coalesce(F.sum("total_books_quantity"), F.lit(0)).alias("total_books_sold"),
            total_or_zero("total_spent").alias("total_revenue"),
            ratio(spent, count, 2).alias("avg_order_value"),
            ratio(spent, people, 2).alias("revenue_per_customer"),
            ratio(count.cast("decimal(20,0)"), people, 2).alias("orders_per_customer"),
        )
        .where("total_orders > 0")
    )


def author_performance(
    books: DataFrame, items: DataFrame, orders: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Per author: items of valid orders, plain mean of the catalogue ratings."""
    copies = F.coalesce("total_copies_sold", F.lit(0))
    best = best_first(copies, "title", "book_id")
    by_category = (
        books.select("book_id", "author", "category", "title", "avg_rating")
        .join(_book_sales(items, valid_orders(orders)), "book_id", "left")
        .join(reviews_per(reviews, "book_id"), "book_id", "left")
        .groupBy("author", "category")
        .agg(
            F.count("*").alias("books"),
            F.sum(copies).alias("copies"),
            total_or_zero("total_revenue").alias("revenue"),
            F.sum("avg_rating").alias("ratings"),
            F.count("avg_rating").alias("rated"),
            F.sum("total_reviews").alias("reviews"),
            F.min(best).alias("best"),
        )
    )
    main = best_first(F.col("books"), "category")
    return (
        by_category.groupBy("author")
        .agg(
            F.sum("books").alias("total_books"),
            F.sum("copies").alias("total_copies_sold"),
            total("revenue").alias("total_revenue"),
            ratio(F.sum("ratings"), F.sum("rated"), 2).alias("avg_book_rating"),
            F.coalesce(F.sum("reviews"), F.lit(0)).alias("total_reviews"),
            F.min("best").alias("best"),
            F.min(main).alias("main"),
        )
        .select(
            F.col("author").alias("author_name"),
            "total_books",
            "total_copies_sold",
            "total_revenue",
            "avg_book_rating",
            "total_reviews",
            F.col("best.title").alias("most_popular_book"),
            F.col("main.category").alias("most_popular_category"),
        )
    )
