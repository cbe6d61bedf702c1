"""Declared schemas.  Nothing is ever inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _raw(*columns: str) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in columns]
    return T.StructType([*fields, T.StructField("created_at", T.TimestampType())])


def _typed(declaration: str) -> dict[str, str]:
    """Column types of ``name type, ...`` by name."""
    pairs = (column.split() for column in declaration.split(", "))
    return {name: sql_type for name, sql_type in pairs}


RAW = {
    "raw_customers": _raw(
        "customer_id", "full_name", "email", "phone", "registration_date",
        "city", "state", "country", "birth_date",
    ),
    "raw_books": _raw(
        "book_id", "title", "author", "publisher", "publication_year", "isbn",
        "category", "price", "stock_quantity", "pages", "language_code", "rating",
    ),
    "raw_orders": _raw(
        "order_id", "customer_id", "order_date", "total_amount", "payment_method",
        "order_status", "shipping_cost", "discount_applied",
    ),
    "raw_order_items": _raw(
        "order_item_id", "order_id", "book_id", "quantity", "unit_price", "subtotal",
    ),
    "raw_reviews": _raw(
        "review_id", "book_id", "customer_id", "rating", "review_text",
        "review_date", "helpful_count",
    ),
}

# Declared type of every column, in order.
SILVER = {
    "dim_customers": _typed(
        "customer_id string, full_name string, email string, email_valid boolean,"
        " phone string, registration_date date, city string, state string,"
        " country string, birth_date date, age int, data_quality_score decimal(3,2)"
    ),
    "dim_books": _typed(
        "book_id string, title string, author string, publisher string,"
        " publication_year int, isbn string, category string, price decimal(10,2),"
        " stock_quantity int, pages int, language_code string, avg_rating decimal(2,1),"
        " is_available boolean, data_quality_score decimal(3,2)"
    ),
    "fact_orders": _typed(
        "order_id string, customer_id string, order_date date, total_amount decimal(10,2),"
        " payment_method string, order_status string, shipping_cost decimal(10,2),"
        " discount_applied decimal(10,2), net_amount decimal(10,2),"
        " is_valid_order boolean, data_quality_score decimal(3,2)"
    ),
    "fact_order_items": _typed(
        "order_item_id string, order_id string, book_id string, quantity int,"
        " unit_price decimal(10,2), subtotal decimal(10,2),"
        " calculated_subtotal decimal(10,2), subtotal_matches boolean"
    ),
    "fact_reviews": _typed(
        "review_id string, book_id string, customer_id string, rating int,"
        " review_text string, review_date date, helpful_count int,"
        " review_length int, is_valid_review boolean"
    ),
}

# Surrogate key and business key of each Silver table.
KEYS = {
    "dim_customers": ("customer_key", "customer_id"),
    "dim_books": ("book_key", "book_id"),
    "fact_orders": ("order_key", "order_id"),
    "fact_order_items": ("order_item_key", "order_item_id"),
    "fact_reviews": ("review_key", "review_id"),
}

# Counts and totals are wider than a small shop needs: they must not overflow.
GOLD = {
    "agg_daily_metrics": _typed(
        "metric_date date, total_orders bigint, total_revenue decimal(28,2),"
        " total_items_sold bigint, unique_customers bigint, avg_order_value decimal(10,2),"
        " total_shipping decimal(28,2), total_discounts decimal(28,2),"
        " net_revenue decimal(28,2)"
    ),
    "agg_author_performance": _typed(
        "author_id bigint, author_name string, total_books bigint,"
        " total_copies_sold decimal(28,0), total_revenue decimal(28,2),"
        " avg_book_rating decimal(3,2), total_reviews bigint,"
        " most_popular_book string, most_popular_category string"
    ),
}
