"""Rows that were delivered twice: totals of rows double, counts of things do not."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from shelfmark.plans import gold


def test_orders_are_counted_once(spark):
    day = dt.date(2001, 5, 1)
    row = ("O1", "C1", day, Decimal("10.00"), "PIX", "Entregue", Decimal("1.00"), Decimal("0.00"), Decimal("11.00"), True)
    other = ("O2", *row[1:])
    orders = spark.createDataFrame(
        [row, row, other],
        """order_id string, customer_id string, order_date date, total_amount decimal(10,2),
        payment_method string, order_status string, shipping_cost decimal(10,2),
        discount_applied decimal(10,2), net_amount decimal(10,2), is_valid_order boolean""",
    )
    payment = gold.payment_analysis(orders).first()
    assert (payment.total_orders, payment.total_revenue) == (2, Decimal("30.00"))
    assert payment.percentage_of_orders == 100
    items = spark.createDataFrame(
        [("I1", "O1", "B1", 1, Decimal("10.00")), ("I2", "O2", "B1", 1, Decimal("10.00"))],
        """order_item_id string, order_id string, book_id string, quantity int,
        calculated_subtotal decimal(12,2)""",
    )
    month = gold.sales_over_time(orders, items).first()
    assert (month.total_orders, month.unique_customers) == (2, 1)


def test_reviews_are_counted_once(spark):
    reviews = spark.createDataFrame(
        [("R1", "B1", 5), ("R1", "B1", 5), ("R2", "B1", 3)], "review_id string, book_id string, rating int"
    )
    row = gold.reviews_per(reviews, "book_id").first()
    assert (row.total_reviews, row.review_rows) == (2, 3)
