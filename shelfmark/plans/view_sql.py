"""The seven Gold views as SQL text, for a catalog to keep.

A stored view outlives the session that made it, which a DataFrame's does not.  The
statements say what ``gold`` says, in the same shape: each fact is grouped to the key of
the output before it is joined, and sums are scaled by the other facts' row counts.
"""

from __future__ import annotations

from ..functions import fixed_values as fixed
from ..functions.dates import AsOf

VALID = "is_valid_order"
COMPLETED = f"is_valid_order AND order_status <> '{fixed.CANCELLED}'"


def _ratio(numerator: str, denominator: str, digits: int) -> str:
    return f"round({numerator} / nullif({denominator}, 0), {digits})"


def _total(value: str) -> str:
    return f"CAST(sum({value}) AS DECIMAL(28,2))"


def _mean(value: str, digits: int) -> str:
    return _ratio(_total(value), f"count({value})", digits)


def _times(value: str, rows: str, kind: str = "DECIMAL(28,2)") -> str:
    return f"CAST(CAST({value} AS {kind}) * CAST({rows} AS DECIMAL(19,0)) AS {kind})"


def _bands(value: str, bands: tuple, relation: str, otherwise: str) -> str:
    whens = " ".join(f"WHEN {value} {relation} {limit} THEN '{label}'" for limit, label in bands)
    return f"CASE {whens} ELSE '{otherwise}' END"


def _reviews(silver: str, key: str) -> str:
    return f"""(SELECT {key}, count(*) AS review_rows, count(DISTINCT review_id) AS total_reviews,
        sum(rating) AS rating_sum, count(rating) AS rating_rows
        FROM {silver}.fact_reviews GROUP BY {key})"""


def _baskets(silver: str) -> str:
    return f"""(SELECT order_id, count(*) AS item_rows, sum(quantity) AS item_quantity
        FROM {silver}.fact_order_items GROUP BY order_id)"""


def _spending(silver: str) -> str:
    """Per customer: valid orders, their amounts once for each item."""
    rows = "greatest(coalesce(item_rows, 0), 1)"
    return f"""(SELECT customer_id, count(DISTINCT order_id) AS total_orders,
        {_total(_times('total_amount', rows))} AS spent,
        sum(CASE WHEN total_amount IS NOT NULL THEN {rows} END) AS spent_rows,
        sum(item_quantity) AS quantity, max(order_date) AS last_order_date
        FROM (SELECT * FROM {silver}.fact_orders WHERE {VALID}) LEFT JOIN {_baskets(silver)} USING (order_id)
        GROUP BY customer_id)"""


_REPEATS = "greatest(coalesce(review_rows, 0), 1)"
_MEAN_RATING = _ratio("CAST(rating_sum AS DECIMAL(20,0))", "rating_rows", 1)


def sales_by_category(silver: str) -> str:
    return f"""
    SELECT category, count(DISTINCT order_id) AS total_orders, count(order_item_id) AS total_items_sold,
        sum(quantity) AS total_quantity, {_total('calculated_subtotal')} AS total_revenue,
        {_mean('calculated_subtotal', 2)} AS avg_order_value,
        {_ratio(_total('calculated_subtotal'), 'sum(quantity)', 2)} AS avg_price_per_unit
    FROM {silver}.fact_order_items
    JOIN (SELECT book_id, category FROM {silver}.dim_books) USING (book_id)
    JOIN (SELECT order_id FROM {silver}.fact_orders WHERE {COMPLETED}) USING (order_id)
    GROUP BY category"""


def top_selling_books(silver: str) -> str:
    return f"""
    SELECT * FROM (
        SELECT book_id, title, author, category, price, avg_rating,
            coalesce(times_ordered, 0) AS times_ordered,
            coalesce({_times('copies', _REPEATS, 'DECIMAL(28,0)')}, 0) AS total_copies_sold,
            coalesce({_times('revenue', _REPEATS)}, 0) AS total_revenue,
            {_MEAN_RATING} AS customer_avg_rating, coalesce(total_reviews, 0) AS total_reviews
        FROM {silver}.dim_books
        LEFT JOIN (
            SELECT book_id, count(counted) AS times_ordered, sum(copies) AS copies, {_total('revenue')} AS revenue
            FROM (
                SELECT order_id, book_id, max(counted) AS counted, sum(quantity) AS copies,
                    sum(calculated_subtotal) AS revenue
                FROM {silver}.fact_order_items
                LEFT JOIN (SELECT order_id, 1 AS counted FROM {silver}.fact_orders WHERE {COMPLETED}) USING (order_id)
                GROUP BY order_id, book_id)
            GROUP BY book_id) USING (book_id)
        LEFT JOIN {_reviews(silver, 'book_id')} USING (book_id))
    WHERE total_copies_sold > 0"""


def customer_analytics(silver: str, as_of: AsOf) -> str:
    spent = _times("spent", _REPEATS)
    columns = "customer_id, full_name, city, state, age, registration_date"
    return f"""
    SELECT *, {_bands('days_since_last_order', fixed.RECENCY_BANDS, '<=', fixed.RECENCY_OTHERWISE)} AS customer_status,
        {_bands('total_spent', fixed.SPEND_TIERS, '>=', fixed.SPEND_OTHERWISE)} AS customer_tier
    FROM (
        SELECT {columns}, total_orders, {spent} AS total_spent,
            {_ratio('spent', 'spent_rows', 2)} AS avg_order_value,
            {_ratio(spent, 'total_orders', 2)} AS avg_per_order,
            coalesce(unique_books_purchased, 0) AS unique_books_purchased,
            coalesce({_times('quantity', _REPEATS, 'DECIMAL(28,0)')}, 0) AS total_books_quantity,
            coalesce(total_reviews, 0) AS total_reviews_written, {_MEAN_RATING} AS avg_rating_given,
            last_order_date, datediff(DATE '{as_of}', last_order_date) AS days_since_last_order
        FROM (SELECT {columns} FROM {silver}.dim_customers)
        JOIN {_spending(silver)} USING (customer_id)
        LEFT JOIN (
            SELECT customer_id, count(DISTINCT book_id) AS unique_books_purchased
            FROM (SELECT order_id, book_id FROM {silver}.fact_order_items)
            JOIN (SELECT order_id, customer_id FROM {silver}.fact_orders WHERE {VALID}) USING (order_id)
            GROUP BY customer_id) USING (customer_id)
        LEFT JOIN {_reviews(silver, 'customer_id')} USING (customer_id))"""


def sales_over_time(silver: str) -> str:
    amounts = {a: _times(a, "item_rows") for a in ("total_amount", "shipping_cost", "discount_applied", "net_amount")}
    revenue = _total(amounts["total_amount"])
    rows = "sum(CASE WHEN total_amount IS NOT NULL THEN item_rows END)"
    return f"""
    SELECT date_format(order_date, 'yyyy-MM') AS yearmonth, year(order_date) AS year, month(order_date) AS month,
        date_format(order_date, 'MMMM') AS month_name, count(DISTINCT order_id) AS total_orders,
        count(DISTINCT customer_id) AS unique_customers, sum(item_quantity) AS total_items_sold,
        {revenue} AS gross_revenue, {_total(amounts['shipping_cost'])} AS total_shipping,
        {_total(amounts['discount_applied'])} AS total_discounts, {_total(amounts['net_amount'])} AS net_revenue,
        {_ratio(revenue, rows, 2)} AS avg_order_value,
        {_ratio(revenue, 'count(DISTINCT customer_id)', 2)} AS revenue_per_customer
    FROM (SELECT * FROM {silver}.fact_orders WHERE {COMPLETED}) JOIN {_baskets(silver)} USING (order_id)
    GROUP BY 1, 2, 3, 4"""


def payment_analysis(silver: str) -> str:
    whole = f"SELECT {{0}} FROM {silver}.fact_orders WHERE {VALID}"
    orders, revenue = whole.format("count(DISTINCT order_id)"), whole.format(_total("total_amount"))
    return f"""
    SELECT *, {_ratio('total_orders * CAST(100 AS DECIMAL(3,0))', f'({orders})', 2)} AS percentage_of_orders,
        {_ratio('total_revenue * CAST(100 AS DECIMAL(3,0))', f'({revenue})', 2)} AS percentage_of_revenue
    FROM (
        SELECT payment_method, count(DISTINCT order_id) AS total_orders, {_total('total_amount')} AS total_revenue,
            {_mean('total_amount', 2)} AS avg_order_value, {_total('discount_applied')} AS total_discounts
        FROM {silver}.fact_orders WHERE {COMPLETED} GROUP BY payment_method)"""


def geographic_analysis(silver: str) -> str:
    spent = _total("spent")
    return f"""
    SELECT * FROM (
        SELECT state, city, count(customer_id) AS total_customers, coalesce(sum(total_orders), 0) AS total_orders,
            coalesce(sum(quantity), 0) AS total_books_sold,
            coalesce({spent}, CAST(0 AS DECIMAL(28,2))) AS total_revenue,
            {_ratio(spent, 'sum(spent_rows)', 2)} AS avg_order_value,
            {_ratio(spent, 'count(customer_id)', 2)} AS revenue_per_customer,
            {_ratio('CAST(sum(total_orders) AS DECIMAL(20,0))', 'count(customer_id)', 2)} AS orders_per_customer
        FROM (SELECT customer_id, state, city FROM {silver}.dim_customers)
        LEFT JOIN {_spending(silver)} USING (customer_id)
        GROUP BY state, city)
    WHERE total_orders > 0"""


def review_analytics(silver: str) -> str:
    stars = {name: f"count_if(rating {test}) AS {name}_star_reviews" for name, test in
             (("five", "= 5"), ("four", "= 4"), ("three", "= 3"), ("low", "<= 2"))}
    liked = _ratio("CAST(count_if(rating >= 4) * 100 AS DECIMAL(20,0))", "count(review_id)", 2)
    return f"""
    SELECT book_id, title, author, category, total_reviews, avg_rating, five_star_reviews, four_star_reviews,
        three_star_reviews, low_star_reviews, positive_review_percentage, avg_review_length, total_helpful_votes
    FROM (SELECT book_id, title, author, category FROM {silver}.dim_books)
    JOIN (
        SELECT book_id, count(review_id) AS total_reviews, {_mean('rating', 2)} AS avg_rating, {', '.join(stars.values())},
            {liked} AS positive_review_percentage, {_mean('review_length', 0)} AS avg_review_length,
            sum(helpful_count) AS total_helpful_votes
        FROM {silver}.fact_reviews WHERE is_valid_review GROUP BY book_id) USING (book_id)"""


def statements(silver: str, as_of: AsOf) -> dict[str, str]:
    """The statement of each view, by its name, over the tables of a Silver database."""
    return {
        "vw_sales_by_category": sales_by_category(silver),
        "vw_top_selling_books": top_selling_books(silver),
        "vw_customer_analytics": customer_analytics(silver, as_of),
        "vw_sales_over_time": sales_over_time(silver),
        "vw_payment_analysis": payment_analysis(silver),
        "vw_geographic_analysis": geographic_analysis(silver),
        "vw_review_analytics": review_analytics(silver),
    }
