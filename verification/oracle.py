"""The SQL each registered query is compared with.

Gold outputs are written as the join chains they are defined by, with every
repeated row really produced, to check the pre-aggregated Spark plans against
something built differently.
"""

from __future__ import annotations

from . import oracle_base as b
from .oracle_base import AS_OF, compose, rounded, units

SQL: dict[str, str] = {}

# --- raw feeds and column rules ---------------------------------------------------
SQL["raw_customers"] = compose("raw_customers", "SELECT * EXCLUDE (created_at) FROM raw_customers")
for _t in ("books", "orders", "items", "reviews"):
    SQL[f"raw_{_t}"] = compose(f"raw_{_t}", f"SELECT * FROM raw_{_t}")

_FIELDS = [
    f"coalesce({f}, '')"
    for f in "order_id customer_id order_date total_amount payment_method order_status shipping_cost discount_applied".split()
]
SQL["raw_lines_kept"] = compose(
    "raw_orders",
    f"""SELECT order_id, CASE WHEN NOT short THEN nullif(total_amount, '') END AS total_amount,
    CASE WHEN NOT short THEN nullif(payment_method, '') END AS payment_method,
    CASE WHEN long THEN concat_ws(',', {', '.join(_FIELDS)}, 'beyond')
         WHEN short THEN concat_ws(',', {', '.join(_FIELDS[:3])}) END AS raw_line
    FROM (SELECT *, k % 7 = 0 AS long, k % 7 <> 0 AND k % 11 = 0 AS short
          FROM (SELECT *, order_id[2:]::BIGINT AS k FROM raw_orders))""",
)

_RULES = {
    "customers": (
        "customer_id",
        {
            "clean_name": b.CLEAN_NAME,
            "clean_email": b.CLEAN_EMAIL,
            "valid_email": b.VALID_EMAIL,
            "clean_phone": "nullif(trim(phone), '')",
            "parse_registration_date": f"({b.REG_DAY})::VARCHAR",
            "parse_birth_date": f"({b.BIRTH_DAY})::VARCHAR",
            "age_years": b.age(b.BIRTH_DAY),
            "city_case": b.CITY,
            "state_code": b.STATE,
            "canonical_country": b.COUNTRY_OF,
            "score_customers": units(b.CUSTOMER_SCORE),
        },
    ),
    "books": (
        "book_id",
        {
            "canonical_category": b.CATEGORY_OF,
            "canonical_language": b.LANGUAGE_OF,
            "valid_year": b.YEAR,
            "money_or_null": units(b.PRICE),
            "count_or_zero": b.STOCK,
            "positive_pages": f"CASE WHEN {b.whole('pages')} > 0 THEN {b.whole('pages')} END",
            "catalogue_rating": f"{b.RATING10}::DOUBLE / 10",
            "availability": b.AVAILABLE,
            "score_books": units(b.BOOK_SCORE),
        },
    ),
    "orders": (
        "order_id",
        {
            "parse_order_date": f"({b.ORDER_DAY})::VARCHAR",
            "canonical_status": b.STATUS_OF,
            "canonical_payment": b.PAYMENT_OF,
            "money_or_zero": units(b.plain_or_zero("shipping_cost")),
            "net_amount": units(b.NET),
            "order_validity": b.VALID_ORDER,
            "score_orders": units(b.ORDER_SCORE),
        },
    ),
    "items": (
        "order_item_id",
        {
            "quantity_or_one": b.QUANTITY,
            "calculated_subtotal": units(b.CALCULATED),
            "subtotal_check": b.MATCHES,
        },
    ),
    "reviews": (
        "review_id",
        {
            "review_rating": b.REVIEW_RATING,
            "parse_review_date": f"({b.REVIEW_DAY})::VARCHAR",
            "review_length": "length(trim(review_text))::INTEGER",
            "review_validity": b.VALID_REVIEW,
            "review_validity_strict": f"({b.VALID_REVIEW} AND {b.REVIEW_DAY} IS NOT NULL)",
        },
    ),
}
for _t, (_key, _rules) in _RULES.items():
    for _name, _sql in _rules.items():
        SQL[_name] = compose(f"raw_{_t}", f"SELECT {_key}, {_sql} AS {_name} FROM raw_{_t}")

# --- Silver -------------------------------------------------------------------------
SQL["dedup_customers"] = compose(
    "first_customers", "SELECT * EXCLUDE (created_at) FROM first_customers"
)
SQL["dim_customers"] = compose(
    "dim_customers",
    f"""SELECT * EXCLUDE (score) REPLACE (registration_date::VARCHAR AS registration_date,
    birth_date::VARCHAR AS birth_date), {units('score')} AS data_quality_score FROM dim_customers""",
)
SQL["dim_books"] = compose(
    "dim_books",
    f"""SELECT * EXCLUDE (score) REPLACE ({units('price')} AS price, avg_rating::DOUBLE / 10 AS avg_rating),
    {units('score')} AS data_quality_score FROM dim_books""",
)
_ORDER_MONEY = ", ".join(
    f"{units(m)} AS {m}" for m in ("total_amount", "shipping_cost", "discount_applied", "net_amount")
)
SQL["fact_orders"] = compose(
    "fact_orders",
    f"""SELECT * EXCLUDE (score) REPLACE (order_date::VARCHAR AS order_date, {_ORDER_MONEY}),
    {units('score')} AS data_quality_score FROM fact_orders""",
)
SQL["fact_order_items"] = compose(
    "fact_items",
    "SELECT * REPLACE ("
    + ", ".join(f"{units(m)} AS {m}" for m in ("unit_price", "subtotal", "calculated_subtotal"))
    + ") FROM fact_items",
)
SQL["fact_reviews"] = compose(
    "fact_reviews", "SELECT * REPLACE (review_date::VARCHAR AS review_date) FROM fact_reviews"
)
SQL["surrogate_keys"] = compose(
    "fact_orders", "SELECT order_id, row_number() OVER (ORDER BY order_id) AS order_key FROM fact_orders"
)
SQL["order_quarantine"] = compose(
    "raw_orders dim_customers",
    """SELECT order_id, o.customer_id, CASE WHEN c.customer_id IS NULL THEN 'rejected' ELSE 'kept' END AS status,
    CASE WHEN c.customer_id IS NULL THEN 'customer_id' ELSE '' END AS missing
    FROM raw_orders o LEFT JOIN dim_customers c ON c.customer_id = o.customer_id""",
)
SQL["hashed_surrogate_keys"] = compose(
    "fact_orders",
    """SELECT count(*) AS total_rows, count(*) AS distinct_keys, 1::BIGINT AS lowest_key,
    count(*) AS highest_key FROM fact_orders""",
)

# --- Gold: the full join chains ------------------------------------------------------
_COMPLETED = "is_valid_order AND order_status <> 'Cancelado'"

SALES_BY_CATEGORY = f"""
SELECT category, count(DISTINCT order_id) AS total_orders, count(order_item_id) AS total_items_sold,
  sum(quantity)::BIGINT AS total_quantity, {units('sum(calculated_subtotal)')} AS total_revenue,
  {rounded('sum(calculated_subtotal)', 'count(calculated_subtotal)', 2, 100)} AS avg_order_value,
  {rounded('sum(calculated_subtotal)', 'sum(quantity)', 2, 100)} AS avg_price_per_unit
FROM fact_items JOIN (SELECT order_id FROM fact_orders WHERE {_COMPLETED}) USING (order_id)
JOIN (SELECT book_id, category FROM dim_books) USING (book_id)
GROUP BY ALL"""
SQL["sales_by_category"] = compose("fact_items", SALES_BY_CATEGORY)

_BOOK_CHAIN = f"""
SELECT bk.*, i.quantity, i.calculated_subtotal, o.order_id AS counted_order, r.review_id, r.rating
FROM dim_books bk
LEFT JOIN fact_items i ON i.book_id = bk.book_id
LEFT JOIN (SELECT order_id FROM fact_orders WHERE {_COMPLETED}) o ON o.order_id = i.order_id
LEFT JOIN fact_reviews r ON r.book_id = bk.book_id"""
TOP_BOOKS = f"""
SELECT book_id, title, author, category, {units('price')} AS price, avg_rating::DOUBLE / 10 AS avg_rating,
  count(DISTINCT counted_order) AS times_ordered, coalesce(sum(quantity), 0)::DOUBLE AS total_copies_sold,
  {units('coalesce(sum(calculated_subtotal), 0)')} AS total_revenue,
  {rounded('sum(rating)', 'count(rating)', 1)} AS customer_avg_rating,
  count(DISTINCT review_id) AS total_reviews
FROM book_chain
GROUP BY book_id, title, author, category, dim_price, dim_rating
HAVING sum(quantity) > 0""".replace("dim_price, dim_rating", "price, avg_rating")
_BOOKS = "fact_items fact_reviews"
SQL["top_selling_books"] = compose(_BOOKS, TOP_BOOKS, book_chain=_BOOK_CHAIN)
_BOOK_RANK = "total_copies_sold DESC, total_revenue DESC, book_id"
SQL["top_n_books"] = compose(
    _BOOKS,
    f"SELECT * FROM top_books ORDER BY {_BOOK_RANK} LIMIT 10",
    book_chain=_BOOK_CHAIN,
    top_books=TOP_BOOKS,
)
SQL["top_books_per_category"] = compose(
    _BOOKS,
    f"""SELECT * FROM top_books
    QUALIFY row_number() OVER (PARTITION BY category ORDER BY {_BOOK_RANK}) <= 3""",
    book_chain=_BOOK_CHAIN,
    top_books=TOP_BOOKS,
)

_CUSTOMER_CHAIN = """
SELECT cu.customer_id, cu.full_name, cu.city, cu.state, cu.age, cu.registration_date,
  o.order_id, o.total_amount, o.order_date, i.book_id, i.quantity, r.review_id, r.rating
FROM dim_customers cu
LEFT JOIN (SELECT * FROM fact_orders WHERE is_valid_order) o ON o.customer_id = cu.customer_id
LEFT JOIN fact_items i ON i.order_id = o.order_id
LEFT JOIN fact_reviews r ON r.customer_id = cu.customer_id"""


def _status(last: str) -> str:
    gap = f"date_diff('day', {last}, {AS_OF})"
    return f"CASE WHEN {gap} <= 60 THEN 'Ativo' WHEN {gap} <= 180 THEN 'Em Risco' ELSE 'Inativo' END"


def _tier(spent: str, vip: int = 30000, regular: int = 15000) -> str:
    return f"CASE WHEN {spent} >= {vip} THEN 'VIP' WHEN {spent} >= {regular} THEN 'Regular' ELSE 'Novo' END"


CUSTOMERS = f"""
SELECT customer_id, full_name, city, state, age, registration_date::VARCHAR AS registration_date,
  count(DISTINCT order_id) AS total_orders, {units('sum(total_amount)')} AS total_spent,
  {rounded('sum(total_amount)', 'count(total_amount)', 2, 100)} AS avg_order_value,
  {rounded('sum(total_amount)', 'count(DISTINCT order_id)', 2, 100)} AS avg_per_order,
  count(DISTINCT book_id) AS unique_books_purchased,
  coalesce(sum(quantity), 0)::DOUBLE AS total_books_quantity,
  count(DISTINCT review_id) AS total_reviews_written,
  {rounded('sum(rating)', 'count(rating)', 1)} AS avg_rating_given,
  max(order_date)::VARCHAR AS last_order_date,
  date_diff('day', max(order_date), {AS_OF})::INTEGER AS days_since_last_order,
  {_status('max(order_date)')} AS customer_status, {_tier('sum(total_amount)')} AS customer_tier
FROM customer_chain
GROUP BY customer_id, full_name, city, state, age, customer_chain.registration_date
HAVING count(order_id) > 0"""
_ALL = "dim_customers fact_items fact_reviews"
SQL["customer_analytics"] = compose(_ALL, CUSTOMERS, customer_chain=_CUSTOMER_CHAIN)
SQL["at_risk_customers"] = compose(
    _ALL,
    "SELECT * FROM customers WHERE customer_status = 'Em Risco'",
    customer_chain=_CUSTOMER_CHAIN,
    customers=CUSTOMERS,
)
SQL["rfm_segment"] = compose(
    "fact_orders",
    f"""SELECT customer_id, {_status('max(order_date)')} AS customer_status,
    {_tier('sum(total_amount)', 150_000_000, 75_000_000)} AS customer_tier
    FROM fact_orders WHERE is_valid_order GROUP BY customer_id""",
)

_SALES_CHAIN = f"""
SELECT o.*, i.quantity FROM fact_orders o JOIN fact_items i ON i.order_id = o.order_id WHERE {_COMPLETED}"""
_PERIOD = f"""count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
  sum(quantity)::BIGINT AS total_items_sold, {units('sum(shipping_cost)')} AS total_shipping,
  {units('sum(discount_applied)')} AS total_discounts, {units('sum(net_amount)')} AS net_revenue,
  {rounded('sum(total_amount)', 'count(total_amount)', 2, 100)} AS avg_order_value,
  {units('sum(total_amount)')}"""
_MONTH = """strftime(order_date, '%Y-%m') AS yearmonth, year(order_date)::INTEGER AS year,
  month(order_date)::INTEGER AS month, strftime(order_date, '%B') AS month_name"""
OVER_TIME = f"""
SELECT {_MONTH}, {_PERIOD} AS gross_revenue,
  {rounded('sum(total_amount)', 'count(DISTINCT customer_id)', 2, 100)} AS revenue_per_customer
FROM sales_chain GROUP BY yearmonth, year, month, month_name"""
SQL["sales_over_time"] = compose("fact_items", OVER_TIME, sales_chain=_SALES_CHAIN)


def _daily(source: str, period: str) -> str:
    return f"""
SELECT order_date::VARCHAR AS metric_date, {period} AS total_revenue
FROM {source} GROUP BY {source}.order_date"""


SQL["daily_metrics"] = compose(
    "fact_items", _daily("sales_chain", _PERIOD), sales_chain=_SALES_CHAIN
)
PAYMENTS = f"""
SELECT payment_method, count(DISTINCT order_id) AS total_orders, {units('sum(total_amount)')} AS total_revenue,
  {rounded('sum(total_amount)', 'count(total_amount)', 2, 100)} AS avg_order_value,
  {units('sum(discount_applied)')} AS total_discounts,
  {rounded('100 * count(DISTINCT order_id)', '(SELECT count(*) FROM fact_orders WHERE is_valid_order)', 2)} AS percentage_of_orders,
  {rounded('100 * sum(total_amount)', '(SELECT sum(total_amount) FROM fact_orders WHERE is_valid_order)', 2)} AS percentage_of_revenue
FROM fact_orders WHERE {_COMPLETED} GROUP BY payment_method"""
SQL["payment_analysis"] = compose("fact_orders", PAYMENTS)

_PLACE_CHAIN = """
SELECT cu.state, cu.city, cu.customer_id, o.order_id, o.total_amount, i.quantity
FROM dim_customers cu
LEFT JOIN (SELECT * FROM fact_orders WHERE is_valid_order) o ON o.customer_id = cu.customer_id
LEFT JOIN fact_items i ON i.order_id = o.order_id"""
PLACES = f"""
SELECT state, city, count(DISTINCT customer_id) AS total_customers, count(DISTINCT order_id) AS total_orders,
  coalesce(sum(quantity), 0)::BIGINT AS total_books_sold,
  {units('coalesce(sum(total_amount), 0)')} AS total_revenue,
  {rounded('sum(total_amount)', 'count(total_amount)', 2, 100)} AS avg_order_value,
  {rounded('sum(total_amount)', 'count(DISTINCT customer_id)', 2, 100)} AS revenue_per_customer,
  {rounded('count(DISTINCT order_id)', 'count(DISTINCT customer_id)', 2)} AS orders_per_customer
FROM place_chain GROUP BY state, city HAVING count(order_id) > 0"""
SQL["geographic_analysis"] = compose(
    "dim_customers fact_items", PLACES, place_chain=_PLACE_CHAIN
)

REVIEWED = f"""
SELECT book_id, title, author, category, count(review_id) AS total_reviews,
  {rounded('sum(rating)', 'count(rating)', 2)} AS avg_rating,
  count(*) FILTER (rating = 5) AS five_star_reviews, count(*) FILTER (rating = 4) AS four_star_reviews,
  count(*) FILTER (rating = 3) AS three_star_reviews, count(*) FILTER (rating <= 2) AS low_star_reviews,
  {rounded('100 * count(*) FILTER (rating >= 4)', 'count(review_id)', 2)} AS positive_review_percentage,
  {rounded('sum(review_length)', 'count(review_length)', 0)} AS avg_review_length,
  sum(helpful_count)::BIGINT AS total_helpful_votes
FROM (SELECT * EXCLUDE (avg_rating) FROM dim_books)
JOIN (SELECT * FROM fact_reviews WHERE is_valid_review) USING (book_id)
GROUP BY book_id, title, author, category"""
SQL["review_analytics"] = compose("fact_reviews", REVIEWED)
SQL["premium_catalogue"] = compose(
    "fact_reviews",
    "SELECT * FROM reviewed WHERE avg_rating >= 4.5 AND total_reviews >= 2",
    reviewed=REVIEWED,
)
SQL["delivered_orders"] = compose(
    "fact_orders",
    f"""SELECT * EXCLUDE (score) REPLACE (order_date::VARCHAR AS order_date, {_ORDER_MONEY}),
    {units('score')} AS data_quality_score FROM fact_orders
    WHERE strftime(fact_orders.order_date, '%Y-%m') = '2001-05' AND order_status = 'Entregue'""",
)

_POPULAR = """
SELECT author, title AS most_popular_book, copies
FROM (SELECT book_id, author, title, coalesce(sum(quantity), 0)::BIGINT AS copies
      FROM dim_books LEFT JOIN fact_items USING (book_id) GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY author ORDER BY copies DESC, title, book_id) = 1"""
_MODAL = """
SELECT author, category AS most_popular_category
FROM (SELECT author, category, count(*) AS n FROM dim_books GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY author ORDER BY n DESC, category) = 1"""
SQL["popular_book"] = compose("fact_items", "SELECT * FROM popular", popular=_POPULAR)
SQL["modal_category"] = compose("dim_books", "SELECT * FROM modal", modal=_MODAL)
_AUTHOR_CHAIN = """
SELECT bk.author, bk.book_id, bk.avg_rating, i.quantity, i.calculated_subtotal, r.review_id
FROM dim_books bk
LEFT JOIN fact_items i ON i.book_id = bk.book_id
LEFT JOIN fact_reviews r ON r.book_id = bk.book_id"""
AUTHORS = f"""
SELECT author AS author_name, total_books, total_copies_sold, total_revenue, avg_book_rating,
  total_reviews, most_popular_book, most_popular_category
FROM (SELECT author, count(DISTINCT book_id) AS total_books,
        coalesce(sum(quantity), 0)::DOUBLE AS total_copies_sold,
        {units('coalesce(sum(calculated_subtotal), 0)')} AS total_revenue,
        {rounded('sum(avg_rating)', 'count(avg_rating)', 2, 10)} AS avg_book_rating,
        count(DISTINCT review_id) AS total_reviews
      FROM author_chain GROUP BY author)
JOIN (SELECT author, most_popular_book FROM popular) USING (author) JOIN modal USING (author)"""
_AUTHOR_PARTS = {"popular": _POPULAR, "modal": _MODAL, "author_chain": _AUTHOR_CHAIN}
SQL["author_performance"] = compose(_BOOKS, AUTHORS, **_AUTHOR_PARTS)
SQL["author_performance_table"] = compose(
    _BOOKS,
    """SELECT row_number() OVER (ORDER BY total_revenue DESC, author_name) AS author_id, author_name,
    total_books, total_copies_sold, total_revenue, avg_book_rating, total_reviews, most_popular_book,
    most_popular_category
    FROM authors""",
    **_AUTHOR_PARTS,
    authors=AUTHORS,
)

# --- Gold without multiplied sums: facts summed where they live ------------------------
_SOLD = f"""
SELECT i.* FROM fact_items i
WHERE i.order_id IN (SELECT order_id FROM fact_orders WHERE {_COMPLETED})"""
_RATED = f"""
SELECT book_id, {rounded('sum(rating)', 'count(rating)', 1)} AS customer_avg_rating,
  count(*) AS total_reviews FROM fact_reviews GROUP BY book_id"""
SQL["top_selling_books_grain_safe"] = compose(
    _BOOKS,
    f"""SELECT book_id, title, author, category, {units('price')} AS price,
    avg_rating::DOUBLE / 10 AS avg_rating, times_ordered, total_copies_sold, total_revenue,
    customer_avg_rating, coalesce(total_reviews, 0) AS total_reviews
    FROM dim_books JOIN (SELECT book_id, count(DISTINCT order_id) AS times_ordered,
      sum(quantity)::BIGINT AS total_copies_sold, {units('sum(calculated_subtotal)')} AS total_revenue
      FROM sold GROUP BY book_id) USING (book_id)
    LEFT JOIN rated USING (book_id) WHERE total_copies_sold > 0""",
    sold=_SOLD,
    rated=_RATED,
)
_BASKETS = "SELECT order_id, sum(quantity) AS quantity FROM fact_items GROUP BY order_id"
_SPENT = f"""
SELECT customer_id, count(*) AS total_orders, sum(total_amount) AS spent, count(total_amount) AS priced,
  coalesce(sum(quantity), 0)::BIGINT AS quantity, max(order_date) AS last_order
FROM fact_orders LEFT JOIN baskets USING (order_id) WHERE is_valid_order GROUP BY customer_id"""
SQL["customer_analytics_grain_safe"] = compose(
    _ALL,
    f"""SELECT customer_id, full_name, city, state, age, registration_date::VARCHAR AS registration_date,
    total_orders, {units('spent')} AS total_spent,
    {rounded('spent', 'priced', 2, 100)} AS avg_order_value,
    coalesce(unique_books, 0) AS unique_books_purchased, quantity AS total_books_quantity,
    coalesce(reviews, 0) AS total_reviews_written, avg_rating_given,
    last_order::VARCHAR AS last_order_date,
    date_diff('day', last_order, {AS_OF})::INTEGER AS days_since_last_order,
    {_status('last_order')} AS customer_status, {_tier('spent')} AS customer_tier
    FROM dim_customers JOIN spent_by USING (customer_id)
    LEFT JOIN (SELECT customer_id, count(DISTINCT book_id) AS unique_books
               FROM fact_orders JOIN fact_items USING (order_id) WHERE is_valid_order
               GROUP BY customer_id) USING (customer_id)
    LEFT JOIN (SELECT customer_id, count(*) AS reviews,
               {rounded('sum(rating)', 'count(rating)', 1)} AS avg_rating_given
               FROM fact_reviews GROUP BY customer_id) USING (customer_id)""",
    baskets=_BASKETS,
    spent_by=_SPENT,
)
_SALES = f"""
SELECT fact_orders.*, quantity FROM fact_orders LEFT JOIN baskets USING (order_id) WHERE {_COMPLETED}"""
_PERIOD_SAFE = _PERIOD.replace("sum(quantity)::BIGINT", "coalesce(sum(quantity), 0)::BIGINT")
SQL["sales_over_time_grain_safe"] = compose(
    "fact_items",
    f"""SELECT {_MONTH}, {_PERIOD_SAFE} AS gross_revenue,
    {rounded('sum(total_amount)', 'count(DISTINCT customer_id)', 2, 100)} AS revenue_per_customer
    FROM sales GROUP BY yearmonth, year, month, month_name""",
    baskets=_BASKETS,
    sales=_SALES,
)
SQL["daily_metrics_grain_safe"] = compose(
    "fact_items", _daily("sales", _PERIOD_SAFE), baskets=_BASKETS, sales=_SALES
)
SQL["geographic_analysis_grain_safe"] = compose(
    "dim_customers fact_items",
    f"""SELECT state, city, count(*) AS total_customers, sum(total_orders)::BIGINT AS total_orders,
    sum(quantity)::BIGINT AS total_books_sold, {units('sum(spent)')} AS total_revenue,
    {rounded('sum(spent)', 'sum(total_orders)', 2, 100)} AS avg_order_value,
    {rounded('sum(spent)', 'count(*)', 2, 100)} AS revenue_per_customer,
    {rounded('sum(total_orders)', 'count(*)', 2)} AS orders_per_customer
    FROM dim_customers LEFT JOIN spent_by USING (customer_id)
    GROUP BY state, city HAVING sum(total_orders) > 0""",
    baskets=_BASKETS,
    spent_by=_SPENT,
)
SQL["author_performance_grain_safe"] = compose(
    _BOOKS,
    f"""SELECT author AS author_name, count(*) AS total_books, sum(copies)::BIGINT AS total_copies_sold,
    {units('sum(revenue)')} AS total_revenue,
    {rounded('sum(avg_rating)', 'count(avg_rating)', 2, 10)} AS avg_book_rating,
    sum(reviews)::BIGINT AS total_reviews,
    first(title ORDER BY copies DESC, title, book_id) AS most_popular_book,
    any_value(most_popular_category) AS most_popular_category
    FROM (SELECT author, title, book_id, avg_rating, coalesce(copies, 0) AS copies,
            coalesce(revenue, 0) AS revenue, coalesce(total_reviews, 0) AS reviews
          FROM dim_books
          LEFT JOIN (SELECT book_id, sum(quantity) AS copies, sum(calculated_subtotal) AS revenue
                     FROM fact_items WHERE order_id IN (SELECT order_id FROM fact_orders WHERE is_valid_order)
                     GROUP BY book_id) USING (book_id)
          LEFT JOIN rated USING (book_id))
    JOIN modal USING (author) GROUP BY author""",
    rated=_RATED,
    modal=_MODAL,
)

# --- first generation --------------------------------------------------------------------
_OLD_SCORE = b.score(
    w20_1="coalesce(customer_id <> '', false)",
    w20_2=b.VALID_EMAIL,
    w20_3="coalesce(phone <> '', false)",
    w20_4="registration_date IS NOT NULL",
    w20_5="birth_date IS NOT NULL",
)
SQL["dim_customers_original"] = compose(
    "raw_customers",
    f"""SELECT DISTINCT customer_id, {b.CLEAN_NAME} AS full_name, {b.CLEAN_EMAIL} AS email,
    {b.VALID_EMAIL} AS email_valid, trim(phone) AS phone, ({b.REG_DAY})::VARCHAR AS registration_date,
    {b.CITY} AS city, {b.STATE} AS state, {b.COUNTRY_OF} AS country, ({b.BIRTH_DAY})::VARCHAR AS birth_date,
    {b.age(b.BIRTH_DAY)} AS age, {units(_OLD_SCORE)} AS data_quality_score
    FROM raw_customers WHERE customer_id IS NOT NULL""",
)
_OLD_CATEGORY = b.lookup("r.category", {**b.CATEGORY, "Ficção": ("ficcao",)}, "trim(r.category)")
SQL["dim_books_original"] = compose(
    "raw_books dim_books",
    f"""SELECT d.* EXCLUDE (score) REPLACE ({units('d.price')} AS price, d.avg_rating::DOUBLE / 10 AS avg_rating,
      {_OLD_CATEGORY} AS category, coalesce(TRY_CAST(r.stock_quantity AS INTEGER) > 0
      AND {b.cents('r.price')} > 0, false) AS is_available), {units('d.score')} AS data_quality_score
    FROM dim_books d JOIN raw_books r USING (book_id)""",
)


def _old_charge(x: str) -> str:
    return units(f"greatest(coalesce({b.cents(x)}, 0), 0)")


SQL["fact_orders_original"] = compose(
    "raw_orders fact_orders",
    f"""SELECT d.* EXCLUDE (score) REPLACE (d.order_date::VARCHAR AS order_date,
      {units('d.total_amount')} AS total_amount, {_old_charge('r.shipping_cost')} AS shipping_cost,
      {_old_charge('r.discount_applied')} AS discount_applied, {units('d.net_amount')} AS net_amount,
      coalesce(r.total_amount <> '' AND {b.cents('r.total_amount')} > 0
        AND try_strptime(r.order_date, '%Y-%m-%d')::DATE <= {AS_OF}, false) AS is_valid_order),
      {units('d.score')} AS data_quality_score
    FROM fact_orders d JOIN raw_orders r USING (order_id)""",
)
_OLD_PRODUCT = f"(TRY_CAST(quantity AS INTEGER) * {b.cents('unit_price')})"
# From the raw rows: item ids need not be unique, so the cleaned table cannot be joined back.
SQL["fact_order_items_original"] = compose(
    "raw_items fact_orders dim_books",
    f"""SELECT order_item_id, order_id, book_id, {b.QUANTITY} AS quantity, {units(b.UNIT)} AS unit_price,
      {units(b.SUBTOTAL)} AS subtotal, {units(_OLD_PRODUCT)} AS calculated_subtotal,
      coalesce(abs({b.cents('subtotal')} - {_OLD_PRODUCT}) < 1, false) AS subtotal_matches
    FROM raw_items WHERE order_id IN (SELECT order_id FROM fact_orders)
      AND book_id IN (SELECT book_id FROM dim_books)""",
)
SQL["fact_reviews_original"] = compose(
    "raw_reviews fact_reviews",
    """SELECT d.* REPLACE (d.review_date::VARCHAR AS review_date,
      (d.rating IS NOT NULL AND coalesce(trim(r.review_text) <> '', false)
       AND r.review_date IS NOT NULL) AS is_valid_review)
    FROM fact_reviews d JOIN raw_reviews r USING (review_id)""",
)
_SOLD_CHAIN = f"""
SELECT bk.*, i.quantity, i.calculated_subtotal, o.order_id AS counted_order, r.review_id, r.rating
FROM dim_books bk JOIN fact_items i ON i.book_id = bk.book_id
JOIN (SELECT order_id FROM fact_orders WHERE {_COMPLETED}) o ON o.order_id = i.order_id
LEFT JOIN fact_reviews r ON r.book_id = bk.book_id"""
SQL["top_selling_books_original"] = compose(
    _BOOKS, TOP_BOOKS.split("HAVING")[0], book_chain=_SOLD_CHAIN
)
SQL["customer_analytics_original"] = compose(
    _ALL,
    CUSTOMERS.replace("coalesce(sum(quantity), 0)::DOUBLE", "sum(quantity)::DOUBLE"),
    customer_chain=_CUSTOMER_CHAIN,
)
SQL["geographic_analysis_original"] = compose(
    "dim_customers fact_items",
    PLACES.replace("coalesce(sum(quantity), 0)::BIGINT", "sum(quantity)::BIGINT"),
    place_chain=_PLACE_CHAIN + " WHERE o.order_id IS NOT NULL",
)
_VALID_AUTHOR_CHAIN = """
SELECT bk.author, bk.book_id, bk.avg_rating, i.quantity, i.calculated_subtotal, r.review_id
FROM dim_books bk
LEFT JOIN fact_items i ON i.book_id = bk.book_id
LEFT JOIN fact_orders o ON o.order_id = i.order_id
LEFT JOIN fact_reviews r ON r.book_id = bk.book_id
WHERE o.is_valid_order OR o.order_id IS NULL"""
SQL["author_performance_original"] = compose(
    _BOOKS, AUTHORS, **{**_AUTHOR_PARTS, "author_chain": _VALID_AUTHOR_CHAIN}
)

# --- quality ---------------------------------------------------------------------------
_LABELS = {
    "customers": "Clientes",
    "books": "Livros",
    "orders": "Pedidos",
    "items": "Itens de Pedido",
    "reviews": "Avaliações",
}
_RAW = " ".join(f"raw_{t}" for t in _LABELS)
_SILVER = {
    "customers": "dim_customers",
    "books": "dim_books",
    "orders": "fact_orders",
    "items": "fact_items",
    "reviews": "fact_reviews",
}
_SILVER_ALL = " ".join(_SILVER.values())


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


SQL["dq_bronze_counts"] = compose(
    _RAW,
    union([f"SELECT '{n}' AS entidade, count(*) AS total FROM raw_{t}" for t, n in _LABELS.items()]),
)
_SOUND = {
    "customers": ("score", None),
    "books": ("score", None),
    "orders": ("score", "is_valid_order"),
    "items": (None, "subtotal_matches"),
    "reviews": (None, "is_valid_review"),
}
SQL["dq_silver_summary"] = compose(
    _SILVER_ALL,
    union(
        [
            f"SELECT '{_LABELS[t]}' AS entidade, count(*) AS total,"
            f" {rounded('sum(score)', 'count(*)', 2, 100) if s else 'NULL::DOUBLE'} AS qualidade_media,"
            f" {f'count(*) FILTER ({v})' if v else 'NULL::BIGINT'} AS validos FROM {_SILVER[t]}"
            for t, (s, v) in _SOUND.items()
        ]
    ),
)
_SCORED = ("customers", "books", "orders")
SQL["dq_score_report"] = compose(
    _SILVER_ALL,
    union(
        [
            f"SELECT '{_LABELS[t]}' AS entidade, count(*) AS total,"
            f" {rounded('sum(score)', 'count(*)', 2, 100)} AS score_medio,"
            f" {units('min(score)')} AS score_min, {units('max(score)')} AS score_max FROM {_SILVER[t]}"
            for t in _SCORED
        ]
    ),
)
SQL["dq_score_audit"] = compose(
    _SILVER_ALL,
    union(
        [
            f"SELECT '{_LABELS[t]}' AS entidade, count(*) AS total,"
            f" {rounded('sum(score)', 'count(*)', 3, 100)} AS score_medio,"
            f" count(*) FILTER (score = 100) AS perfeitos, count(*) FILTER (score < 60) AS criticos"
            f" FROM {_SILVER[t]}"
            for t in _SCORED
        ]
    ),
)
SQL["dq_invalid_reasons"] = compose(
    "fact_orders",
    """SELECT order_id, if(total_amount IS NULL, 'Sem valor', NULL) AS motivo_valor,
    if(order_date IS NULL, 'Data inválida', NULL) AS motivo_data,
    if(order_status = 'Cancelado', 'Cancelado', NULL) AS motivo_status
    FROM fact_orders WHERE NOT is_valid_order""",
)
SQL["dq_score_bands"] = compose(
    "dim_customers",
    """SELECT CASE WHEN score >= 100 THEN '1.0 (Perfeito)' WHEN score >= 80 THEN '0.8–0.9 (Bom)'
      WHEN score >= 60 THEN '0.6–0.7 (Regular)' ELSE '< 0.6 (Crítico)' END AS faixa_score,
    count(*) AS quantidade FROM dim_customers GROUP BY faixa_score""",
)
_GOLD = {
    "sales_by_category": SALES_BY_CATEGORY,
    "top_selling_books": TOP_BOOKS,
    "customer_analytics": CUSTOMERS,
    "sales_over_time": OVER_TIME,
    "payment_analysis": PAYMENTS,
    "geographic_analysis": PLACES,
    "review_analytics": REVIEWED,
}
_CHAINS = {
    "book_chain": _BOOK_CHAIN,
    "customer_chain": _CUSTOMER_CHAIN,
    "sales_chain": _SALES_CHAIN,
    "place_chain": _PLACE_CHAIN,
    **_AUTHOR_PARTS,
}
_GOLD_TABLES = {
    **_GOLD,
    "daily_metrics": _daily("sales_chain", _PERIOD),
    "author_performance": AUTHORS,
}
SQL["dq_gold_counts"] = compose(
    _SILVER_ALL,
    union([f"SELECT '{n}' AS output, count(*) AS total FROM ({q})" for n, q in _GOLD_TABLES.items()]),
    **_CHAINS,
)
_filled = " + ".join(f"(SELECT (count(*) > 0)::INTEGER FROM ({q}))" for q in _GOLD.values())
SQL["dq_kpis"] = compose(
    _SILVER_ALL + " raw_customers",
    f"""SELECT *, value >= target AS met FROM (
    SELECT 'deduplication_rate' AS kpi, {rounded('100 * (SELECT count(DISTINCT customer_id) FROM raw_customers)', 'count(*)', 2)} AS value,
      100.0::DOUBLE AS target FROM dim_customers
    UNION ALL SELECT 'score_coverage', {rounded('100 * count(score)', 'count(*)', 2)}, 100
      FROM (SELECT score FROM dim_customers UNION ALL SELECT score FROM dim_books
            UNION ALL SELECT score FROM fact_orders)
    UNION ALL SELECT 'valid_orders', {rounded('100 * count(*) FILTER (is_valid_order)', 'count(*)', 2)}, 80 FROM fact_orders
    UNION ALL SELECT 'gold_outputs_filled', {rounded(f'100 * ({_filled})', '7', 2)}, 100
    UNION ALL SELECT 'category_consistency',
      {rounded(f"100 * count(DISTINCT {b.fold('category')})", 'count(category)', 2)}, 100
      FROM (SELECT DISTINCT category FROM dim_books))""",
    **_CHAINS,
)
_IDS = {
    "customers": "customer_id",
    "books": "book_id",
    "orders": "order_id",
    "items": "order_item_id",
    "reviews": "review_id",
}


def _repeated(tables: dict[str, str]) -> str:
    return union(
        [
            f"SELECT '{_LABELS[t]}' AS entidade, {_IDS[t]} AS key, count(*) AS copies"
            f" FROM {table} WHERE {_IDS[t]} IS NOT NULL GROUP BY {_IDS[t]} HAVING count(*) > 1"
            for t, table in tables.items()
        ]
    )


SQL["dq_duplicate_keys"] = compose(_RAW, _repeated({t: f"raw_{t}" for t in _LABELS}))
SQL["dq_silver_duplicate_keys"] = compose(_SILVER_ALL, _repeated(_SILVER))
_REFS = [
    ("orders", "customers", "customer_id"),
    ("items", "orders", "order_id"),
    ("items", "books", "book_id"),
    ("reviews", "books", "book_id"),
    ("reviews", "customers", "customer_id"),
]
SQL["dq_orphans"] = compose(
    _SILVER_ALL,
    union(
        [
            f"SELECT '{_LABELS[child]}' AS entidade, '{key}' AS foreign_key, {_IDS[child]} AS row_id,"
            f" {key} AS missing_key FROM raw_{child} r WHERE NOT EXISTS"
            f" (SELECT 1 FROM {_SILVER[parent]} p WHERE p.{key} = r.{key})"
            for child, parent, key in _REFS
        ]
    ),
)


def _differs(raw: str, clean: str) -> str:
    return f"coalesce({raw} <> {clean}, false)"


_ISSUES = {
    "customers": {
        "invalid_email": f"NOT {b.VALID_EMAIL}",
        "missing_phone": "coalesce(phone, '') = ''",
        "padded_name": _differs("full_name", b.CLEAN_NAME),
        "registration_date_spelling": f"NOT {b.shaped('registration_date', 'Y-m-d')}",
        "birth_date_spelling": f"NOT {b.shaped('birth_date', 'Y-m-d')}",
        "city_spelling": _differs("city", b.CITY),
        "state_spelling": _differs("state", b.STATE),
        "country_spelling": _differs("country", b.COUNTRY_OF),
    },
    "books": {
        "negative_price": f"coalesce({b.cents('price')} < 0, false)",
        "unreadable_price": f"{b.cents('price')} IS NULL",
        "no_stock": f"coalesce({b.STOCK} = 0, false)",
        "stock_too_wide": b.wide("stock_quantity"),
        "year_out_of_range": f"{b.YEAR} IS NULL",
        "rating_out_of_range": f"{b.RATING10} IS NULL",
        "category_spelling": _differs("category", b.CATEGORY_OF),
        "language_spelling": _differs("language_code", b.LANGUAGE_OF),
    },
    "orders": {
        "missing_amount": "coalesce(total_amount, '') = ''",
        "unreadable_date": f"{b.day('order_date', 'Y-m-d', 'd/m/Y')} IS NULL",
        "future_date": f"coalesce({b.day('order_date', 'Y-m-d', 'd/m/Y')} > {AS_OF}, false)",
        "missing_shipping": "coalesce(shipping_cost, '') = ''",
        "status_spelling": _differs("order_status", b.STATUS_OF),
        "payment_spelling": _differs("payment_method", b.PAYMENT_OF),
    },
    "items": {
        "quantity_replaced": f"coalesce({b.whole('quantity')}, 0) = 0 AND NOT {b.wide('quantity')}",
        "quantity_too_wide": b.wide("quantity"),
        "price_unusable": f"{b.UNIT} IS NULL",
        "subtotal_mismatch": f"NOT {b.MATCHES}",
    },
    "reviews": {
        "rating_out_of_range": f"{b.REVIEW_RATING} IS NULL",
        "blank_text": "coalesce(trim(review_text), '') = ''",
        "unusable_date": f"{b.REVIEW_DAY} IS NULL",
        "date_spelling": b.shaped("review_date", "d-m-Y"),
    },
}
SQL["dq_issue_profile"] = compose(
    _RAW,
    "SELECT entidade, rule, total, affected, "
    + rounded("100 * affected", "total", 2)
    + " AS affected_percentage FROM ("
    + union(
        [
            f"SELECT '{_LABELS[t]}' AS entidade, '{rule}' AS rule, count(*) AS total,"
            f" count(*) FILTER ({cond}) AS affected FROM raw_{t}"
            for t, found in _ISSUES.items()
            for rule, cond in found.items()
        ]
    )
    + ")",
)
_PROBLEMS = {
    t: "concat_ws(',', " + ", ".join(f"CASE WHEN {cond} THEN '{rule}' END" for rule, cond in found.items()) + ")"
    for t, found in _ISSUES.items()
}
SQL["dq_issue_combinations"] = compose(
    _RAW,
    union(
        [
            f"SELECT '{_LABELS[t]}' AS entidade, {found} AS problems, count(*) AS total FROM raw_{t} GROUP BY problems"
            for t, found in _PROBLEMS.items()
        ]
    ),
)
SQL["dq_issue_summary"] = compose(
    _RAW,
    f"SELECT *, {rounded('100 * with_problem', 'total', 2)} AS problem_percentage FROM ("
    + union(
        [
            f"SELECT '{_LABELS[t]}' AS entidade, count(*) AS total, count(*) FILTER ({found} <> '') AS with_problem,"
            f" count({_IDS[t]}) - count(DISTINCT {_IDS[t]}) AS repeated_ids FROM raw_{t}"
            for t, found in _PROBLEMS.items()
        ]
    )
    + ")",
)
SQL["dq_value_variants"] = compose(
    "raw_books",
    f"""SELECT {b.CATEGORY_OF} AS canonical, count(DISTINCT category) AS variants, count(*) AS total_rows
    FROM raw_books GROUP BY canonical""",
)
SQL["dq_spellings"] = compose(
    "raw_orders",
    f"""SELECT {b.PAYMENT_OF} AS canonical, payment_method AS spelling, count(*) AS total_rows
    FROM raw_orders GROUP BY canonical, spelling""",
)
SQL["dq_rating_distribution"] = compose(
    "fact_reviews", "SELECT rating, count(*) AS total_reviews FROM fact_reviews GROUP BY rating"
)
SQL["dq_row_reconciliation"] = compose(
    _SILVER_ALL,
    "SELECT *, bronze_rows - silver_rows AS dropped_rows FROM ("
    + union(
        [
            f"SELECT '{_LABELS[t]}' AS entidade, (SELECT count(*) FROM raw_{t}) AS bronze_rows,"
            f" (SELECT count(*) FROM {_SILVER[t]}) AS silver_rows"
            for t in _LABELS
        ]
    )
    + ")",
)

# --- streams: the same rows as the batch builds -----------------------------------------
SQL["stream_raw_reviews"] = SQL["raw_reviews"]
SQL["stream_fact_orders"] = SQL["fact_orders"]
SQL["stream_fact_reviews"] = SQL["fact_reviews"]
SQL["stream_customer_keys"] = compose(
    "first_customers", "SELECT customer_id FROM first_customers"
)

# Streams merged over several deliveries give what one batch over everything gives.
SQL["stream_dim_customers"] = SQL["dim_customers"]
SQL["stream_daily_metrics"] = f"""
SELECT ts::DATE::VARCHAR AS metric_date, count(*) AS total_events,
  count(*) FILTER (event_type = 'purchase') AS purchases,
  {units('sum(round(value * 100)::BIGINT)')} AS total_value
FROM events WHERE ts IS NOT NULL GROUP BY ts::DATE"""
SQL["delivered_orders_by_month"] = SQL["delivered_orders"]
SQL["daily_metrics_by_month"] = SQL["daily_metrics"]
for _view in (
    "sales_by_category", "top_selling_books", "customer_analytics", "sales_over_time",
    "payment_analysis", "geographic_analysis", "review_analytics",
):
    SQL[f"stored_view_{_view}"] = SQL[_view]

for _name in ("country", "category", "status", "language", "payment"):
    SQL[f"mapped_canonical_{_name}"] = SQL[f"canonical_{_name}"]
SQL["monthly_customers"] = compose(
    "fact_orders",
    f"""SELECT strftime(order_date, '%Y-%m') AS yearmonth, count(DISTINCT customer_id) AS unique_customers
    FROM fact_orders WHERE {_COMPLETED} GROUP BY yearmonth""",
)
