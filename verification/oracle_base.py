"""Raw feeds and Silver tables as DuckDB common table expressions.

Money is held in whole cents, scores in hundredths and catalogue ratings in
tenths, so that every comparison value is computed on integers.
"""

from __future__ import annotations

AS_OF = "DATE '2001-06-30'"
# Text shapes.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
SHAPES = {
    "Y-m-d": ("^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "%Y-%m-%d"),
    "Y/m/d": ("^[0-9]{4}/[0-9]{2}/[0-9]{2}$", "%Y/%m/%d"),
    "d/m/Y": ("^[0-9]{2}/[0-9]{2}/[0-9]{4}$", "%d/%m/%Y"),
    "d-m-Y": ("^[0-9]{2}-[0-9]{2}-[0-9]{4}$", "%d-%m-%Y"),
}


def pick(key: str, *options: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options))
    return f"(CASE ({key}) % {len(options)} {whens} END)"


def money_text(cents: str) -> str:
    return f"(({cents}) // 100 || '.' || lpad((({cents}) % 100)::VARCHAR, 2, '0'))"


def day(x: str, *shapes: str) -> str:
    whens = " ".join(
        f"WHEN regexp_matches({x}, '{SHAPES[s][0]}') THEN try_strptime({x}, '{SHAPES[s][1]}')::DATE"
        for s in shapes
    )
    return f"(CASE {whens} END)"


def past_day(x: str, *shapes: str) -> str:
    d = day(x, *shapes)
    return f"(CASE WHEN {d} <= {AS_OF} THEN {d} END)"


def shaped(x: str, *shapes: str) -> str:
    return "(" + " OR ".join(f"coalesce(regexp_matches({x}, '{SHAPES[s][0]}'), false)" for s in shapes) + ")"


def age(b: str) -> str:
    return (
        f"(year({AS_OF}) - year({b}) - CASE WHEN (month({b}), day({b})) >"
        f" (month({AS_OF}), day({AS_OF})) THEN 1 ELSE 0 END)::INTEGER"
    )


def cents(x: str) -> str:
    return f"CAST(TRY_CAST({x} AS DECIMAL(10,2)) * 100 AS BIGINT)"


def tenths(x: str) -> str:
    return f"CAST(TRY_CAST({x} AS DECIMAL(2,1)) * 10 AS INTEGER)"


def whole(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '^[0-9]+$') THEN TRY_CAST({x} AS INTEGER) END)"


def wide(x: str) -> str:
    """Digits for a number that no count column holds."""
    return f"coalesce(regexp_matches({x}, '^[0-9]+$') AND TRY_CAST({x} AS INTEGER) IS NULL, false)"


def fold(x: str) -> str:
    return f"strip_accents(lower(trim({x})))"


def score(**weighted: str) -> str:
    """Hundredths; keys are ``w<weight>_<n>``."""
    terms = [
        f"CASE WHEN {cond} THEN {name.split('_')[0][1:]} ELSE 0 END" for name, cond in weighted.items()
    ]
    return "(" + " + ".join(terms) + ")"




def lookup(x: str, table: dict[str, tuple[str, ...]], otherwise: str) -> str:
    whens = " ".join(
        f"WHEN {fold(x)} IN ({', '.join(repr(v) for v in variants)}) THEN '{name}'"
        for name, variants in table.items()
    )
    return f"(CASE {whens} ELSE {otherwise} END)"


# Spellings, in comparison form (lower case, no accents).
CATEGORY = {
    "Fantasia": ("fantasia",),
    "Ficção Científica": ("ficcao cientifica",),
    "Ficção": ("ficcao", "ficao"),
    "Suspense": ("suspense",),
    "Terror": ("terror",),
    "Romance": ("romance",),
    "Romance Clássico": ("romance classico",),
    "Literatura Brasileira": ("literatura brasileira",),
}
COUNTRY = {"Brasil": ("brasil", "brazil", "br")}
STATUS = {
    "Entregue": ("entregue",),
    "Em Trânsito": ("em transito",),
    "Processando": ("processando",),
    "Cancelado": ("cancelado",),
}
LANGUAGE = {"PT-BR": ("pt", "pt-br", "pt_br", "portugues"), "EN": ("en", "english", "ingles")}
PAYMENT = {"PIX": ("pix",), "Boleto": ("boleto",), "Cartão": ("cartao",)}


def payment(x: str) -> str:
    rest = lookup(x, PAYMENT, f"trim({x})")
    return (
        f"(CASE WHEN {fold(x)} = 'cartao de credito' OR {fold(x)} LIKE '%cart%credit%' THEN 'Cartão de Crédito'"
        f" WHEN {fold(x)} = 'cartao de debito' OR {fold(x)} LIKE '%cart%deb%' THEN 'Cartão de Débito'"
        f" ELSE {rest} END)"
    )


_place = "concat_ws(' ', r_name, n_name)"
_addr = "('customer' || k || '@mail.example.com')"
_phone = "('(11) 9' || lpad(k::VARCHAR, 8, '0'))"
_reg = "(DATE '1994-01-01' + ((k * 37) % 2500)::INTEGER)"
_born = "(DATE '1940-01-01' + ((k * 61) % 22000)::INTEGER)"
_price = money_text("round(p_retailprice * 100)::BIGINT")
_category = (
    "(CASE p_type WHEN 'STANDARD' THEN 'Fantasia' WHEN 'ECONOMY' THEN 'Ficção'"
    " WHEN 'MEDIUM' THEN 'Ficção Científica' WHEN 'SMALL' THEN 'Romance Clássico'"
    " WHEN 'PROMO' THEN 'Terror' ELSE 'Poesia' END)"
)
_unit = "(round(l_extendedprice * 100)::BIGINT // l_quantity::BIGINT)"
_mark = "(l_orderkey + l_linenumber)"
_oday = "o_orderdate::DATE"
_rday = "(ts::DATE - INTERVAL 288 MONTH)"

# name -> (tables it builds on, SQL)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}

CTES["raw_customers"] = (
    (),
    f"""
SELECT CASE WHEN k % 211 <> 0 THEN 'C' || k END AS customer_id,
  {pick('k', "'  ' || replace(c_name, '#', '   ') || ' '", 'c_name', 'upper(c_name)', 'c_name')} AS full_name,
  {pick('k', "''", "'customer' || k || '@invalid'", f"' ' || upper({_addr}) || ' '", 'NULL', _addr, f'upper({_addr})', _addr)} AS email,
  {pick('k + copy', 'NULL', "''", "'  '", _phone, f"{_phone} || ' '")} AS phone,
  {pick('k', f"strftime({_reg}, '%Y/%m/%d')", f"strftime({_reg}, '%d/%m/%Y')", "'not a date'", "'1999-02-30'", f"strftime({_reg}, '%Y-%m-%d')", f"strftime({_reg}, '%Y-%m-%d')", 'NULL')} AS registration_date,
  {pick('k + copy', f'lower({_place})', f'upper({_place})', f"' ' || {_place} || '  '")} AS city,
  {pick('k', 'lower(r_name)', 'r_name', "' ' || r_name")} AS state,
  {pick('k', "'brasil'", "' Brazil '", "'BR'", "'Chile'", "' Peru'")} AS country,
  {pick('k', f"strftime({_born}, '%d/%m/%Y')", "'unknown'", "'29/02/1984'", f"strftime({_born}, '%Y-%m-%d')", f"strftime({_born}, '%Y-%m-%d')")} AS birth_date,
  k % 1000 + CASE WHEN k % 20 = 0 THEN 0 ELSE copy * 86400 END AS created_at
FROM (SELECT c_custkey AS k, c_name, n_name, r_name,
             unnest(range(CASE WHEN c_custkey % 10 = 0 THEN 2 ELSE 1 END)) AS copy
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
)
CTES["raw_books"] = (
    (),
    f"""
SELECT 'B' || k AS book_id, ' ' || p_name || ' ' || k AS title,
  CASE WHEN k % 89 = 0 THEN '' ELSE p_brand || ' ' END AS author,
  'Publisher ' || p_size % 5 AS publisher,
  CASE WHEN k % 23 = 0 THEN '3000' WHEN k % 29 = 0 THEN 'n/a' WHEN k % 31 = 0 THEN '-5'
       ELSE (k % 51 + 1950)::VARCHAR END AS publication_year,
  CASE WHEN k % 19 = 0 THEN '' ELSE '978-' || lpad(k::VARCHAR, 10, '0') END AS isbn,
  CASE WHEN k % 17 = 0 THEN 'FICAO'
       ELSE {pick('k', f'upper({_category})', f'lower({_category})', f"' ' || {_category}")} END AS category,
  CASE WHEN k % 50 = 0 THEN '-' || {_price} WHEN k % 41 = 0 THEN 'abc' WHEN k % 43 = 0 THEN ''
       ELSE {_price} END AS price,
  CASE WHEN k % 37 = 0 THEN 'none' WHEN k % 113 = 0 THEN '3000000000' ELSE ((k * 7) % 300)::VARCHAR END AS stock_quantity,
  CASE WHEN k % 47 = 0 THEN '0' WHEN k % 59 = 0 THEN 'x' ELSE (p_size * 10)::VARCHAR END AS pages,
  {pick('k', "'PT'", "'pt-br'", "'Português'", "'en'", "'English'", "' es '")} AS language_code,
  CASE WHEN k % 61 = 0 THEN 'bad' ELSE (k % 60) // 10 || '.' || k % 10 END AS rating
FROM (SELECT p_partkey AS k, * FROM part)""",
)
CTES["raw_orders"] = (
    (),
    f"""
SELECT 'O' || k AS order_id,
  CASE WHEN k % 97 = 0 THEN 'C-unknown' ELSE 'C' || o_custkey END AS customer_id,
  CASE WHEN k % 33 = 0 THEN '2001-02-30' WHEN k % 35 = 0 THEN strftime({_oday}, '%Y%m%d')
       WHEN k % 4 = 1 THEN strftime({_oday}, '%d/%m/%Y')
       ELSE strftime({_oday}, '%Y-%m-%d') END AS order_date,
  CASE WHEN k % 40 = 0 THEN '' WHEN k % 53 = 0 THEN NULL WHEN k % 57 = 0 THEN '-5.00'
       WHEN k % 71 = 0 THEN 'abc' ELSE {money_text('round(o_totalprice * 100)::BIGINT')} END AS total_amount,
  CASE WHEN k % 83 = 0 THEN '' ELSE CASE left(o_orderpriority, 1)
       WHEN '1' THEN {pick('k', "'PIX'", "' pix'", "'Pix '")}
       WHEN '2' THEN {pick('k', "'Cartão de Crédito'", "'cartao de credito'", "'CARTAO CREDITO'")}
       WHEN '3' THEN {pick('k', "'Cartão de Débito'", "'cartao debito'", "'CARTÃO DE DÉBITO'")}
       WHEN '4' THEN {pick('k', "'Boleto'", "' boleto'", "'BOLETO'")}
       ELSE {pick('k', "'cartao'", "'Transferência'", "' Vale '")} END END AS payment_method,
  CASE WHEN k % 101 <> 0 THEN CASE o_orderstatus
       WHEN 'F' THEN {pick('k', "'ENTREGUE'", "'entregue '")}
       WHEN 'O' THEN {pick('k', "'Em Transito'", "'em trânsito'")}
       ELSE {pick('k', "'processando'", "'CANCELADO'", "'Devolvido'")} END END AS order_status,
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN '-3.00' WHEN k % 17 = 0 THEN ''
       ELSE k % 30 || '.50' END AS shipping_cost,
  CASE WHEN k % 19 = 0 THEN 'x' ELSE (k % 7)::VARCHAR END AS discount_applied
FROM (SELECT o_orderkey AS k, * FROM orders)""",
)
CTES["raw_items"] = (
    (),
    f"""
SELECT 'I' || concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS order_item_id,
  CASE WHEN (l_orderkey + l_partkey) % 103 = 0 THEN 'O-unknown' ELSE 'O' || l_orderkey END AS order_id,
  CASE WHEN (l_partkey + l_linenumber) % 107 = 0 THEN 'B-unknown' ELSE 'B' || l_partkey END AS book_id,
  CASE WHEN {_mark} % 37 = 0 THEN '0' WHEN {_mark} % 41 = 0 THEN 'two' WHEN {_mark} % 43 = 0 THEN NULL
       WHEN {_mark} % 61 = 0 THEN '99999999999'
       ELSE l_quantity::BIGINT::VARCHAR END AS quantity,
  CASE WHEN {_mark} % 47 = 0 THEN '-' || {money_text(_unit)} WHEN {_mark} % 53 = 0 THEN ''
       ELSE {money_text(_unit)} END AS unit_price,
  CASE WHEN {_mark} % 59 = 0 THEN 'n/a'
       WHEN {_mark} % 29 = 0 THEN {money_text(f'{_unit} * l_quantity::BIGINT + 500')}
       ELSE {money_text(f'{_unit} * l_quantity::BIGINT')} END AS subtotal
FROM lineitem""",
)
CTES["raw_reviews"] = (
    (),
    f"""
SELECT 'R' || event_id AS review_id,
  CASE WHEN event_id % 109 = 0 THEN 'B-unknown' ELSE 'B' || event_id // 5 END AS book_id,
  'C' || user_id AS customer_id,
  CASE WHEN event_id % 67 = 0 THEN 'five' ELSE (floor(value)::BIGINT % 8 - 1)::VARCHAR END AS rating,
  CASE WHEN event_id % 31 = 0 THEN '   '
       WHEN event_id % 37 <> 0 THEN ' ' || event_type || ' ' || props END AS review_text,
  CASE WHEN event_id % 41 = 0 THEN 'invalid-date' WHEN event_id % 43 = 0 THEN '2003-01-01'
       WHEN event_id % 47 = 0 THEN NULL WHEN event_id % 45 = 0 THEN strftime({_rday}, '%d/%m/%Y')
       WHEN event_id % 5 = 0 THEN strftime({_rday}, '%d-%m-%Y')
       ELSE strftime({_rday}, '%Y-%m-%d') END AS review_date,
  CASE WHEN event_id % 23 = 0 THEN '-1' WHEN event_id % 29 = 0 THEN ''
       ELSE (event_id % 60)::VARCHAR END AS helpful_count
FROM events""",
)

VALID_EMAIL = f"coalesce(regexp_matches(email, '{EMAIL}'), false)"
REG_DAY = day("registration_date", "Y-m-d", "Y/m/d", "d/m/Y")
BIRTH_DAY = day("birth_date", "Y-m-d", "d/m/Y")
CLEAN_NAME = r"trim(regexp_replace(full_name, '\s+', ' ', 'g'))"
CLEAN_EMAIL = "CASE WHEN email <> '' THEN lower(trim(email)) END"
CITY = "(upper(left(trim(city), 1)) || lower(substr(trim(city), 2)))"
STATE = "upper(left(trim(state), 2))"
CUSTOMER_SCORE = score(
    w20_1="coalesce(customer_id <> '', false)",
    w20_2=VALID_EMAIL,
    w20_3="coalesce(phone <> '', false)",
    w20_4=shaped("registration_date", "Y-m-d", "Y/m/d", "d/m/Y"),
    w20_5=shaped("birth_date", "Y-m-d", "d/m/Y"),
)
YEAR = (
    "(CASE WHEN TRY_CAST(publication_year AS INTEGER) BETWEEN 1000 AND 2001"
    " THEN TRY_CAST(publication_year AS INTEGER) END)"
)
PRICE = f"(CASE WHEN {cents('price')} >= 0 THEN {cents('price')} END)"
RATING10 = f"(CASE WHEN {tenths('rating')} BETWEEN 0 AND 50 THEN {tenths('rating')} END)"
AVAILABLE = (
    f"((coalesce({whole('stock_quantity')} > 0, false) OR {wide('stock_quantity')})"
    f" AND coalesce({cents('price')} > 0, false))"
)
BOOK_SCORE = score(
    w15_1="book_id IS NOT NULL",
    w15_2="coalesce(title <> '', false)",
    w15_3="coalesce(author <> '', false)",
    w15_4=f"{YEAR} IS NOT NULL",
    w10_5="coalesce(isbn <> '', false)",
    w15_6=f"coalesce({cents('price')} > 0, false)",
    w15_7=f"{RATING10} IS NOT NULL",
)
CATEGORY_OF = lookup("category", CATEGORY, "trim(category)")
LANGUAGE_OF = lookup("language_code", LANGUAGE, "upper(trim(language_code))")
ORDER_DAY = past_day("order_date", "Y-m-d", "d/m/Y")
TOTAL = f"(CASE WHEN {cents('total_amount')} >= 0 THEN {cents('total_amount')} END)"


def plain_or_zero(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '^[0-9]+(\\.[0-9]+)?$') THEN {cents(x)} ELSE 0 END)"


def signed_or_zero(x: str) -> str:
    return f"{cents(f'coalesce(nullif({x}, {chr(39)}{chr(39)}), {chr(39)}0{chr(39)})')}"


NET = (
    f"(CASE WHEN total_amount <> '' THEN {cents('total_amount')}"
    f" + {signed_or_zero('shipping_cost')} - {signed_or_zero('discount_applied')} END)"
)
PAID = f"coalesce(total_amount <> '' AND {cents('total_amount')} > 0, false)"
VALID_ORDER = f"({PAID} AND {ORDER_DAY} IS NOT NULL)"
ORDER_SCORE = score(
    w20_1="order_id IS NOT NULL",
    w20_2="customer_id IS NOT NULL",
    w20_3="coalesce(order_date <> '', false)",
    w20_4=PAID,
    w20_5="coalesce(payment_method <> '', false)",
)
STATUS_OF = lookup("order_status", STATUS, "trim(order_status)")
COUNTRY_OF = lookup("country", COUNTRY, "trim(country)")
PAYMENT_OF = payment("payment_method")
QUANTITY = (
    f"(CASE WHEN {whole('quantity')} > 0 THEN {whole('quantity')} WHEN NOT {wide('quantity')} THEN 1 END)"
)
UNIT = f"(CASE WHEN {cents('unit_price')} >= 0 THEN {cents('unit_price')} END)"
SUBTOTAL = f"(CASE WHEN {cents('subtotal')} >= 0 THEN {cents('subtotal')} END)"
CALCULATED = (
    f"(CASE WHEN NOT {wide('quantity')} THEN coalesce({whole('quantity')}, 1) * coalesce({UNIT}, 0) END)"
)
STOCK = f"(CASE WHEN NOT {wide('stock_quantity')} THEN coalesce({whole('stock_quantity')}, 0) END)"
MATCHES = f"coalesce(abs({cents('subtotal')} - {CALCULATED}) < 1, false)"
REVIEW_RATING = f"(CASE WHEN {whole('rating')} BETWEEN 1 AND 5 THEN {whole('rating')} END)"
REVIEW_DAY = past_day("review_date", "Y-m-d", "d-m-Y")
VALID_REVIEW = (
    f"({REVIEW_RATING} IS NOT NULL AND coalesce(trim(review_text) <> '', false)"
    " AND coalesce(review_date <> 'invalid-date', false))"
)

CTES["first_customers"] = (
    ("raw_customers",),
    """
SELECT * FROM raw_customers WHERE customer_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY created_at, full_name NULLS FIRST,
  email NULLS FIRST, phone NULLS FIRST, registration_date NULLS FIRST, city NULLS FIRST,
  state NULLS FIRST, country NULLS FIRST, birth_date NULLS FIRST) = 1""",
)
CTES["dim_customers"] = (
    ("first_customers",),
    f"""
SELECT customer_id, {CLEAN_NAME} AS full_name, {CLEAN_EMAIL} AS email, {VALID_EMAIL} AS email_valid,
  nullif(trim(phone), '') AS phone, {REG_DAY} AS registration_date, {CITY} AS city, {STATE} AS state,
  {COUNTRY_OF} AS country, {BIRTH_DAY} AS birth_date, {age(BIRTH_DAY)} AS age, {CUSTOMER_SCORE} AS score
FROM first_customers""",
)
CTES["dim_books"] = (
    ("raw_books",),
    f"""
SELECT book_id, trim(title) AS title, trim(author) AS author, trim(publisher) AS publisher,
  {YEAR} AS publication_year, trim(isbn) AS isbn, {CATEGORY_OF} AS category, {PRICE} AS price,
  {STOCK} AS stock_quantity,
  CASE WHEN {whole('pages')} > 0 THEN {whole('pages')} END AS pages, {LANGUAGE_OF} AS language_code,
  {RATING10} AS avg_rating, {AVAILABLE} AS is_available, {BOOK_SCORE} AS score
FROM raw_books WHERE book_id IS NOT NULL""",
)
CTES["fact_orders"] = (
    ("raw_orders", "dim_customers"),
    f"""
SELECT order_id, customer_id, {ORDER_DAY} AS order_date, {TOTAL} AS total_amount,
  {PAYMENT_OF} AS payment_method, {STATUS_OF} AS order_status,
  {plain_or_zero('shipping_cost')} AS shipping_cost, {plain_or_zero('discount_applied')} AS discount_applied,
  {NET} AS net_amount, {VALID_ORDER} AS is_valid_order, {ORDER_SCORE} AS score
FROM raw_orders
WHERE order_id IS NOT NULL AND customer_id IN (SELECT customer_id FROM dim_customers)""",
)
CTES["fact_items"] = (
    ("raw_items", "fact_orders", "dim_books"),
    f"""
SELECT order_item_id, order_id, book_id, {QUANTITY} AS quantity, {UNIT} AS unit_price,
  {SUBTOTAL} AS subtotal, {CALCULATED} AS calculated_subtotal, {MATCHES} AS subtotal_matches
FROM raw_items
WHERE order_id IN (SELECT order_id FROM fact_orders) AND book_id IN (SELECT book_id FROM dim_books)""",
)
CTES["fact_reviews"] = (
    ("raw_reviews", "dim_books", "dim_customers"),
    f"""
SELECT review_id, book_id, customer_id, {REVIEW_RATING} AS rating, trim(review_text) AS review_text,
  {REVIEW_DAY} AS review_date, coalesce({whole('helpful_count')}, 0) AS helpful_count,
  length(trim(review_text))::INTEGER AS review_length, {VALID_REVIEW} AS is_valid_review
FROM raw_reviews
WHERE book_id IN (SELECT book_id FROM dim_books) AND customer_id IN (SELECT customer_id FROM dim_customers)""",
)


def needed(*names: str) -> list[str]:
    """The named expressions and all they build on, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in CTES[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return order


def compose(tables: str, select: str, **extra: str) -> str:
    """One statement: the tables asked for (space separated), extras, the select."""
    parts = [f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in needed(*tables.split())]
    parts += [f"{n} AS ({sql})" for n, sql in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()


def rounded(numerator: str, denominator: str, digits: int, unit: int = 1) -> str:
    """Half-up rounding of numerator / (unit * denominator), both whole and not negative."""
    n, d = f"({numerator})::HUGEINT", f"({denominator})::HUGEINT * {unit}"
    ten = 10**digits
    return (
        f"(CASE WHEN ({denominator}) > 0 THEN"
        f" ((2 * {n} * {ten} + {d}) // (2 * {d}))::DOUBLE / {ten} END)"
    )


def units(cents_: str) -> str:
    return f"(({cents_})::DOUBLE / 100)"
