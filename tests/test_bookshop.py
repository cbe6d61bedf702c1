"""The small bookshop end to end, against values worked out by hand."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import canonical
from shelfmark.plans import gold, gold_by_grain, quality
from shelfmark.plans.silver import Silver
from shelfmark.sources.bronze import Bronze, rows_as_raw

from . import fixture_rows as rows


def D(x):
    return None if x is None else Decimal(str(x))


def table(df, *columns):
    """Rows keyed by the first column, decimals as plain numbers."""
    picked = df.select(*columns).collect()
    return {r[0]: tuple(r[1:]) for r in picked}


def same(actual: dict, expected: dict):
    assert actual.keys() == expected.keys()
    for key, values in expected.items():
        got = actual[key]
        for a, e in zip(got, values, strict=True):
            if isinstance(a, Decimal):
                assert e is not None and a == D(e), (key, got, values)
            else:
                assert a == e, (key, got, values)


@pytest.fixture(scope="module")
def silver(spark):
    def raw(name, data):
        return rows_as_raw(spark, name, data, rows.LOADED)

    bronze = Bronze(
        raw("raw_customers", rows.CUSTOMERS),
        raw("raw_books", rows.BOOKS),
        raw("raw_orders", rows.ORDERS),
        raw("raw_order_items", rows.ITEMS),
        raw("raw_reviews", rows.REVIEWS),
    )
    built = Silver(bronze, rows.AS_OF)
    for df in built.tables().values():
        df.cache()
    return built


def test_row_counts(silver):
    got = table(quality.row_reconciliation(silver), "entidade", "bronze_rows", "silver_rows")
    assert got == {
        "Clientes": (11, 10),
        "Livros": (12, 12),
        "Pedidos": (12, 12),
        "Itens de Pedido": (22, 22),
        "Avaliações": (12, 12),
    }


def test_silver_summary(silver):
    got = table(quality.silver_summary(silver), "entidade", "qualidade_media", "validos")
    same(
        got,
        {
            "Clientes": ("0.90", None),
            "Livros": ("0.98", None),
            "Pedidos": ("0.98", 10),
            "Itens de Pedido": (None, 22),
            "Avaliações": (None, 9),
        },
    )


def test_cleaned_customers(silver):
    got = table(
        silver.customers, "customer_id", "full_name", "email", "email_valid", "registration_date",
        "city", "state", "country", "birth_date", "age",
    )
    assert got["C004"][0] == "Carlos Eduardo" and got["C004"][5] == "RJ"
    assert got["C004"][6] == "Brasil"
    assert got["C002"][2] is False and got["C002"][3] == dt.date(2023, 2, 20)
    assert got["C002"][7:] == (dt.date(1990, 4, 15), 35)
    assert got["C005"][1] is None
    assert got["C006"][4] == "Belo horizonte" and got["C006"][6] == "Brasil"
    assert got["C008"][3] == dt.date(2023, 8, 1)


def test_cleaned_books(silver):
    got = table(
        silver.books, "book_id", "category", "price", "language_code", "publication_year",
        "is_available",
    )
    assert got["B005"] == ("Ficção", None, "PT-BR", 2005, False)
    assert got["B011"] == ("Ficção", D("32.00"), "PT-BR", None, True)
    assert got["B009"][0] == "Suspense"


def test_cleaned_orders(silver):
    got = table(
        silver.orders, "order_id", "order_date", "total_amount", "payment_method", "order_status",
        "shipping_cost", "net_amount", "is_valid_order",
    )
    assert got["ORD005"] == (
        dt.date(2024, 3, 22), None, "Cartão de Crédito", "Cancelado", D("0.00"), None, False,
    )
    assert got["ORD007"][0] is None and got["ORD007"][-1] is False
    assert got["ORD010"][5] == D("242.70")
    assert got["ORD012"][2] == "Cartão"
    assert got["ORD004"][3] == "Processando"


def test_sales_by_category(silver):
    df = gold.sales_by_category(silver.items, silver.orders, silver.books)
    same(
        table(df, *df.columns),
        {
            "Fantasia": (7, 10, 12, 731.90, 73.19, 60.99),
            "Terror": (2, 2, 3, 239.70, 119.85, 79.90),
            "Ficção Científica": (3, 3, 4, 140.00, 46.67, 35.00),
            "Literatura Brasileira": (3, 3, 3, 86.70, 28.90, 28.90),
            "Romance Clássico": (1, 1, 2, 59.80, 59.80, 29.90),
            "Romance": (1, 1, 1, 34.90, 34.90, 34.90),
        },
    )


BOOK_MEASURES = (
    "book_id", "times_ordered", "total_copies_sold", "total_revenue", "customer_avg_rating",
    "total_reviews",
)


def test_top_selling_books(silver):
    df = gold.top_selling_books(silver.books, silver.items, silver.orders, silver.reviews)
    same(
        table(df, *BOOK_MEASURES),
        {
            "B001": (4, 12, 1078.80, 5.0, 3),
            "B003": (3, 8, 280.00, 5.0, 2),
            "B002": (2, 6, 273.00, 4.5, 2),
            "B012": (2, 3, 239.70, 5.0, 1),
            "B006": (2, 3, 156.00, 5.0, 1),
            "B010": (1, 3, 89.70, 4.0, 1),
            "B004": (3, 3, 86.70, 4.0, 1),
            "B009": (0, 2, 84.00, None, 1),
            "B007": (2, 2, 79.80, None, 0),
            "B008": (1, 1, 34.90, None, 0),
        },
    )
    shown = df.orderBy(*gold.presentation_order("top_selling_books")).select("book_id").collect()
    assert [r[0] for r in shown][:4] == ["B001", "B003", "B002", "B012"]


def test_top_selling_books_by_grain(silver):
    df = gold_by_grain.top_selling_books(silver.books, silver.items, silver.orders, silver.reviews)
    same(
        table(df, "book_id", "total_copies_sold", "total_revenue"),
        {
            "B001": (4, 359.60),
            "B003": (4, 140.00),
            "B002": (3, 136.50),
            "B012": (3, 239.70),
            "B006": (3, 156.00),
            "B010": (2, 59.80),
            "B004": (3, 86.70),
            "B007": (2, 79.80),
            "B008": (1, 34.90),
        },
    )


def test_customer_analytics(silver):
    df = gold.customer_analytics(
        silver.customers, silver.orders, silver.items, silver.reviews, rows.AS_OF
    )
    got = table(
        df, "customer_id", "total_orders", "total_spent", "avg_order_value", "avg_per_order",
        "unique_books_purchased", "total_books_quantity", "total_reviews_written",
        "avg_rating_given", "days_since_last_order", "customer_tier", "customer_status",
    )
    expected = {
        "C010": (1, 1486.20, 247.70, 1486.20, 3, 8, 2, 4.5, 380, "VIP"),
        "C003": (2, 1384.80, 138.48, 692.40, 5, 14, 2, 5.0, 357, "VIP"),
        "C006": (1, 940.80, 156.80, 940.80, 3, 8, 2, 4.5, 451, "VIP"),
        "C001": (2, 332.80, 110.93, 166.40, 3, 4, 1, 5.0, 343, "VIP"),
        "C004": (1, 255.60, 63.90, 255.60, 2, 4, 2, 4.0, 477, "Regular"),
        "C008": (1, 229.60, 114.80, 229.60, 2, 2, 0, None, 408, "Regular"),
        "C002": (1, 89.90, 89.90, 89.90, 1, 1, 1, 5.0, 501, "Novo"),
        "C009": (1, 79.90, 79.90, 79.90, 1, 1, 1, 5.0, 393, "Novo"),
    }
    same(got, {k: (*v, "Inativo") for k, v in expected.items()})


def test_customer_analytics_by_grain(silver):
    df = gold_by_grain.customer_analytics(
        silver.customers, silver.orders, silver.items, silver.reviews, rows.AS_OF
    )
    same(
        table(df, "customer_id", "total_spent", "customer_tier"),
        {
            "C010": (247.70, "Regular"),
            "C003": (258.80, "Regular"),
            "C006": (156.80, "Regular"),
            "C001": (197.40, "Regular"),
            "C004": (63.90, "Novo"),
            "C008": (114.80, "Novo"),
            "C002": (89.90, "Novo"),
            "C009": (79.90, "Novo"),
        },
    )


def test_sales_over_time(silver):
    df = gold.sales_over_time(silver.orders, silver.items)
    got = table(
        df, "yearmonth", "total_orders", "unique_customers", "total_items_sold", "gross_revenue",
        "total_shipping", "total_discounts", "net_revenue", "avg_order_value",
        "revenue_per_customer",
    )
    same(
        got,
        {
            "2024-01": (1, 1, 2, 270.80, 30, 20, 280.80, 135.40, 270.80),
            "2024-02": (2, 2, 6, 614.30, 66, 45, 635.30, 153.58, 307.15),
            "2024-03": (1, 1, 2, 127.80, 20, 10, 137.80, 63.90, 127.80),
            "2024-04": (1, 1, 4, 470.40, 45, 60, 455.40, 156.80, 470.40),
            "2024-05": (1, 1, 2, 229.60, 30, 20, 239.60, 114.80, 229.60),
            "2024-06": (2, 2, 5, 823.00, 72, 75, 820.00, 205.75, 411.50),
            "2024-07": (2, 2, 4, 230.00, 34, 16, 248.00, 76.67, 115.00),
        },
    )
    names = table(df, "yearmonth", "year", "month", "month_name")
    assert names["2024-02"] == (2024, 2, "February")


def test_payment_analysis(silver):
    df = gold.payment_analysis(silver.orders)
    same(
        table(df, *df.columns),
        {
            "PIX": (4, 445.50, 111.38, 38, 40.00, 36.84),
            "Cartão de Crédito": (2, 383.10, 191.55, 35, 20.00, 31.68),
            "Boleto": (2, 254.70, 127.35, 15, 20.00, 21.06),
            "Cartão de Débito": (1, 63.90, 63.90, 5, 10.00, 5.28),
            "Cartão": (1, 62.00, 62.00, 0, 10.00, 5.13),
        },
    )


def test_geographic_analysis(silver):
    df = gold.geographic_analysis(silver.customers, silver.orders, silver.items)
    same(
        table(df.drop("state"), *[c for c in df.columns if c != "state"]),
        {
            "Belo horizonte": (2, 3, 11, 1162.80, 145.35, 581.40, 1.50),
            "Brasília": (1, 1, 4, 743.10, 247.70, 743.10, 1.00),
            "São paulo": (1, 2, 4, 332.80, 110.93, 332.80, 2.00),
            "Florianópolis": (1, 1, 2, 229.60, 114.80, 229.60, 1.00),
            "Rio de janeiro": (2, 2, 3, 217.70, 72.57, 108.85, 1.00),
            "Salvador": (1, 1, 1, 79.90, 79.90, 79.90, 1.00),
        },
    )


def test_review_analytics(silver):
    df = gold.review_analytics(silver.books, silver.reviews)
    got = table(
        df, "book_id", "total_reviews", "avg_rating", "five_star_reviews", "four_star_reviews",
        "positive_review_percentage", "avg_review_length", "total_helpful_votes",
    )
    same(
        got,
        {
            "B001": (3, 5.00, 3, 0, 100, 32, 96),
            "B003": (1, 5.00, 1, 0, 100, 42, 52),
            "B012": (1, 5.00, 1, 0, 100, 32, 67),
            "B006": (1, 5.00, 1, 0, 100, 39, 41),
            "B002": (2, 4.50, 1, 1, 100, 38, 43),
            "B004": (1, 4.00, 0, 1, 100, 50, 22),
        },
    )
    low = df.agg(F.sum("three_star_reviews"), F.sum("low_star_reviews")).first()
    assert tuple(low) == (0, 0)
    premium = gold.premium_catalogue(df, 2)
    assert {r.book_id for r in premium.collect()} == {"B001", "B002"}


def test_daily_metrics(silver):
    df = gold.daily_metrics(silver.orders, silver.items)
    got = table(
        df, "metric_date", "total_orders", "total_revenue", "total_items_sold", "total_shipping",
        "total_discounts", "net_revenue",
    )
    expected = {
        (1, 20): (1, 270.80, 2, 30, 20, 280.80),
        (2, 15): (1, 89.90, 1, 12, 0, 101.90),
        (2, 28): (1, 524.40, 5, 54, 45, 533.40),
        (3, 10): (1, 127.80, 2, 20, 10, 137.80),
        (4, 5): (1, 470.40, 4, 45, 60, 455.40),
        (5, 18): (1, 229.60, 2, 30, 20, 239.60),
        (6, 2): (1, 79.90, 1, 12, 0, 91.90),
        (6, 15): (1, 743.10, 4, 60, 75, 728.10),
        (7, 8): (1, 168.00, 2, 24, 16, 176.00),
        (7, 22): (1, 62.00, 2, 10, 0, 72.00),
    }
    same(got, {dt.date(2024, m, d): v for (m, d), v in expected.items()})


def test_author_performance(silver):
    df = gold.author_performance(silver.books, silver.items, silver.reviews)
    got = table(
        df, "author_name", "total_books", "total_copies_sold", "total_revenue", "avg_book_rating",
        "total_reviews",
    )
    same(
        got,
        {
            "J.R.R. Tolkien": (2, 15, 1234.80, 4.80, 4),
            "George Orwell": (2, 8, 280.00, 4.67, 2),
            "J.K. Rowling": (1, 6, 273.00, 4.90, 2),
            "Stephen King": (1, 3, 239.70, 4.70, 1),
            "Jane Austen": (1, 3, 89.70, 4.60, 1),
            "Machado de Assis": (1, 3, 86.70, 4.30, 1),
            "Dan Brown": (1, 2, 84.00, 4.20, 1),
            "Rick Riordan": (1, 2, 79.80, 4.50, 0),
            "John Green": (1, 1, 34.90, 4.40, 0),
            "Markus Zusak": (1, 0, 0.00, 4.60, 0),
        },
    )
    best = table(df, "author_name", "most_popular_book", "most_popular_category")
    assert best["J.R.R. Tolkien"][0] == "O Senhor dos Anéis: A Sociedade do Anel"
    assert best["George Orwell"] == ("1984", "Ficção")
    numbered = gold.author_performance_table(df)
    assert table(numbered, "author_id", "author_name")[1] == ("J.R.R. Tolkien",)
    assert [r[0] for r in numbered.select("author_id").orderBy("author_id").collect()] == list(
        range(1, 11)
    )


def test_invalid_orders_and_their_reasons(silver):
    df = quality.invalid_order_reasons(silver.orders)
    assert table(df, *df.columns) == {
        "ORD005": ("Sem valor", None, "Cancelado"),
        "ORD007": (None, "Data inválida", None),
    }


def test_score_report_and_bands(silver):
    report = table(quality.score_report(silver), "entidade", "total", "score_medio", "score_min", "score_max")
    same(
        report,
        {
            "Clientes": (10, "0.90", "0.80", "1.00"),
            "Livros": (12, "0.98", "0.85", "1.00"),
            "Pedidos": (12, "0.98", "0.80", "1.00"),
        },
    )
    bands = quality.score_bands(silver.customers).collect()
    assert [tuple(r) for r in bands] == [("1.0 (Perfeito)", 5), ("0.8–0.9 (Bom)", 5)]
    audit = table(quality.score_audit(silver), "entidade", "perfeitos", "criticos")
    assert audit["Clientes"] == (5, 0)


def test_issue_profile(silver):
    df = quality.issue_profile(silver.bronze, rows.AS_OF)
    got = {(r.entidade, r.rule): r.affected for r in df.collect()}
    assert got["Clientes", "invalid_email"] == 3
    assert got["Clientes", "missing_phone"] == 2
    assert got["Livros", "negative_price"] == 1
    assert got["Pedidos", "future_date"] == 1
    assert got["Itens de Pedido", "subtotal_mismatch"] == 0
    assert got["Avaliações", "rating_out_of_range"] == 2


def test_value_variants(silver):
    spelled = quality.value_variants(
        silver.bronze.orders, "order_status", canonical.order_status(F.col("order_status"))
    )
    assert table(spelled, "canonical", "variants", "total_rows") == {
        "Entregue": (2, 7),
        "Em Trânsito": (1, 2),
        "Processando": (2, 2),
        "Cancelado": (1, 1),
    }


def test_kpis(silver):
    outputs = {
        "payment_analysis": gold.payment_analysis(silver.orders),
        "review_analytics": gold.review_analytics(silver.books, silver.reviews),
    }
    got = table(quality.kpis(silver, outputs), "kpi", "value", "met")
    same(
        got,
        {
            "deduplication_rate": (100, True),
            "score_coverage": (100, True),
            "valid_orders": (83.33, True),
            "gold_outputs_filled": (100, True),
            "category_consistency": (100, True),
        },
    )


def test_duplicates_and_orphans(silver):
    repeated = quality.repeated_keys(silver.bronze.tables())
    assert [tuple(r) for r in repeated.collect()] == [("Clientes", "C001", 2)]
    assert quality.repeated_keys(silver.tables()).isEmpty()
    assert quality.bronze_orphans(silver).isEmpty()


def test_delivered_orders(silver):
    june = gold.delivered_orders(silver.orders, "2024-06")
    assert {r.order_id for r in june.collect()} == {"ORD009", "ORD010"}
