"""Column rules on single values."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import canonical, dates, numbers, rules, segments, text
from shelfmark.functions import fixed_values as fixed

AS_OF = dt.date(2025, 6, 30)
day = dt.date

ONE_INPUT = {
    "clean_name": (text.clean_name, {"  Ana \t Maria  ": "Ana Maria", "": "", None: None, "A\nB": "A B"}),
    "clean_email": (text.clean_email, {" A@B.Com ": "a@b.com", "": None, None: None, "  ": ""}),
    "is_valid_email": (
        text.is_valid_email,
        {"a.b@c.org": True, "A@B.CO": True, "a@b": False, " a@b.com": False, "": False, None: False},
    ),
    "clean_phone": (text.clean_phone, {" 11 9 ": "11 9", "   ": None, "": None, None: None}),
    "keep_blank_phone": (lambda c: text.clean_phone(c, blank_to_null=False), {"  ": "", None: None}),
    "sentence_case": (
        text.sentence_case,
        {"belo HORIZONTE": "Belo horizonte", " óbidos ": "Óbidos", "": "", None: None, "x": "X"},
    ),
    "state_code": (text.state_code, {" rj ": "RJ", "Bahia": "BA", "": "", None: None}),
    "text_length": (text.text_length, {" é ": 1, "": 0, None: None}),
    "country": (canonical.country, {" BRAZIL ": "Brasil", "br": "Brasil", " Peru ": "Peru", None: None}),
    "category": (
        canonical.category,
        {
            "FICÇÃO": "Ficção", "ficao": "Ficção", "Ficcao Cientifica": "Ficção Científica",
            " romance classico": "Romance Clássico", " Poesia ": "Poesia", "": "", None: None,
        },
    ),
    "order_status": (
        canonical.order_status,
        {"EM TRANSITO": "Em Trânsito", "entregue ": "Entregue", "Devolvido": "Devolvido", None: None},
    ),
    "language": (canonical.language, {"pt_BR": "PT-BR", "Inglês": "EN", " es ": "ES", None: None}),
    "payment_method": (
        canonical.payment_method,
        {
            "cartao de credito": "Cartão de Crédito", "CART. CREDIT": "Cartão de Crédito",
            "Cartão de Débito": "Cartão de Débito", "cart deb": "Cartão de Débito", " pix": "PIX",
            "BOLETO": "Boleto", "cartao": "Cartão", " Vale ": "Vale", "": "", None: None,
        },
    ),
    "registration_date": (
        dates.registration_date,
        {
            "2024-02-29": day(2024, 2, 29), "2024/03/01": day(2024, 3, 1), "31/12/2023": day(2023, 12, 31),
            "2024-02-30": None, "2023-02-29": None, "31-12-2023": None, "2024-1-2": None, "": None, None: None,
            "2099-01-01": day(2099, 1, 1), " 2024-01-01": None,
        },
    ),
    "order_date": (
        lambda c: dates.order_date(c, AS_OF),
        {"2025-06-30": AS_OF, "2025-07-01": None, "30/06/2025": AS_OF, "01/07/2025": None, "2025/01/01": None},
    ),
    "review_date": (
        lambda c: dates.review_date(c, AS_OF),
        {"01-05-2024": day(2024, 5, 1), "2024-05-01": day(2024, 5, 1), "01/05/2024": None, "x": None},
    ),
    "age_in_years": (
        lambda c: dates.age_in_years(c.cast("date"), AS_OF),
        {
            "2000-06-30": 25, "2000-07-01": 24, "2000-02-29": 25, "2025-06-30": 0, "2024-07-01": 0,
            "2030-06-30": -5, "2030-06-29": -4, "2030-01-01": -4, "2026-06-29": 0, None: None,
        },
    ),
    "leap_day_age": (
        lambda c: dates.age_in_years(c.cast("date"), "2025-02-28"), {"2000-02-29": 24, "2000-02-28": 25},
    ),
    "month_name": (lambda c: dates.month_name(c.cast("date")), {"2024-03-01": "March"}),
    "valid_year": (
        lambda c: numbers.valid_year(c, AS_OF),
        {"1000": 1000, "999": None, "2025": 2025, "2026": None, "n/a": None, "-5": None, "": None, None: None},
    ),
    "non_negative_money": (
        numbers.non_negative_money,
        {"1.5": D("1.50"), "0": D("0.00"), "-1": None, "abc": None, "": None, None: None, "1.005": D("1.01")},
    ),
    "lenient_money": (
        lambda c: numbers.non_negative_money(c, lenient=True),
        {"12abc": D("12.00"), "abc": D("0.00"), "-3x": None, "": D("0.00"), None: None, " 7.25 R$": D("7.25")},
    ),
    "lenient_total": (
        lambda c: numbers.money_if_present(c, lenient=True), {"12abc": D("12.00"), "": None, None: None},
    ),
    "lenient_year": (
        lambda c: numbers.valid_year(c, AS_OF, lenient=True), {"1999.5": 1999, "1999abc": 1999, "x": None, None: None},
    ),
    "money_or_zero": (
        numbers.money_or_zero,
        {"12.5": D("12.50"), "-3": D("0.00"), "": D("0.00"), None: D("0.00"), "1.": D("0.00"), "x": D("0.00")},
    ),
    "count_or_zero": (numbers.count_or_zero, {"7": 7, "-1": 0, "1.5": 0, "": 0, None: 0, "none": 0, "2147483647": 2147483647, "3000000000": None, "9" * 30: None}),
    "pages": (lambda c: numbers.positive_count_or(c, None), {"0": None, "12": 12, "x": None, None: None, "3000000000": None}),
    "quantity": (lambda c: numbers.positive_count_or(c, 1), {"0": 1, "12": 12, "x": 1, None: 1, "-2": 1, "3000000000": None, "9" * 30: None}),
    "catalogue_rating": (
        numbers.catalogue_rating,
        {"0": D("0.0"), "5.0": D("5.0"), "5.1": None, "-0.1": None, "bad": None, None: None},
    ),
    "review_rating": (numbers.review_rating, {"1": 1, "5": 5, "0": None, "12": None, "-2": None, "4.5": None}),
    "score_band": (
        lambda c: segments.score_band(c.cast("decimal(3,2)")),
        {"1.00": "1.0 (Perfeito)", "0.95": "0.8–0.9 (Bom)", "0.60": "0.6–0.7 (Regular)", "0.59": "< 0.6 (Crítico)"},
    ),
    "recency_status": (
        lambda c: segments.recency_status(c.cast("int")),
        {"60": "Ativo", "61": "Em Risco", "180": "Em Risco", "181": "Inativo", None: "Inativo", "-1": "Ativo"},
    ),
    "spend_tier": (
        lambda c: segments.spend_tier(c.cast("decimal(10,2)")),
        {"300": "VIP", "299.99": "Regular", "150": "Regular", "149.99": "Novo", None: "Novo"},
    ),
}


@pytest.mark.parametrize("name", ONE_INPUT)
def test_rule(spark, name):
    rule, cases = ONE_INPUT[name]
    df = spark.createDataFrame([(v,) for v in cases], "x string")
    got = {r[0]: r[1] for r in df.select("x", rule(F.col("x"))).collect()}
    assert got == cases


def evaluate(spark, columns, rule, cases):
    df = spark.createDataFrame([(*k,) for k in cases], ", ".join(f"{c} string" for c in columns))
    picked = [F.col(c) for c in columns]
    return {tuple(r[:-1]): r[-1] for r in df.select(*columns, rule(*picked)).collect()}


def test_order_rules(spark):
    net = {
        ("10", "2", "1"): D("11.00"),
        ("10", "-2", "1"): D("7.00"),
        ("10", None, ""): D("10.00"),
        ("", "2", "1"): None,
        (None, "2", "1"): None,
        ("-5", "0", "0"): D("-5.00"),
    }
    assert evaluate(spark, ["t", "s", "d"], rules.net_amount, net) == net
    valid = {
        ("10", "2024-01-01"): True,
        ("10", "31/01/2024"): True,
        ("10", "2024-02-30"): False,
        ("10", "2030-01-01"): False,
        ("0", "2024-01-01"): False,
        ("", "2024-01-01"): False,
        (None, "2024-01-01"): False,
        ("x", "2024-01-01"): False,
        ("10", None): False,
    }
    assert evaluate(spark, ["t", "d"], lambda t, d: rules.is_valid_order(t, d, AS_OF), valid) == valid


def test_item_rules(spark):
    computed = {
        ("2", "1.50"): D("3.00"),
        ("0", "1.50"): D("0.00"),
        ("two", "1.50"): D("1.50"),
        (None, "1.50"): D("1.50"),
        ("2", "-1"): D("0.00"),
        ("2", ""): D("0.00"),
        ("3000000000", "1.50"): None,
        ("9" * 40, "1.50"): None,
    }
    assert evaluate(spark, ["q", "p"], rules.calculated_subtotal, computed) == computed
    matching = {
        ("3.00", "2", "1.50"): True,
        ("3.01", "2", "1.50"): False,
        ("", "2", "1.50"): False,
        (None, "2", "1.50"): False,
        ("0", "2", "-1"): True,
    }
    assert evaluate(spark, ["s", "q", "p"], rules.subtotal_matches, matching) == matching


def test_review_rules(spark):
    loose = {
        ("5", "ok", "2024-01-01"): True,
        ("5", "ok", "someday"): True,
        ("5", "ok", "invalid-date"): False,
        ("5", "ok", None): False,
        ("6", "ok", "2024-01-01"): False,
        ("5", "  ", "2024-01-01"): False,
        ("5", None, "2024-01-01"): False,
    }
    columns = ["r", "t", "d"]
    assert evaluate(spark, columns, rules.is_valid_review, loose) == loose
    strict = loose | {("5", "ok", "someday"): False, ("5", "ok", "2030-01-01"): False}
    assert (
        evaluate(spark, columns, lambda r, t, d: rules.is_valid_review(r, t, d, AS_OF), strict) == strict
    )


def test_availability(spark):
    cases = {
        ("1", "1"): True,
        ("0", "1"): False,
        ("1", "0"): False,
        ("-1", "1"): False,
        ("none", "1"): False,
        ("1", "abc"): False,
        (None, None): False,
        ("3000000000", "1"): True,
        ("9" * 40, "1"): True,
        ("3000000000", "0"): False,
    }
    assert evaluate(spark, ["s", "p"], rules.is_available, cases) == cases


def test_date_shape_does_not_ask_for_a_calendar_day(spark):
    df = spark.createDataFrame([("2024-02-30",), ("2024/01/01",), (None,)], "x string")
    shaped = dates.has_date_shape(F.col("x"), fixed.BIRTH_DATES)
    assert [r[0] for r in df.select(shaped).collect()] == [True, False, False]
