"""Column rules on random text, against plain Python."""

from __future__ import annotations

import datetime as dt
import random
import re
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from shelfmark.functions import dates, numbers, text

AS_OF = dt.date(2025, 6, 30)


def column(spark, values, rule):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("x"))).collect()]


def random_dates(n):
    rng = random.Random(11)
    for _ in range(n):
        y, m, d = rng.randrange(1990, 2030), rng.randrange(0, 14), rng.randrange(0, 33)
        yield rng.choice(
            [f"{y:04}-{m:02}-{d:02}", f"{y:04}/{m:02}/{d:02}", f"{d:02}/{m:02}/{y:04}",
             f"{d:02}-{m:02}-{y:04}", f"{y}-{m}-{d}", f" {y:04}-{m:02}-{d:02}", f"{y:04}{m:02}{d:02}"]
        )


def read(value, shapes):
    for shape, order in shapes:
        found = re.fullmatch(shape, value)
        if found:
            parts = dict(zip(order, map(int, found.groups())))
            try:
                return dt.date(parts["y"], parts["m"], parts["d"])
            except ValueError:
                return None
    return None


Y, TWO = "([0-9]{4})", "([0-9]{2})"
YMD, SLASHED, DMY = (f"{Y}-{TWO}-{TWO}", "ymd"), (f"{Y}/{TWO}/{TWO}", "ymd"), (f"{TWO}/{TWO}/{Y}", "dmy")


def test_dates(spark):
    values = list(random_dates(3000))
    registered = [read(v, [YMD, SLASHED, DMY]) for v in values]
    assert column(spark, values, dates.registration_date) == registered
    ordered = [read(v, [YMD, DMY]) for v in values]
    ordered = [d if d and d <= AS_OF else None for d in ordered]
    assert column(spark, values, lambda c: dates.order_date(c, AS_OF)) == ordered
    assert any(ordered) and not all(ordered)


def test_ages(spark):
    rng = random.Random(12)
    births = [dt.date(1930, 1, 1) + dt.timedelta(days=rng.randrange(36000)) for _ in range(2000)]

    def age(b):
        if b <= AS_OF:
            return AS_OF.year - b.year - ((AS_OF.month, AS_OF.day) < (b.month, b.day))
        return -(b.year - AS_OF.year - ((b.month, b.day) < (AS_OF.month, AS_OF.day)))

    got = column(spark, [b.isoformat() for b in births], lambda c: dates.age_in_years(c.cast("date"), AS_OF))
    assert got == [age(b) for b in births]


def test_amounts(spark):
    rng = random.Random(13)
    values = [
        rng.choice(["", "-", "+", " "]) + str(rng.randrange(10**6)) + rng.choice(["", ".", ".5", ".255", "x", ",5"])
        for _ in range(2000)
    ]

    def plain(v):
        if not re.fullmatch(r"[0-9]+(\.[0-9]+)?", v):
            return Decimal("0.00")
        return Decimal(v).quantize(Decimal("0.01"), ROUND_HALF_UP)

    assert column(spark, values, numbers.money_or_zero) == [plain(v) for v in values]


def test_places(spark):
    rng = random.Random(14)
    values = ["".join(rng.choice("aBÉç é") for _ in range(rng.randrange(9))) for _ in range(500)]
    trimmed = [v.strip(" ") for v in values]
    assert column(spark, values, text.sentence_case) == [t[:1].upper() + t[1:].lower() for t in trimmed]
    assert column(spark, values, text.text_length) == [len(t) for t in trimmed]
