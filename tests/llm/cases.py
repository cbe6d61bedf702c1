"""Documents with the awkward cases that every text operator has to take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names operators use themselves.
CLASHING = "score double, language string, spans string, row long, sequence_id long, kept boolean"

SYLLABLES = {
    "en": "th er on an re he in ed nd ha at en es of or nt ea ti to it st".split(),
    "de": "ein ich der die und sch cht ung keit lich ver ge be zu ö ü ä ß".split(),
}


def prose(rng: random.Random, words: int, lang: str = "en") -> str:
    out = []
    for k in range(words):
        word = "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))
        out.append(word + ("." if k % 9 == 8 else ""))
    return " ".join(out)


def awkward_rows() -> list[tuple]:
    """Nulls in any column, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    same = prose(rng, 60)
    long = prose(rng, 40_000)
    return [
        (1, same, "en", "a", 10),
        (1, same, "en", "a", 10),  # the same row again
        (2, same, None, None, None),
        (3, None, "en", "a", 0),
        (4, "", "de", "a", 0),
        (5, " \n\t ", "de", "b", 4),
        (6, "Hallo", "de", "b", 5),
        (6, "ein ich der die und", "de", "b", 19),  # the same id with another text
        (None, prose(rng, 50, "de"), "de", None, 1),
        (None, None, None, None, None),
        (7, long, "en", "c", len(long)),
        (8, "x" * 300_000, "en", "c", 300_000),
        (9, "😀 é\x1c  a\r\nb " * 30, "de", "c", 30),
        (10, prose(rng, 200, "de"), "de", "c", 1),
        (11, prose(rng, 200), "en", "c", 1),
    ]


def documents(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA)


def with_clashes(df: DataFrame) -> DataFrame:
    """More columns, named as operators name theirs."""
    for part in CLASHING.split(", "):
        name, kind = part.split()
        df = df.selectExpr("*", f"CAST(NULL AS {kind}) AS {name}")
    return df
