"""Canonical values by a table of spellings instead of by code.

A spelling is added by adding a row.  The table is joined by its folded spelling, without a
hint: Spark sends it to all tasks only while its measured size is below the limit, and joins
by key, splitting frequent spellings, beyond.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.choose import first_match
from ..functions.text import fold

SCHEMA = "field string, spelling string, canonical string"

FIELDS: Mapping[str, Mapping[str, Sequence[str]]] = {
    "country": fixed.COUNTRIES,
    "category": fixed.CATEGORIES,
    "order_status": fixed.STATUSES,
    "language_code": fixed.LANGUAGES,
    "payment_method": fixed.PAYMENTS,
}


def known_spellings(spark: SparkSession) -> DataFrame:
    """The spellings known from the start, as rows to be stored and added to."""
    rows = [
        (field, spelling, name)
        for field, names in FIELDS.items()
        for name, spellings in names.items()
        for spelling in spellings
    ]
    return spark.createDataFrame(rows, SCHEMA)


def unknown_value(field: str, value: Column) -> Column:
    """What a spelling that is not in the table becomes."""
    if field == "language_code":
        return F.upper(F.trim(value))
    if field == "payment_method":
        loose = [(fold(value).like(p), F.lit(name)) for name, p in fixed.PAYMENT_WILDCARDS.items()]
        return first_match(loose, F.trim(value))
    return F.trim(value)


def with_canonical(df: DataFrame, mapping: DataFrame, field: str, name: str) -> DataFrame:
    """``df`` with the canonical value of its column ``field`` as column ``name``.

    Of several values for one spelling the smaller counts, so no row multiplies."""
    known = (
        mapping.where(F.col("field") == field)
        .groupBy(fold(F.col("spelling")).alias("_spelling"))
        .agg(F.min("canonical").alias("_canonical"))
    )
    value = F.coalesce("_canonical", unknown_value(field, F.col(field)))
    joined = df.withColumn("_spelling", fold(F.col(field))).join(known, "_spelling", "left")
    return joined.withColumn(name, value).drop("_spelling", "_canonical")
