"""Landing: every business column is text and no row is rejected."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW


@dataclass(frozen=True)
class Bronze:
    """The five raw tables."""

    customers: DataFrame
    books: DataFrame
    orders: DataFrame
    items: DataFrame
    reviews: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers,
            "books": self.books,
            "orders": self.orders,
            "items": self.items,
            "reviews": self.reviews,
        }


def text_schema(table: str) -> T.StructType:
    """Business columns of a raw table, without the load time."""
    return T.StructType([f for f in RAW[table].fields if f.name != "created_at"])


def as_landed(
    df: DataFrame, table: str, load_time: dt.datetime | None = None, also: Sequence[str] = ()
) -> DataFrame:
    """Any source as a raw table: missing columns null, the rest cast to text.

    ``load_time`` stamps the rows; without it the source's own ``created_at``
    is kept.  Columns named in ``also`` come along behind the others.
    """
    present = set(df.columns)
    text = [
        (F.col(c) if c in present else F.lit(None)).cast("string").alias(c)
        for c in text_schema(table).names
    ]
    stamp = F.col("created_at") if load_time is None else F.lit(load_time)
    return df.select(*text, stamp.cast("timestamp").alias("created_at"), *also)


def read_raw(
    spark: SparkSession,
    table: str,
    path: str,
    load_time: dt.datetime,
    format: str = "csv",
    raw_line: str | None = None,
    **options: str,
) -> DataFrame:
    """Read delivered files (csv, json, parquet, orc) as a raw table.

    Nothing is inferred and a value of any form survives.  Delimited files with a
    header bring their own column names, in any order; columns they lack are
    null and others are left out.  Without a header the declared order counts.
    Rows that are too short end in nulls, and what is beyond the last column of
    a row that is too long is left out; no row is rejected.

    With ``raw_line``, delimited and json files keep such lines: the column of that
    name has the line as delivered where it did not fit the columns or could not be
    read, so nothing of it is lost, and is null where it did.
    """
    reader = spark.read.format(format).options(**options)
    named = format == "csv" and options.get("header", "false").lower() == "true"
    if format in ("csv", "json", "text") and not named:
        reader = reader.schema(text_schema(table))
    if raw_line is None or format not in ("csv", "json"):
        return as_landed(reader.load(path), table, load_time)
    columns = reader.load(path).columns if named else text_schema(table).names
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, raw_line]])
    # Fields are only counted where all columns are parsed, whichever are asked for.
    reader = reader.schema(schema).option("columnNameOfCorruptRecord", raw_line).option("columnPruning", "false")
    whole = reader.load(path)
    return as_landed(whole, table, load_time, also=[raw_line])


def rows_as_raw(
    spark: SparkSession, table: str, rows: Iterable[Sequence[str | None]], load_time: dt.datetime
) -> DataFrame:
    """Literal rows as a raw table."""
    df = spark.createDataFrame([tuple(r) for r in rows], text_schema(table))
    return as_landed(df, table, load_time)


def append_raw(df: DataFrame, path: str) -> None:
    """Add one delivery to a raw table; earlier deliveries stay untouched."""
    df.write.mode("append").parquet(path)
