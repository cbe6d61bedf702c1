"""Rows kept and rows rejected for a missing parent, side by side.

A delivery is checked by one flagged join and written once, with a partition for either
status, below a folder of its own number; repeating a delivery replaces its folder.  What
the delivery before rejected is checked again with it, and moves to the kept rows once all
parents are there.  So the kept rows are those of all deliveries, and the rejected ones
those of the last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.referential import KEPT, REJECTED, STATUS, flag_referenced
from .files import exists

ROUND = "round"


class Quarantine:
    """Checked rows of one table at ``<root>/round=<n>/status=<kept or rejected>``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root = spark, root
        self.row_schema = schema
        self.schema = T.StructType(
            [
                *schema.fields,
                T.StructField("missing", T.ArrayType(T.StringType())),
                T.StructField(ROUND, T.IntegerType()),
                T.StructField(STATUS, T.StringType()),
            ]
        )

    def _stored(self) -> DataFrame:
        if not exists(self.spark, self.root):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.root)

    def deliver(self, arrived: DataFrame, parents: Sequence[tuple[DataFrame, str]], number: int) -> None:
        """Check delivery ``number``, from 0 upwards, and all rows rejected in the one before."""
        waiting = self._stored().where((F.col(ROUND) == number - 1) & (F.col(STATUS) == REJECTED))
        columns = self.row_schema.names
        rows = arrived.select(columns).unionByName(waiting.select(columns))
        flag_referenced(rows, parents).write.mode("overwrite").partitionBy(STATUS).parquet(
            f"{self.root}/{ROUND}={number}"
        )

    def kept(self) -> DataFrame:
        """All rows whose parents were found, in whatever delivery."""
        return self._stored().where(F.col(STATUS) == KEPT).select(self.row_schema.names)

    def rejected(self) -> DataFrame:
        """The rows that still wait, with the keys they miss."""
        stored = self._stored()
        last = stored.agg(F.max(ROUND)).first()[0]
        waiting = stored.where((F.col(ROUND) == (-1 if last is None else last)) & (F.col(STATUS) == REJECTED))
        return waiting.select(*self.row_schema.names, "missing")
