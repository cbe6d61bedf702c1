"""What the text operators share: tables, the shared folder, held-out rows, text blocks."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import shared_folder

FOLDS = 5
BLOCK_CHARS = 1_000_000  # characters handled at once inside a task
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def make_importable(spark: SparkSession) -> None:
    """Python workers started from now on also look for this package where the driver
    has it; a cluster has it installed or gets it by ``--py-files``."""
    home = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", home)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    make_importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """One document in FOLDS never takes part in training; a null id is trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def working_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    root = shared_folder(spark)
    if root is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{root}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there,
    so a lost executor costs no more than the tasks that run on it.  With ``tidy`` the
    shuffle files go as soon as it is written, not when the driver collects its garbage."""
    spark = df.sparkSession
    make_importable(spark)
    path = working_path(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, None)
    if tidy:
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blocks(texts: Iterable[str | None], limit: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """Consecutive texts, nulls as empty, in lists of about ``limit`` characters."""
    block: list[str] = []
    size = 0
    for text in texts:
        block.append(text or "")
        size += len(block[-1])
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts in a row, and the length of each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    data = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(data, np.uint32), lengths


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of all the runs, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
