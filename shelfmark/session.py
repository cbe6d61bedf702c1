"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Adaptive execution sizes partitions and splits hot join keys at run time.
# Splitting is worth one more shuffle wherever a later step wanted the
# join's partitioning.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Text keys take many times their compressed size in a task's hash tables, so
    # tasks get less of the files and of the shuffles than Spark would give them.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

# Beyond this, a larger input means larger partitions: the driver tracks a block for
# every pair of a map task and a partition.
MOST_PARTITIONS = 20_000


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the jobs here rely on."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def stored_bytes(spark: SparkSession, folder: str) -> int:
    """Size of all files below a folder; only their lengths are looked at."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.agg(F.sum("length").alias("bytes")).first().bytes or 0


def listing(spark: SparkSession, folder: str) -> tuple:
    """What identifies the present files below a folder: their number, bytes, last
    change and names."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    names = F.sum(F.xxhash64("path", "length").cast("decimal(20)"))
    return tuple(
        files.agg(F.count("*"), F.sum("length"), F.max("modificationTime"), names).first()
    )


def wanted_partitions(
    input_bytes: int, bytes_per_partition: int = 64 * 1024 * 1024, most: int = MOST_PARTITIONS
) -> int:
    """Shuffle partitions for so much input, within what one driver can track."""
    return min(most, max(1, -(-input_bytes // bytes_per_partition)))


def spread(df: DataFrame) -> DataFrame:
    """Rows of files on all cores, where the files have fewer splits than that."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def size_shuffles(
    spark: SparkSession, input_bytes: int, bytes_per_partition: int = 64 * 1024 * 1024
) -> None:
    """Give shuffles enough partitions for the input.

    The setting is only ever raised: adaptive execution merges partitions that
    turn out small, but starts no more than were asked for.
    """
    wanted = wanted_partitions(input_bytes, bytes_per_partition)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the jobs started inside; the caller's value returns."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """``size_shuffles`` for the jobs started inside; the caller's value returns."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    size_shuffles(spark, input_bytes)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def shared_folder(spark: SparkSession) -> str | None:
    """Folder all executors can reach, or None where the cluster names none.

    It is the one named by ``spark.checkpoint.dir``.  Only a local session,
    whose executors are this machine, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        return None
    folder = tempfile.mkdtemp(prefix="shelfmark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = shared_folder(spark)
        if folder is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(folder)
