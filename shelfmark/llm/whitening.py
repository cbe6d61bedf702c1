"""Whitening of embeddings with Spark MLlib's block matrices.

Entries are put on a grid first: x = floor(64 * c) + 1,000,000, as whole numbers.  Of equal
grid vectors one counts; these make up the fit list.

1. Whole-number sums over the fit list give the mean; rows are centred exactly as
   n * x - sum and only then divided.
2. Centred rows, numbered without gaps, become a ``BlockMatrix`` of row blocks.  Its
   transpose times itself is the scatter; the product is cut into ``splits`` parts along
   the rows, so no task sees all blocks.  The blocks hold at most ``MOST_ENTRIES`` numbers
   and are made larger with the table to keep their number, of which the driver holds the
   keys, near ``BLOCKS``.
3. The scatter has dimensions x dimensions entries.  It is decomposed on the driver
   (``eigh``), and the eigenvectors over the roots of their eigenvalues are multiplied to
   the blocks, which projects all rows.
4. The covariance of the projected rows is measured in the same way, as a proof.

Rows whose vector is null or holds a null, NaN or infinite entry are left out, and so are
rows with another number of entries than most (of equally frequent ones the larger).
Entries beyond 2^55 in size count as that.  Rows with equal or null ids stay rows of their own.
Components of no variance, below ``LEAST_SHARE`` of the largest, cannot be scaled to one
and are left out; with a single distinct vector, or an empty table, no rows remain.
``deviation`` is null where it exceeds 64 bits.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import partitions, stored

GRID = 64
SHIFT = 1_000_000
COMPONENTS = 16
BLOCKS = 1 << 16
LEAST_ENTRIES = 1 << 17  # numbers in a block
MOST_ENTRIES = 1 << 23
LEAST_SHARE = 1e-10
LARGEST = float(1 << 61)  # of 64 * c


def grid(vector: Column) -> Column:
    """The vector's whole numbers; null unless all of its entries are finite."""
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(c.cast("double")))
    clipped = lambda c: F.least(F.lit(LARGEST), F.greatest(F.lit(-LARGEST), c.cast("double") * GRID))
    return F.when(finite, F.transform(vector, lambda c: F.floor(clipped(c)).cast("bigint") + SHIFT))


def _commonest_length(rows: DataFrame) -> int:
    lengths = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
    first = lengths.first()
    return first["size"] if first else 0


def _numbered(df: DataFrame) -> DataFrame:
    """``df``, stored, with ``index`` from 0 without gaps."""
    rows = stored(df.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    part = F.shiftright("_at", 33)
    offsets = (  # one row for each partition that was written
        rows.groupBy(part.alias("_part"))
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.col("_at") - F.shiftleft(part, 33)
    return (
        rows.withColumn("_part", part)
        .join(offsets, "_part")
        .select((within + F.col("_offset")).alias("index"), *df.columns)
    )


@dataclass
class Sums:
    """Of the fit list: its length, and each dimension's sum, least and largest value."""

    n: int
    sums: list[int]
    low: list[int]
    high: list[int]

    @property
    def narrow(self) -> bool:
        """Whether 64 bits hold every deviation on the way."""
        spans = [max(abs(self.n * x - s) for x in ends) for s, *ends in zip(self.sums, self.low, self.high)]
        sizes = [self.n * max(abs(x) for x in ends) for ends in zip(self.low, self.high)]
        return sum(x * x for x in spans) < 1 << 63 and max(sizes) < 1 << 62


def _sums(fit: DataFrame) -> Sums:
    found = (
        fit.select(F.posexplode("x").alias("place", "value"))
        .groupBy("place")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("value").cast("decimal(19,0)").cast("decimal(28,0)")).alias("sum"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
        .orderBy("place")
        .collect()  # one row for each dimension
    )
    return Sums(found[0].n, [int(r["sum"]) for r in found], [r.low for r in found], [r.high for r in found])


def _centred(fit: DataFrame, sums: Sums) -> DataFrame:
    """index, deviation from the mean times n, squared, and the centred vector."""
    n, total, narrow = sums.n, sums.sums, sums.narrow

    def scan(batches) -> Iterator[pa.RecordBatch]:
        kind = np.int64 if narrow else object
        for batch in batches:
            x = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False), kind).reshape(batch.num_rows, len(total))
            apart = n * x - np.array(total, kind)
            squares = [v if v < 1 << 63 else None for v in map(int, (apart * apart).sum(axis=1))]
            values = (apart / n).astype(np.float64)
            offsets = np.arange(0, values.size + 1, len(total), dtype=np.int32)
            centred = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(squares, pa.int64()), centred], ["index", "deviation", "centred"]
            )

    return fit.select("index", "x").mapInArrow(scan, "index bigint, deviation bigint, centred array<double>")


def block_rows(n: int, width: int) -> int:
    """Rows of a block: few blocks, within the bounds of their size."""
    least, most = max(1, LEAST_ENTRIES // width), max(1, MOST_ENTRIES // width)
    return min(most, max(least, -(-n // BLOCKS)))


def block_matrix(rows: DataFrame, values: str, n: int, width: int) -> BlockMatrix:
    """Rows (index, array of doubles) as blocks of whole rows."""
    vectors = rows.select("index", array_to_vector(values).alias("vector"))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, width)
    return indexed.toBlockMatrix(block_rows(n, width), width)


def scatter(matrix: BlockMatrix, splits: int) -> np.ndarray:
    """The matrix's transpose times itself.

    Python's ``multiply`` has no argument for the number of splits along the rows, without
    which one task gets all blocks, so the method behind it is called."""
    turned = matrix.transpose()._java_matrix_wrapper
    product = turned.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def _projected(matrix: BlockMatrix, weights: np.ndarray, rows: DataFrame) -> DataFrame:
    """index and the row times ``weights``, stored."""
    spark = rows.sparkSession
    wide, narrow = weights.shape
    block = Matrices.dense(wide, narrow, weights.ravel(order="F").tolist())
    other = BlockMatrix(spark.sparkContext.parallelize([((0, 0), block)], 1), wide, narrow)
    found = callMLlibFunc("getIndexedRows", matrix.multiply(other).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return stored(found.select("index", vector_to_array("vector").alias("whitened")), "projected")


SCHEMA = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each row with a usable vector and each of the leading components: vec_id,
    component (from 1), n, deviation, whitened, explained and identity_error."""
    spark = df.sparkSession
    rows = df.select(F.col(vec_id).alias("vec_id"), grid(F.col(vector)).alias("x")).where("x IS NOT NULL")
    empty = spark.createDataFrame([], f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, {SCHEMA}")
    rows = stored(rows, "grid")
    width = _commonest_length(rows)
    if not width:
        return empty
    rows = rows.where(F.size("x") == width)
    fit = stored(_numbered(rows.select("x").distinct()), "fit")
    sums = _sums(fit)
    n, splits = sums.n, partitions(spark)
    centred = _centred(fit, sums)
    matrix = block_matrix(centred, "centred", n, width)
    values, vectors = np.linalg.eigh(scatter(matrix, splits) / n)
    order = [i for i in np.argsort(-values)[:components] if values[i] > LEAST_SHARE * values.max()]
    if not order or values.max() <= 0:
        return empty
    projected = _projected(matrix, vectors[:, order] / np.sqrt(values[order]), centred)
    again = scatter(block_matrix(projected, "whitened", n, len(order)), splits) / n
    error = float(np.abs(again - np.eye(len(order))).max())
    shares = F.array(*(F.lit(float(values[i] / values.sum())) for i in order))

    known = fit.select("index", "x").join(centred.select("index", "deviation"), "index").join(projected, "index")
    return rows.join(known, "x").select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
