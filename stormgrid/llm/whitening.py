"""Whitened embeddings through distributed block matrices.

The centred vectors are indexed rows of an MLlib ``BlockMatrix``; its transpose times itself is the scatter matrix, the one thing
that comes to the driver (dimension squared, whatever the number of rows). Its eigenvectors over the roots of the eigenvalues
make the whitening matrix, and a second block multiplication projects all rows. Both products are dealt over the row
blocks: the scatter in ``_SPLITS_OF`` blocks a task, added up per pair of column blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRow, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
_BLOCK = 1 << 16        # entries of a block of rows: half a megabyte
_SPLITS_OF = 16         # row blocks of one task of a product
_COLUMNS = 1024         # entries of a row in one block
_ROW_BITS = 33          # monotonically_increasing_id keeps the partition above these bits


def usable(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(vec_id, x)``: whole-number entries of the vectors that are neither null, empty nor hold a null, NaN or infinity, and
    that have the commonest length (of equally common ones the longest)."""
    vec = F.col("v")
    finite = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    whole = F.transform(vec, lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("long"))
    kept = table.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0)).where(finite).select("vec_id", whole.alias("x"))
    sizes = kept.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    usual = sizes.agg(F.max(F.struct("n", "d")).alias("m")).select(F.col("m.d").alias("d"))
    return kept.join(F.broadcast(usual), F.size("x") == F.col("d")).drop("d")         # one row


def _sums(rows: DataFrame) -> DataFrame:
    """Number of rows and sum of every dimension, added up inside each partition first."""
    def parts(batches):
        n, total = 0, None
        for batch in batches:
            x = batch.column(0)
            if len(x):
                flat = x.flatten().to_numpy().reshape(len(x), -1)
                n, total = n + len(x), flat.sum(0) + (0 if total is None else total)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()], pa.list_(pa.int64()))], ["n", "s"])

    apart = rows.select("x").mapInArrow(parts, "n bigint, s array<bigint>")
    return apart.select("n", F.posexplode("s").alias("k", "s")).groupBy("k").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def _indexed(rows: DataFrame) -> DataFrame:
    """Positions from 0 on: the place inside a partition after the rows of the partitions before it (one row a partition)."""
    part = F.shiftright("mid", _ROW_BITS)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.withColumn("part", part).join(F.broadcast(starts), "part").withColumn(
        "index", F.col("start") + F.col("mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).drop("part", "start", "mid")


def _times(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """Product with the shared dimension dealt over ``splits`` tasks."""
    return BlockMatrix(a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits),
                       a.rowsPerBlock, b.colsPerBlock)


def _scatter(a: BlockMatrix, blocks: int) -> np.ndarray:
    """``a`` transposed times ``a``, as a local matrix of its columns."""
    got = _times(a.transpose(), a, math.ceil(blocks / _SPLITS_OF)).toLocalMatrix().toArray()
    return (got + got.T) / 2


def axes(cov: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns, largest entry of each positive."""
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
    peak = vector[np.abs(vector).argmax(0), np.arange(vector.shape[1])]
    return value, vector * np.where(peak < 0, -1.0, 1.0)


def whitened(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: one row per usable vector and component.

    Entries become whole numbers ``floor(1024 * entry) + 100000`` first (one beyond a long raises an error). ``deviation`` is exact,
    and null where it does not fit a long. A direction without spread (an eigenvalue no larger than rounding) has ``whitened`` 0
    and takes no part in ``identity_error``; a table in which no direction has any has ``explained`` 0. Vectors of another
    length than the commonest are left out. Repeated rows and null ids count and stay; an empty table, or one without a usable vector,
    gives an empty one; other columns are not looked at. The driver holds the covariance only (8 bytes by dimension squared).
    """
    spark = table.sparkSession
    kind = table.schema[id_col].dataType.simpleString()
    rows = staged(usable(table, id_col, vec_col).withColumn("mid", F.monotonically_increasing_id()), "whitening")
    told = sorted(_sums(rows).collect())                    # one row per dimension
    if not told:
        return spark.createDataFrame([], f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, "
                                         "explained double, identity_error double")
    n, sums, dim = told[0].n, [r.s for r in told], len(told)
    components = min(components, dim)
    rows = _indexed(rows)
    centre = F.array(*[F.lit(s / n) for s in sums])
    centred = rows.select("index", array_to_vector(F.zip_with("x", centre, lambda x, m: x - m)).alias("vector"))
    high, wide = max(1, _BLOCK // dim), min(dim, _COLUMNS)
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(centred, "vector"), n, dim).toBlockMatrix(high, wide)
    blocks = math.ceil(n / high)
    cov = _scatter(matrix, blocks) / n
    value, vector = axes(cov, components)
    trace, spread = float(np.trace(cov)), value > max(value[0], 0) * dim * np.finfo(float).eps
    turn = np.where(spread, vector / np.sqrt(np.where(spread, value, 1.0)), 0.0)
    steps = IndexedRowMatrix(spark.sparkContext.parallelize([IndexedRow(i, r) for i, r in enumerate(turn)], 1), dim, components)
    projected = _times(matrix, steps.toBlockMatrix(wide, components), 1)
    gap = np.abs(_scatter(projected, blocks) / n - np.eye(components))[np.ix_(spread, spread)]
    told = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)

    off = F.zip_with("x", F.array(*[F.lit(s) for s in sums]), lambda x, s: (F.lit(n) * x - s).cast("decimal(19,0)"))
    square = F.aggregate(off, F.lit(0).cast("decimal(38,0)"), lambda t, v: (t + v * v).cast("decimal(38,0)"))
    named = rows.select("index", "vec_id", square.try_cast("bigint").alias("deviation"))
    share = F.array(*[F.lit(float(v / trace) if trace > 0 else 0.0) for v in value])
    return named.join(told.select("index", vector_to_array("vector").alias("y")), "index").select(
        "vec_id", "deviation", F.posexplode("y").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share[F.col("k")].alias("explained"), F.lit(float(gap.max(initial=0.0))).alias("identity_error"))
