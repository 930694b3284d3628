"""Embedding whitening with MLlib's BlockMatrix.

Centred rows become blocks of a distributed matrix A. Its scatter matrix is AᵀA, whose size
depends on the dimensions only; the driver takes its eigenvectors and sends back the whitening
matrix W as one more BlockMatrix, and AW holds every row projected. Rows stay in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclograph.llm.columns import named
from cyclograph.session import materialize

SCALE = 256
BLOCK_ROWS = 1024
BLOCK_COLUMNS = 1024
BLOCKS_AT_ONCE = 64
"""Row blocks whose scatter one task adds up."""

RANK_TOLERANCE = 1e-12
"""Eigenvalues up to this share of the trace count as zero and make no component."""

LARGEST = 1 << 53
_PART_BITS = 33  # monotonically_increasing_id: the partition above, the row below


@dataclass
class Whitened:
    """``rows``: the kept rows with ``n_fit``, ``deviation`` and ``whitened`` (one value a component)."""

    rows: DataFrame
    n: int
    explained: list[float]
    identity_error: float


def scaled(vector: Column) -> Column:
    """The entries as whole numbers, floor(256 c)."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return F.coalesce(finite, F.lit(False))


def _indexed(stored: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows 0, 1, 2 ... from ids stored by ``monotonically_increasing_id``."""
    part = F.shiftright(id_column, _PART_BITS)
    sizes = sorted((r[0], r[1]) for r in stored.groupBy(part.alias("part")).count().collect())  # one entry a written file
    begin, begins = 0, []
    for number, size in sizes:
        begins.append((number, begin))
        begin += size
    offsets = F.broadcast(stored.sparkSession.createDataFrame(begins, "__part bigint, __begin bigint"))
    row = F.col(id_column).bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    return stored.join(offsets, part == F.col("__part")).withColumn("index", F.col("__begin") + row).drop("__part", "__begin")


def _numbered(df: DataFrame, label: str) -> DataFrame:
    """Stored once, so that every later reader sees the same ids."""
    return materialize(df.withColumn("id", F.monotonically_increasing_id()), label)


def _blocks(rows: DataFrame, mean: list[float], n: int) -> BlockMatrix:
    """(index, x) as the blocks of a matrix of centred rows."""
    centre = F.array(*[F.lit(m) for m in mean])
    centred = F.zip_with("x", centre, lambda x, m: x.cast("double") - m)
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(centred).alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, len(mean)).toBlockMatrix(BLOCK_ROWS, BLOCK_COLUMNS)


def _scatter(a: BlockMatrix) -> np.ndarray:
    """AᵀA. All its blocks add up to few, so the inner dimension is split over tasks first."""
    turned = a.transpose()
    splits = max(1, -(-a.numRowBlocks // BLOCKS_AT_ONCE))
    product = turned._java_matrix_wrapper.call("multiply", a._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, turned.rowsPerBlock, a.colsPerBlock).toLocalMatrix().toArray()


def _project(a: BlockMatrix, w: np.ndarray) -> DataFrame:
    """(index, values) of AW."""
    spark_blocks = [
        ((i // BLOCK_COLUMNS, 0), Matrices.dense(len(part), w.shape[1], part.ravel(order="F").tolist()))
        for i in range(0, len(w), BLOCK_COLUMNS)
        for part in [w[i : i + BLOCK_COLUMNS]]
    ]
    context = a.blocks.context
    right = BlockMatrix(context.parallelize(spark_blocks, 1), BLOCK_COLUMNS, w.shape[1], len(w), w.shape[1])
    product = a.multiply(right).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("values"))


def whiten(df: DataFrame, column: str = "embedding", components: int = 4) -> Whitened:
    """Project every usable vector on the leading principal components, each to variance 1.

    Entries are scaled to whole numbers x = floor(256 c). Rows whose vector is null or holds a
    null or non-finite entry are dropped; all others stay with all their columns, repeated rows
    too; columns named like the three new ones are replaced. The components come from the fit
    list, each distinct x once, so copies weigh nothing. They are numbered by falling eigenvalue;
    fewer than ``components`` if the list has a lower rank (none if all x are equal, or there are
    no rows), as a direction without variance can't be whitened. ``deviation`` is
    the exact sum of (n x - S)² over the dimensions, S being the fit list's sums. Vectors of
    different lengths, empty vectors and entries whose x reaches 2^53 raise ValueError; a
    deviation above a long raises Spark's overflow error.
    """
    new = {"n_fit", "deviation", "whitened"}
    kept = [c for c in df.columns if c.lower() not in new]
    vector = named(column)
    valid = df.filter(usable(vector))
    rows = _numbered(valid.select(F.struct(*[named(c) for c in kept]).alias("row"), scaled(vector).alias("x")), "whiten-rows")
    lengths = rows.agg(
        F.min(F.size("x")), F.max(F.size("x")), F.max(F.array_max(F.transform("x", lambda c: F.greatest(c, -1 - c)))), F.count("*")
    ).first()
    if not lengths[3]:
        return Whitened(_outcome(rows, "0L", "0L", "array()"), 0, [], 0.0)
    if lengths[0] != lengths[1] or not lengths[0]:
        raise ValueError(f"vectors of {lengths[0]} to {lengths[1]} entries")
    if lengths[2] >= LARGEST:
        raise ValueError("entries too large")

    fit = _numbered(rows.groupBy("x").agg(F.min("id").alias("row_id")), "whiten-fit")
    summed = {r[0]: r[1] for r in fit.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col")).collect()}  # one a dimension
    sums, n = [summed[i] for i in range(lengths[0])], fit.count()
    mean = [s / n for s in sums]
    covariance = _scatter(_blocks(_indexed(fit), mean, n)) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(covariance))
    k = min(components, int((values > RANK_TOLERANCE * trace).sum())) if trace > 0 else 0

    totals = F.array(*[F.lit(s).cast("bigint") for s in sums])
    parts = F.zip_with("x", totals, lambda x, s: (F.lit(n).cast("bigint") * x - s) * (F.lit(n).cast("bigint") * x - s))
    deviation = F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, part: total + part)
    rows = rows.withColumn("deviation", deviation)
    if not k:
        return Whitened(_outcome(rows, f"{n}L", "deviation", "array()"), n, [], 0.0)
    indexed = _indexed(rows)
    projected = _project(_blocks(indexed, mean, lengths[3]), vectors[:, :k] / np.sqrt(values[:k]))
    chosen = fit.select(F.col("row_id").alias("id"), F.lit(True).alias("fitted"))
    joined = indexed.select("row", "deviation", "index", "id").join(projected, "index").join(chosen, "id", "left")
    whole = materialize(joined.select("row", "deviation", F.col("values"), F.col("fitted").isNotNull().alias("fitted")), "whitened")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    covered = whole.filter("fitted").agg(*[F.covar_pop(F.col("values")[i], F.col("values")[j]) for i, j in pairs]).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(covered, pairs))
    return Whitened(_outcome(whole, f"{n}L", "deviation", "values"), n, [float(v / trace) for v in values[:k]], float(error))


def _outcome(rows: DataFrame, n: str, deviation: str, values: str) -> DataFrame:
    return rows.select(
        "row.*",
        F.expr(n).alias("n_fit"),
        F.expr(deviation).alias("deviation"),
        F.expr(f"CAST({values} AS array<double>)").alias("whitened"),
    )
