"""Whitened embeddings through Spark MLlib's distributed block matrices.

Vectors become fixed-point longs, so that their sums and deviations are exact. Every vector gets a
running row number; centred rows go into an IndexedRowMatrix and from there into a BlockMatrix.

* Scatter: the block matrix, transposed, times itself. The middle dimension is cut into as many
  parts as there are tasks, so that no task sees more than its share of the row blocks; the sums
  of d x d products combine map-side, and one d x d matrix reaches the driver.
* Components: `eigh` of scatter / n on the driver, largest first. A component's sign is such that
  its largest entry is positive.
* Projection: the block matrix times the d x k whitening matrix, back as numbered rows.

The driver holds a few d x d matrices (d = dimensions), whatever the number of vectors.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import numbered, stored

# A vector entry c counts as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Entries of a block (doubles, so 2 MB), and its most columns.
BLOCK_ENTRIES, BLOCK_COLUMNS = 262_144, 1_024

SCHEMA = (
    "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def _fixed(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))


def _usable(vector: Column) -> Column:
    """True for a vector with entries that are all present and finite."""
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def _at_each_place(rows: DataFrame, column: str, measure) -> list:
    """One value per place of an array column, from an aggregate that combines map-side."""
    found = rows.select(F.posexplode(column).alias("place", "entry")).groupBy("place").agg(
        measure("entry").alias("value")).collect()
    return [r.value for r in sorted(found, key=lambda r: r.place)]


def _array(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def block_matrix(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """Numbered rows (number, values: array of doubles) as a block matrix."""
    columns = min(width, BLOCK_COLUMNS)
    indexed = MLUtils.convertVectorColumnsFromML(
        rows.select(F.col("number").alias("index"), array_to_vector("values").alias("vector")), "vector")
    return IndexedRowMatrix(indexed, n, width).toBlockMatrix(max(1, BLOCK_ENTRIES // columns), columns)


def scatter(matrix: BlockMatrix, parts: int) -> np.ndarray:
    """Transposed matrix times matrix, on the driver: width x width."""
    java = matrix._java_matrix_wrapper._java_model
    product = java.transpose().multiply(java, max(1, min(parts, matrix.numRowBlocks)))
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def projected(matrix: BlockMatrix, weights: np.ndarray) -> DataFrame:
    """(number, values) of the matrix times local weights."""
    width, k = weights.shape
    step = matrix.colsPerBlock
    pieces = [((i // step, 0), DenseMatrix(len(w), k, w.ravel(order="F")))
              for i in range(0, width, step) for w in [weights[i: i + step]]]
    context = matrix.blocks.context
    right = BlockMatrix(context.parallelize(pieces, 1), step, k, width, k)
    indexed = matrix.multiply(right).toIndexedRowMatrix()
    frame = MLUtils.convertVectorColumnsToML(
        callMLlibFunc("getIndexedRows", indexed._java_matrix_wrapper._java_model), "vector")
    return frame.select(F.col("index").alias("number"), vector_to_array("vector").alias("values"))


def principal(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and unit eigenvectors as columns, `most` at most."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


def whiten(vectors: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """Per usable vector and component: its coordinate in units of the component's deviation.

    Returns vec_id, component (from 1), n, deviation, whitened, explained, identity_error. Every
    usable row counts and is returned, rows that repeat and rows without an id included. A
    null vector, one without entries and one that holds a null or non-finite entry are left out.
    Vectors of different lengths are an error. A component without variance (all rows equal, or
    fewer rows than dimensions) has explained 0 and a null coordinate; without any variance
    explained is null too. identity_error looks at components with variance. A deviation
    beyond a long is null. No rows give no rows.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_column].dataType.simpleString()
    rows = numbered(
        vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("v"))
        .where(_usable(F.col("v"))).select("vec_id", _fixed(F.col("v")).alias("x")), "vectors")
    shape = rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    n, width = shape.n, shape.high
    if not n:
        return spark.createDataFrame([], SCHEMA.format(id=kind))
    if shape.low != width:
        raise ValueError(f"vectors of {shape.low} and of {width} entries")
    sums = _at_each_place(rows, "x", F.sum)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    # n * x - S is exact in longs; the division is the only rounding.
    off = F.zip_with("x", _array(sums, "long"), lambda x, s: F.try_subtract(F.try_multiply(x, F.lit(n).cast("long")), s))
    centred = rows.select("number", F.transform(off, lambda v: v.cast("double") / n).alias("values"))
    matrix = block_matrix(centred, n, width)
    covariance = scatter(matrix, parts) / n
    values, axes = principal(covariance, min(components, width))
    trace = float(np.trace(covariance))
    varies = values > max(values[0], 0.0) * width * np.finfo(float).eps
    weights = np.where(varies, axes / np.sqrt(np.where(varies, values, 1.0)), 0.0)
    whitened = stored(projected(matrix, weights), "whitened")

    means = _at_each_place(whitened, "values", F.avg)
    again = whitened.select("number", F.zip_with("values", _array(means, "double"), lambda v, m: v - m).alias("values"))
    kept = np.flatnonzero(varies)
    error = None
    if len(kept):
        product = scatter(block_matrix(again, n, len(values)), parts)[np.ix_(kept, kept)] / n
        error = float(np.abs(product - np.eye(len(kept))).max())
    explained = [float(max(v, 0.0) / trace) if trace > 0 and ok else (0.0 if trace > 0 else None)
                 for v, ok in zip(values, varies)]

    deviation = F.aggregate(off, F.lit(0).cast("long"), lambda total, v: F.try_add(total, F.try_multiply(v, v)))
    flat = rows.select("number", "vec_id", deviation.alias("deviation")).join(whitened, "number").select(
        "vec_id", "deviation", F.posexplode("values").alias("place", "value"))
    place = F.col("place") + 1
    return flat.select(
        "vec_id", place.cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.when(F.element_at(_array([bool(v) for v in varies], "boolean"), place), F.col("value")).alias("whitened"),
        F.element_at(_array(explained, "double"), place).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
