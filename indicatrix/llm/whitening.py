"""Whitened embeddings by distributed block matrices.

Vectors become integers, whose sums are exact. The centred rows are numbered and dealt into the blocks of an MLlib
``BlockMatrix``; its transpose times itself is the scatter matrix, added up over parts of the long dimension, of which the driver
gets one matrix of the vectors' width. Its eigenvectors, divided by the deviations along them, are the whitening matrix; the block
matrix times it projects every row. The same product of the projected rows shows how far their covariance is from the identity.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, stored

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
#: Numbers in a block; blocks that one part of a product of long matrices adds up before parts are added to each other.
BLOCK, ADDED = 1 << 17, 64


def _blocks(rows: DataFrame, n: int, columns: int) -> BlockMatrix:
    """Rows (place, vector as array) as a block matrix of whole rows."""
    vectors = rows.select("place", array_to_vector("vector").alias("vector"))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, columns)
    return indexed.toBlockMatrix(max(BLOCK // columns, 16), columns)


def _scatter(matrix: BlockMatrix) -> np.ndarray:
    """The matrix's transpose times itself, in parts: the result is one block, which no single task may add up alone."""
    parts = max(1, math.ceil(matrix.numRowBlocks / ADDED))
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, parts)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def _rows(matrix: BlockMatrix) -> DataFrame:
    """Rows of a block matrix: place, vector as array. They stay in the JVM."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    place, vector = rows.columns
    return rows.select(F.col(place).alias("place"), vector_to_array(vector).alias("vector"))


def integers(vector: Column) -> Column:
    """``floor(64 * c) + 1000000`` of each entry; null for entries that are null, not finite, or beyond 64 bits."""
    def one(c):
        scaled = F.floor(c.cast("double") * SCALE)
        return F.when(F.abs(c.cast("double") * SCALE) < float(1 << 61), scaled.cast("long") + SHIFT)
    return F.transform(vector, one)


def whiten(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each vector and component up to ``components``: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold null or non-finite entries take no part; entries beyond 64 bits count as not finite, and a
    vector shorter than the longest lacks entries, so it holds nulls. ``deviation`` is null where it passes 64 bits. Components
    without any deviation (fewer rows than dimensions, rows all equal) cannot be whitened and are left out: a single vector gives
    no rows. Rows may repeat: each counts. Components' signs follow their largest entry. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    columns = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    whole = vectors.select(F.col(vec_id).alias("vec_id"), integers(F.col(vector)).alias("x"))
    whole = whole.where(F.col("x").isNotNull() & ~F.exists("x", lambda c: c.isNull()) & (F.size("x") > 0))
    width = whole.agg(F.max(F.size("x"))).first()[0]
    if width is None:
        return spark.createDataFrame([], columns)
    rows = numbered(whole.where(F.size("x") == width), "integers", "place")
    sums = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("x", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]).first()
    n, total = sums["n"], [int(sums[f"s{i}"]) for i in range(width)]
    # x - S/n = (n*x - S)/n: the whole part of the mean first, so that large sums lose no digits
    base = [s // n for s in total]
    rest = [(s - b * n) / n for s, b in zip(total, base, strict=True)]
    bases = F.array(*[F.lit(b).cast("long") for b in base])
    centred = F.zip_with(F.zip_with("x", bases, lambda x, b: (x - b).cast("double")),
                         F.array(*[F.lit(r) for r in rest]), lambda x, r: x - r)
    matrix = _blocks(rows.select("place", centred.alias("vector")), n, width)
    variance = _scatter(matrix) / n
    values, directions = np.linalg.eigh((variance + variance.T) / 2)
    order = np.argsort(-values, kind="stable")
    values, directions = values[order], directions[:, order]
    some = int((values[:components] > max(values[0], 0) * 1e-12 * width).sum()) if values[0] > 0 else 0
    if not some:
        return spark.createDataFrame([], columns)
    directions = directions[:, :some] * np.sign(directions[np.abs(directions[:, :some]).argmax(0), np.arange(some)])
    matrix_of = directions / np.sqrt(values[:some])
    block = spark.sparkContext.parallelize([((0, 0), Matrices.dense(width, some, matrix_of.ravel(order="F").tolist()))], 1)
    projected = stored(_rows(matrix.multiply(BlockMatrix(block, width, some))), "projected")

    means = projected.agg(*[F.avg(F.get("vector", F.lit(i))).alias(f"m{i}") for i in range(some)]).first()
    mean = np.array([means[f"m{i}"] for i in range(some)])
    away = F.zip_with("vector", F.array(*[F.lit(float(m)) for m in mean]), lambda x, m: x - m)
    covariance = _scatter(_blocks(projected.select("place", away.alias("vector")), n, some)) / n
    error = float(np.abs(covariance - np.eye(some)).max())

    sum_of = F.array(*[F.lit(str(s)).cast("decimal(38,0)") for s in total])
    far = F.zip_with("x", sum_of, lambda x, s: x.cast("decimal(19,0)") * F.lit(n).cast("decimal(19,0)") - s)
    squares = F.transform(far, lambda d: F.try_multiply(d.try_cast("decimal(19,0)"), d.try_cast("decimal(19,0)")))
    zero = F.lit(0).cast("decimal(38,0)")
    deviation = F.aggregate(squares, zero, lambda t, s: F.try_add(t, s).try_cast("decimal(38,0)")).try_cast("long")
    share = F.array(*[F.lit(float(v / values.sum())) for v in values[:some]])
    out = rows.select("place", "vec_id", deviation.alias("deviation")).join(projected, "place")
    out = out.select("vec_id", "deviation", F.posexplode("vector").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
