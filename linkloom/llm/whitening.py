"""Whitening of embeddings by their principal components, with distributed block matrices.

Vectors are put on a grid of 1/256, so that sums are exact.  The covariance is that of the different
vectors: these, centred, are indexed into a ``BlockMatrix``, and the transpose times the matrix is their
scatter.  Its products are split over ranges of row blocks and added up, so no task meets all blocks.
Only the scatter, as wide as the vectors, goes to the driver for its eigenvectors; a second block product
projects all rows on them.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.shared import written

GRID = 256
COMPONENTS = 4
#: Rows and columns of a block, and row blocks whose products one task adds up.
BLOCK_ROWS, BLOCK_COLUMNS, BLOCKS_PER_TASK = 1024, 1024, 32
#: Eigenvalues below this share of the largest are rounding errors of a dependent dimension.
LEAST_SHARE = 1e-12

SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double,"
    " identity_error double"
)


def on_grid(vector: Column) -> Column:
    """Entries as whole numbers of 1/256, rounded down; null if one is missing or not finite."""
    whole = F.forall(
        vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    )
    return F.when(
        whole & (F.size(vector) > 0),
        F.transform(vector, lambda e: F.floor(F.lit(GRID) * e.cast("double")).cast("long")),
    )


def indexed(df: DataFrame) -> tuple[DataFrame, int]:
    """``df``, written, with the column ``row``: 0, 1, ... without gaps; and the number of rows.

    A task numbers its own rows; only the number of rows of each task goes to the driver.
    """
    own = F.monotonically_increasing_id()
    numbered = written(df.withColumn("at", own)).withColumn("task", F.shiftright("at", 33))
    starts, before = [], 0
    for task, n in sorted(tuple(r) for r in numbered.groupBy("task").count().collect()):
        starts.append((task, before - (task << 33)))
        before += n
    starts = df.sparkSession.createDataFrame(starts, "task long, shift long")
    row = (F.col("at") + F.col("shift")).alias("row")
    return numbered.join(F.broadcast(starts), "task").select(*df.columns, row), before


def block_matrix(df: DataFrame, rows: int, columns: int, block_rows: int = BLOCK_ROWS) -> BlockMatrix:
    """The blocks of ``row, v`` with ``v`` an array of doubles; made by the JVM."""
    vectors = df.select("row", array_to_vector("v").alias("v"))
    vectors = MLUtils.convertVectorColumnsFromML(vectors, "v")
    return IndexedRowMatrix(vectors, rows, columns).toBlockMatrix(block_rows, BLOCK_COLUMNS)


def product(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """``left`` times ``right``; the blocks that a sum runs over are dealt to so many tasks."""
    other = right._java_matrix_wrapper._java_model
    java = left._java_matrix_wrapper.call("multiply", other, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def scatter(matrix: BlockMatrix, rows: int) -> np.ndarray:
    """The transpose times the matrix, as a local array."""
    splits = max(1, -(-rows // (BLOCK_ROWS * BLOCKS_PER_TASK)))
    return product(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()


def projected(df: DataFrame, rows: int, projection: np.ndarray) -> DataFrame:
    """``row, z``: the vectors of ``row, v`` times a local matrix."""
    d, k = projection.shape
    small = df.sparkSession.createDataFrame(
        [(i, r) for i, r in enumerate(projection.tolist())], "row long, v array<double>"
    )
    small = block_matrix(small.coalesce(1), d, k, BLOCK_COLUMNS)
    out = product(block_matrix(df, rows, d), small).toIndexedRowMatrix()
    back = callMLlibFunc("getIndexedRows", out._java_matrix_wrapper._java_model)
    index, vector = back.columns
    vectors = MLUtils.convertVectorColumnsToML(back, vector)
    return vectors.select(F.col(index).alias("row"), vector_to_array(vector).alias("z"))


def dimension_sums(fit: DataFrame) -> list[int]:
    """The exact sum of ``x`` in each dimension."""
    entries = fit.select(F.posexplode("x").alias("k", "x"))
    return [s for _, s in sorted(tuple(r) for r in entries.groupBy("k").agg(F.sum("x")).collect())]


def _largest_error(z: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the covariance of ``z``, centred first, minus the identity."""
    means = z.agg(*(F.avg(F.get("z", F.lit(i))) for i in range(k))).first()
    apart = [F.get("z", F.lit(i)) - F.lit(means[i]) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = z.agg(*(F.sum(apart[i] * apart[j]) for i, j in pairs)).first()
    return max(abs(s / n - (i == j)) for s, (i, j) in zip(sums, pairs))


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    One row for each vector that is kept and each component.  Entries are rounded down to 1/256.  The
    ``n`` different vectors, each once, have the covariance whose components, numbered by falling
    variance, a vector less their mean is projected on and divided by the standard deviation;
    ``explained`` is the component's share of the variance.  ``deviation`` is the sum over dimensions of
    (n*x - sum)^2, exact: one beyond a long is an error.  ``identity_error`` is the largest entry of the
    whitened vectors' covariance minus the identity.

    Rows whose vector is null, empty or holds null or non-finite entries are left out, as are vectors of
    another length than most have (of equally frequent lengths the larger counts).  ``vec_id`` may be
    null or repeated; other columns are not read.  Components without variance, as of one vector only,
    are left out; an empty table gives an empty one.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), on_grid(F.col("embedding")).alias("x")
    ).where("x is not null")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    most = lengths.first()
    if most is None:
        return spark.createDataFrame([], SCHEMA)
    d = most.d
    rows, n_rows = indexed(rows.where(F.size("x") == d))
    fit, n = indexed(rows.select("x").distinct())
    sums = dimension_sums(fit)
    means = F.array(*(F.lit(s / n) for s in sums))
    centred = F.zip_with("x", means, lambda x, m: x.cast("double") - m).alias("v")

    covariance = scatter(block_matrix(fit.select("row", centred), n, d), n) / n
    variances, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    variances, vectors = variances[::-1], vectors[:, ::-1]
    k = int((variances[:components] > max(variances[0], 0) * LEAST_SHARE).sum())
    if not k:
        return spark.createDataFrame([], SCHEMA)
    projection = vectors[:, :k] / np.sqrt(variances[:k])
    explained = variances[:k] / np.trace(covariance)

    error = _largest_error(projected(fit.select("row", centred), n, projection), n, k)
    exact = F.array(*(F.lit(s).cast("long") for s in sums))
    apart = F.zip_with("x", exact, lambda x, s: x * F.lit(n).cast("long") - s)
    deviation = F.aggregate(apart, F.lit(0).cast("long"), lambda total, a: total + a * a)
    shares = F.array(*(F.lit(float(e)) for e in explained))
    z = projected(rows.select("row", centred), n_rows, projection)
    return (
        rows.select("row", "vec_id", deviation.alias("deviation")).join(z, "row")
        .select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
        .select(
            "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"),
            "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"),
            F.lit(float(error)).alias("identity_error"),
        )
    )
