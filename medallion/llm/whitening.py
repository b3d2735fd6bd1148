"""Whitening of embeddings with distributed block matrices.

Centred rows are indexed into a block matrix; its transpose times itself gives the scatter, whose eigenvectors
are found on the driver (its side is the number of dimensions). Another block product with the whitening matrix
projects all rows.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Rows of a block, and blocks of a product that meet in one task.
BLOCK_ROWS, BLOCKS_A_TASK = 1_024, 8
#: Eigenvalues below this share of the largest are nothing but rounding.
LEAST_SHARE = 1e-12

WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def shifted(embeddings: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x): floor(scale * c) + shift of every component c as long.

    Rows whose vector is null, empty or holds null or non-finite components take no part. A component that
    doesn't fit a long when scaled is an error.
    """
    c = F.col("c").cast("double")
    finite = F.forall("v", lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    scaled = F.transform("v", lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long") + F.lit(shift))
    return rows.select("vec_id", scaled.alias("x"))


def numbered(rows: DataFrame, label: str) -> tuple[DataFrame, int]:
    """`rows` stored with `at`, numbers from 0 on without gaps, and how many there are.

    Only the number of rows of each written partition is collected, and broadcast.
    """
    rows = stored(rows.withColumn("place", F.monotonically_increasing_id()), label)
    part = F.shiftright("place", 33).alias("part")
    sizes = sorted((r.part, r["count"]) for r in rows.groupBy(part).count().collect())
    begins = np.cumsum([0, *(size for _, size in sizes)]).tolist()
    begin = rows.sparkSession.createDataFrame(
        [(p, b) for (p, _), b in zip(sizes, begins)] or [(0, 0)], "part long, begin long"
    )
    at = (F.col("begin") + F.col("place") - F.shiftleft(F.col("part"), 33)).alias("at")
    own = [c for c in rows.columns if c != "place"]
    return rows.withColumn("part", part).join(F.broadcast(begin), "part").select(at, *own), begins[-1]


def block_matrix(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """Block matrix of rows (at, v array of double); `at` runs from 0 to n - 1."""
    vectors = rows.select("at", array_to_vector("v").alias("v"))
    vectors = MLUtils.convertVectorColumnsFromML(vectors, "v")
    return IndexedRowMatrix(vectors, n, width).toBlockMatrix(BLOCK_ROWS, width)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transpose of a matrix of few columns times itself, on the driver.

    Row blocks are dealt to tasks, a few to each, whose products are added up.
    """
    blocks = -(-matrix.numRows() // BLOCK_ROWS)
    tasks = max(1, -(-blocks // BLOCKS_A_TASK))
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, tasks)
    return BlockMatrix(product, matrix.numCols(), matrix.numCols()).toLocalMatrix().toArray()


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error) of the whitened embeddings.

    The distribution is that of the distinct vectors x of `shifted`, each counted once: n of them, with sums S by
    dimension. Components are unit eigenvectors of x's covariance V, from 1 on by falling eigenvalue e, signed so
    that the entry of largest size is positive; at most `components`. `deviation` is the sum of (n * x - S)^2,
    exact; `whitened` is x - S / n on the component, over sqrt(e); `explained` is e over the trace of V;
    `identity_error` is the largest entry by which the covariance of the whitened distinct vectors, as computed,
    differs from the identity.

    Repeated rows and null ids give rows of their own. Components without variance (eigenvalues that are nothing
    but rounding) have no rows, so one distinct vector or none gives an empty result. Vectors of several lengths
    are an error, and so are values beyond a long in `deviation`. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    rows, count = numbered(shifted(embeddings), "whitening-rows")
    fit, n = numbered(rows.select("x").distinct(), "whitening-fit")
    sizes = fit.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if not n:
        return spark.createDataFrame([], WHITENED)
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors of {sizes[0]} to {sizes[1]} components")
    width = sizes[0]
    sums = [F.sum(F.col("x")[k]).alias(f"s{k}") for k in range(width)]
    total = [int(s) for s in fit.agg(*sums).first()]

    # n * x - S is exact in longs; centred values are that over n.
    deep = F.zip_with("x", F.array(*[F.lit(s).cast("long") for s in total]), lambda x, s: x * F.lit(n) - s)
    centre = F.transform("deep", lambda d: d.cast("double") / F.lit(float(n)))

    def centred(df: DataFrame) -> DataFrame:
        return df.select("at", deep.alias("deep")).select("at", centre.alias("v"))

    # Used three times; what a lost executor held is made again from the stored rows.
    matrix = block_matrix(centred(fit), n, width).persist(StorageLevel.MEMORY_AND_DISK)
    values, vectors = np.linalg.eigh(scatter(matrix) / n)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > LEAST_SHARE * max(values[-1], 0)]
    if not order.size or values[-1] <= 0:
        return spark.createDataFrame([], WHITENED)
    turn = vectors[:, order]
    turn = turn * np.sign(turn[np.abs(turn).argmax(0), np.arange(order.size)])
    explained = (values[order] / values.sum()).tolist()
    projection = turn / np.sqrt(values[order])

    weights = spark.createDataFrame([(k, row) for k, row in enumerate(projection.tolist())], "at long, v array<double>")
    weights = IndexedRowMatrix(
        MLUtils.convertVectorColumnsFromML(weights.select("at", array_to_vector("v").alias("v")), "v"),
        width,
        order.size,
    ).toBlockMatrix(width, order.size)
    own = matrix.multiply(weights).persist(StorageLevel.MEMORY_AND_DISK)
    error = float(np.abs(scatter(own) / n - np.eye(order.size)).max())
    for done in (own, matrix):
        done._java_matrix_wrapper._java_model.blocks().unpersist(False)

    projected = block_matrix(centred(rows), count, width).multiply(weights).toIndexedRowMatrix()
    projected = callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model).select(
        F.col("index").alias("at"), vector_to_array("vector").alias("z")
    )
    square = F.aggregate("deep", F.lit(0).cast("long"), lambda sum_, d: sum_ + d * d)
    kept = rows.select("at", "vec_id", deep.alias("deep")).select("at", "vec_id", square.alias("deviation"))
    share = F.array(*[F.lit(e) for e in explained])
    out = kept.join(projected, "at").select(
        "vec_id", "deviation", F.posexplode("z").alias("k", "whitened")
    )
    return out.select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        share[F.col("k")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
