"""Whitening of embeddings with distributed block matrices.

Each entry c becomes the whole number x = floor(64 * c) + 1000000, so sums are exact. Rows are centred as
(x - S div n) - (S mod n) / n, where S are the sums of the dimensions: the first difference is exact, so
the large offset costs no digits. Centred rows get a running index and become an IndexedRowMatrix and then
a BlockMatrix of blocks of about BLOCK_BYTES. Its transpose times itself is the scatter matrix, a square
of the dimension, which alone comes to the driver; its eigenvectors over the roots of their eigenvalues are
the whitening matrix, and the BlockMatrix times that matrix projects all rows. The covariance of what comes
out is taken the same way and compared with the identity.

The product that gives the scatter matrix has a single result block, to which Spark would send all blocks;
the middle dimension is therefore split, so that each task multiplies the blocks of a few row ranges and
only squares of the dimension are summed. The driver gets, besides them, n, S and the blocks' coordinates.

Defined cases: rows whose vector is null, empty, or holds null, non-finite or (beyond 2^55) not
representable entries are left out; rows without vec_id and with repeated ones take part like others;
vectors of different dimensions are whitened apart, each dimension as a fit list of its own; components
without variance (up to 1e-12 of the trace) have ``whitened`` null and ``explained`` 0; a deviation beyond
a long is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daytally.llm.common import tabled

# Scale and offset of the whole numbers.
SCALE, OFFSET = 64, 1_000_000
#: Components that are returned, at most.
COMPONENTS = 32
#: Size of a block of rows, and columns of one.
BLOCK_BYTES, BLOCK_COLUMNS = 4_000_000, 1024
#: Eigenvalues up to this share of the trace count as none.
NO_VARIANCE = 1e-12

RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_numbers(embeddings: DataFrame) -> DataFrame:
    """vec_id, dim, x of the usable rows, and ``place``, which is in order within each task's rows."""
    entries = F.transform("embedding", lambda c: c.cast("double"))
    plain = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), entries.alias("entries"))
    usable = F.forall("entries", lambda c: F.coalesce(F.abs(c) < 2.0**55, F.lit(False)))
    x = F.transform("entries", lambda c: F.floor(SCALE * c).cast("long") + OFFSET)
    rows = plain.where(usable & (F.size("entries") > 0))
    return rows.select("vec_id", F.size("entries").alias("dim"), x.alias("x"), F.monotonically_increasing_id().alias("place"))


def indexed(rows: DataFrame) -> DataFrame:
    """The rows with ``index``, counted on from task to task.

    Indices of rows of another dimension stay free: a missing row of a block matrix is zero and changes
    no product.
    """
    task = F.shiftright("place", 33)
    counts = rows.groupBy(task.alias("task")).agg(F.min("place").alias("first"), F.max("place").alias("last"))
    # One row for each task that wrote rows.
    before = F.sum(F.col("last") - F.col("first") + 1).over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("task", (F.col("first") - F.coalesce(before, F.lit(0))).alias("less"))
    return rows.withColumn("task", task).join(starts, "task").withColumn("index", F.col("place") - F.col("less")).drop("task", "place", "less")


def sums(rows: DataFrame) -> list[int]:
    """Exact sums of every dimension."""
    entries = rows.select(F.posexplode("x").alias("at", "value"))
    found = entries.groupBy("at").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("total")).collect()
    return [int(row["total"]) for row in sorted(found)]


def block_matrix(rows: DataFrame, span: int, width: int) -> BlockMatrix:
    """Rows (index below ``span``, entries) in blocks."""
    vectors = rows.select("index", array_to_vector("entries").alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), span, width)
    return matrix.toBlockMatrix(max(1, BLOCK_BYTES // (8 * width)), min(width, BLOCK_COLUMNS))


def covariance(rows: DataFrame, span: int, count: int, width: int) -> tuple[BlockMatrix, np.ndarray]:
    """The centred rows (index, entries) as a block matrix, and their covariance with divisor ``count``."""
    matrix = block_matrix(rows, span, width)
    model = lambda blocks: blocks._java_matrix_wrapper._java_model
    # Python's multiply has no split of the middle dimension, the public Scala method has.
    product = model(matrix.transpose()).multiply(model(matrix), -(-span // matrix.rowsPerBlock))
    scatter = BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()
    return matrix, (scatter + scatter.T) / (2 * count)


def projected(matrix: BlockMatrix, weights: np.ndarray) -> DataFrame:
    """index and ``entries`` of the rows times ``weights``."""
    session = matrix.blocks.ctx
    step, width = matrix.colsPerBlock, weights.shape[1]
    pieces = [((i // step, 0), weights[i : i + step]) for i in range(0, len(weights), step)]
    blocks = session.parallelize([(at, Matrices.dense(*piece.shape, piece.ravel(order="F"))) for at, piece in pieces], 1)
    product = matrix.multiply(BlockMatrix(blocks, step, width, *weights.shape))
    rows = callMLlibFunc("getIndexedRows", product.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("entries"))


def centred(rows: DataFrame, total: list[int], count: int) -> DataFrame:
    """Rows with ``entries`` (centred) and ``deviation``."""
    whole = F.lit([t // count for t in total]).cast("array<long>")
    rest = F.lit([t % count for t in total]).cast("array<long>")
    share = F.lit([(t % count) / count for t in total]).cast("array<double>")
    near = rows.withColumn("near", F.zip_with("x", whole, lambda a, b: a - b))
    apart = F.zip_with("near", rest, lambda a, b: F.try_subtract(F.try_multiply(F.lit(count).cast("long"), a), b))
    deviation = F.aggregate(apart, F.lit(0).cast("long"), lambda found, t: F.try_add(found, F.try_multiply(t, t)))
    entries = F.zip_with("near", share, lambda a, b: a.cast("double") - b)
    return near.select("index", "vec_id", deviation.alias("deviation"), entries.alias("entries"))


def whitened_rows(rows: DataFrame, width: int) -> DataFrame:
    """The result for the rows of one dimension (columns of whole_numbers)."""
    rows = tabled(indexed(rows), "whitening")
    (count, last), total = rows.agg(F.count("*"), F.max("index")).first(), sums(rows)
    span = last + 1
    fit = centred(rows, total, count)
    matrix, cov = covariance(fit.select("index", "entries"), span, count, width)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(cov))
    shown = min(COMPONENTS, width)
    usable = int((values[:shown] > NO_VARIANCE * trace).sum())
    explained = [float(v / trace) if i < usable else 0.0 for i, v in enumerate(values[:shown])]
    error, named = 0.0, fit.select("index", "vec_id", "deviation")
    if usable:
        scores = tabled(projected(matrix, vectors[:, :usable] / np.sqrt(values[:usable])), "whitened")
        entry = scores.select(F.posexplode("entries").alias("at", "value")).groupBy("at").agg(F.avg("value").alias("mean"))
        means = F.lit([float(row["mean"]) for row in sorted(entry.collect())]).cast("array<double>")
        again = scores.select("index", F.zip_with("entries", means, lambda a, b: a - b).alias("entries"))
        error = float(np.abs(covariance(again, span, count, usable)[1] - np.eye(usable)).max())
        named = named.join(scores, "index")
    else:
        named = named.withColumn("entries", F.array().cast("array<double>"))
    missing = F.array_repeat(F.lit(None).cast("double"), shown - usable)
    spread = named.select("vec_id", "deviation", F.posexplode(F.concat("entries", missing)).alias("at", "whitened"))
    return spread.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(count).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.lit(explained).cast("array<double>"), F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def whitened(embeddings: DataFrame) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row."""
    rows = tabled(whole_numbers(embeddings), "vectors")
    found = embeddings.sparkSession.createDataFrame([], RESULT)
    # Tables have one dimension, seldom a few: each is a fit of its own.
    for width, in sorted(rows.select("dim").distinct().collect()):
        found = found.union(whitened_rows(rows.where(F.col("dim") == width).drop("dim"), width))
    return found
