"""Embeddings whitened: projected on the strongest directions of their covariance, each with variance one.

1. Entries become x = floor(scale * c), so sums and deviations are exact. Every distinct vector is fitted
   once: from here on a vector that a third of all rows repeat is one row.
2. The distinct vectors are numbered without a gap: per file partition by their place in it, and the
   partitions by the counts before them (one number per partition comes to the driver).
3. Centred rows x - S/n become an MLlib IndexedRowMatrix and from it a BlockMatrix A of blocks of bounded
   size. The scatter is A' A, with the long middle dimension dealt to tasks of a few blocks each; the
   result, as large as the vectors are long squared, is decomposed on the driver by eigh.
4. A times the whitening matrix, another BlockMatrix, projects the rows. Its blocks are read as rows, joined
   to the distinct vectors by number, and those to all rows by the vector itself.

What MLlib collects for a product is one pair of numbers per block (of 64 Ki entries).

Defined cases: rows whose vector is null, empty or holds null or non-finite entries are dropped, as are
vectors of another length than most have and those with an x beyond 2^31; repeated rows each get their
result; directions without variance (an eigenvalue of at most 1e-11 of the trace) have no whitened form and
are no components, so fewer than asked may come out, and none for a table of one distinct vector; a
deviation that no long holds is null; an empty table gives an empty result. Only the columns named are
read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import joined
from tallyloom.llm.vectors import whole_vectors, within
from tallyloom.session import as_table

MOST = 1 << 31  # largest x that takes part
ENTRIES = 1 << 16  # entries of a block
TOGETHER = 8  # blocks of each side that one task of the scatter multiplies
NO_VARIANCE = 1e-11
OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
       "identity_error double")


@dataclass(frozen=True)
class Fit:
    """n and S of the distinct vectors, eigenvalues and unit eigenvectors (columns) of their covariance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def means(self) -> list[float]:
        return [s / self.n for s in self.sums]

    @property
    def matrix(self) -> np.ndarray:
        """Projects a centred row on the components and gives each the variance one."""
        return self.vectors / np.sqrt(self.values)


def numbered(rows: DataFrame) -> DataFrame:
    """The distinct x of ``rows`` with a number from 0 on, as a table."""
    place = F.monotonically_increasing_id()  # the partition, then 33 bits for the place in it
    table = as_table(rows.select("x").distinct().select(
        "x", F.shiftright(place, 33).cast("int").alias("part"), place.bitwiseAND((1 << 33) - 1).alias("place")),
        "distinct-vectors")
    counts = sorted(table.groupBy("part").agg(F.count("*").alias("n")).collect())
    begins = [0, *accumulate(r["n"] for r in counts)]
    offsets = table.sparkSession.createDataFrame(
        [(r["part"], at) for r, at in zip(counts, begins)], "part int, begins long")
    # One row per partition of a table that Spark itself lists by partition.
    return table.join(F.broadcast(offsets), "part").select("x", (F.col("begins") + F.col("place")).alias("index"))


def centred(x: Column, means: list[float]) -> Column:
    return F.zip_with(x, F.lit(means), lambda v, m: v.cast("double") - m)


def deviation(x: Column, n: int, sums: tuple[int, ...], largest: int) -> Column:
    """Sum of (n * x - S)^2, exact; in decimals where longs might not hold it, null where none does."""
    if len(sums) * (2 * n * largest) ** 2 < 1 << 63:
        gaps = F.zip_with(x, F.lit(list(sums)), lambda v, s: v * F.lit(n) - s)
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g * g)
    wide = "decimal(38,0)"
    held = F.array(*[F.lit(str(s)).cast(wide) for s in sums])
    gaps = F.zip_with(x, held, lambda v, s: F.try_subtract(
        F.try_multiply(v.cast("decimal(19,0)"), F.lit(str(n)).cast("decimal(19,0)")).cast(wide), s))
    total = F.aggregate(gaps, F.lit("0").cast(wide), lambda held, g: F.try_add(held, F.try_multiply(g, g)).cast(wide))
    return total.try_cast("long")


def blocks_of(fitted: DataFrame, means: list[float]) -> BlockMatrix:
    """The centred rows as a matrix of blocks; entries, not rows, bound a block."""
    size = len(means)
    vectors = fitted.select("index", array_to_vector(centred(F.col("x"), means)).alias("row"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "row"))
    across = min(size, 1024)
    blocks = matrix.toBlockMatrix(max(1, ENTRIES // across), across)
    # Two products read each block several times; one that is lost with its executor is made again.
    return blocks.persist(StorageLevel.MEMORY_AND_DISK)


def _released(blocks: BlockMatrix) -> None:
    blocks._java_matrix_wrapper._java_model.blocks().unpersist(False)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """A' A: each task multiplies a few blocks of the long dimension and the products are added up."""
    down = -(-blocks.numRows() // blocks.rowsPerBlock)
    flipped = blocks.transpose()
    product = flipped._java_matrix_wrapper.call(
        "multiply", blocks._java_matrix_wrapper._java_model, max(1, -(-down // TOGETHER)))
    return BlockMatrix(product, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def fit(fitted: DataFrame, components: int = 4) -> tuple[Fit | None, BlockMatrix | None]:
    """The fit over the numbered distinct vectors and their blocks; none without any variance."""
    by_place = fitted.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.count("*").alias("n"), F.sum("v").alias("s")).orderBy("at").collect()
    if not by_place:
        return None, None
    n, sums = by_place[0]["n"], tuple(r["s"] for r in by_place)
    blocks = blocks_of(fitted, [s / n for s in sums])
    covariance = scatter(blocks) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors, trace = values[::-1], vectors[:, ::-1], float(np.trace(covariance))
    good = values[:components] > NO_VARIANCE * trace if trace > 0 else np.zeros(0, bool)
    if not good.any():
        _released(blocks)
        return None, None
    count = int(good.sum())
    return Fit(n, sums, values[:count].copy(), np.ascontiguousarray(vectors[:, :count]), trace), blocks


def projected(blocks: BlockMatrix, matrix: np.ndarray, spark) -> DataFrame:
    """(index, w): the rows of the block matrix times ``matrix``."""
    size, count = matrix.shape
    step, down = blocks.colsPerBlock, blocks.rowsPerBlock
    pieces = [((i, 0), DenseMatrix(len(part), count, part.reshape(-1, order="F").tolist()))
              for i, part in enumerate(matrix[low:low + step] for low in range(0, size, step))]
    factor = BlockMatrix(spark.sparkContext.parallelize(pieces, 1), step, count, size, count)

    def rows(block):
        (at, _), values = block
        return [(at * down + i, row) for i, row in enumerate(values.toArray().tolist())]

    return spark.createDataFrame(blocks.multiply(factor).blocks.flatMap(rows), "index long, w array<double>")


def identity_error(white: DataFrame, count: int) -> float:
    """Largest absolute entry of the covariance of w minus the identity."""
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    found = white.agg(*[F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(vectors: DataFrame, scale: int = 256, components: int = 4) -> DataFrame:
    """OUT: one row per row that takes part and component, strongest first."""
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, scale, ["vec_id"]).where(within(F.col("x"), MOST))
    fitted = numbered(rows)
    model, blocks = fit(fitted, components)
    if model is None:
        return spark.createDataFrame([], OUT)
    white = as_table(projected(blocks, model.matrix, spark), "whitened")
    _released(blocks)
    error = identity_error(white, len(model.values))
    largest = fitted.agg(F.max(F.greatest(F.array_max("x"), -F.array_min("x")))).first()[0]
    results = fitted.join(white, "index").select(
        "x", deviation(F.col("x"), model.n, model.sums, largest).alias("deviation"), "w")
    explained = F.lit([float(v) / model.trace for v in model.values])
    each = joined(rows, results, ["x"]).select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return each.select(
        F.col("vec_id").cast("long").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
