"""Embeddings as vectors of whole numbers, which add and multiply exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import as_table


def finite(vector: Column) -> Column:
    """Whether a vector is there, has entries, and all of them are finite numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & good, F.lit(False))


def floored(vector: Column, scale: int) -> Column:
    """Each entry times ``scale``, rounded down, as longs; what no long holds becomes the nearest long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def whole_vectors(vectors: DataFrame, scale: int, keep: list[str], vector: str = "embedding") -> DataFrame:
    """A table of the columns ``keep`` and x, the scaled vector, of every row with a finite vector.

    Only vectors of the length that most rows have are kept; of equally frequent lengths the shortest.
    """
    read = vectors.where(finite(F.col(f"`{vector}`"))).select(
        *keep, floored(F.col(f"`{vector}`"), scale).alias("x"))
    table = as_table(read.withColumn("size", F.size("x")), "whole-vectors")
    usual = table.groupBy("size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").take(1)
    return table.where(F.col("size") == (usual[0]["size"] if usual else 0)).drop("size")


def within(vector: Column, most: int) -> Column:
    """Whether no entry is larger than ``most``, up or down."""
    return F.forall(vector, lambda x: (x <= most) & (x >= -most))


def width(rows: DataFrame) -> int:
    """The length of the vectors, which is the same for all rows; 0 for an empty table."""
    first = rows.select(F.size("x").alias("size")).take(1)
    return first[0]["size"] if first else 0
