"""Connected components by alternating large-star and small-star.

Edges stay a distributed table. A large-star links every larger neighbour of a node to its smallest
neighbour, a small-star links the smaller ones and the node itself. It ends when every node hangs on
one other that hangs on none: then that is the smallest of its component. Each round is written to the shared folder, so the plan
stays short and a lost executor costs one round at most. A hub's neighbours are never gathered: the
smallest one is an aggregate, and the join that hands it out can split a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import joined
from tallyloom.session import as_table


def _star(pairs: DataFrame) -> DataFrame:
    """For (node, other): the smallest of each node's others and itself, beside each other."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least")).withColumn(
        "least", F.least("least", "node"))
    return joined(pairs, least, ["node"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    return (_star(both).where("other > node")
            .select(F.col("other").alias("node"), F.col("least").alias("other")))


def _small_star(edges: DataFrame) -> DataFrame:
    near = _star(edges)
    return (near.select(F.col("other").alias("node"), F.col("least").alias("other"))
            .union(near.select("node", F.col("least").alias("other")))
            .where("node <> other"))


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other, which itself hangs on none."""
    ends = edges.select(F.col("node").alias("id"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        edges.select("other", F.lit(0), F.lit(1)))
    seen = ends.groupBy("id").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return seen.where("hangs > 1 or hangs = 1 and holds = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node it reaches.

    Self-links and repeated or reversed edges are allowed; edges with a null end are left out.
    """
    now = as_table(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct(), "components")
    while not _is_stars(now):
        large = _large_star(now).where("node <> other").distinct()
        now = as_table(_small_star(large).distinct(), "components")
    return now.select("node", F.col("other").alias("root")).union(
        now.select(F.col("other").alias("node"), F.col("other").alias("root")).distinct())
