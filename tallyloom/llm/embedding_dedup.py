"""Near-duplicate embeddings: an exact metric range join.

1. Equal vectors of a label are one node with a number of copies; from here on a vector that holds a third
   of all rows costs one row.
2. Unit vectors are points at chord distances, a metric; a cosine of at least c is a distance of at
   most r = sqrt(2 - 2c). Every node is at home in the cell of its nearest pivot (of its label).
3. Two nodes within r can be in different cells. By the triangle inequality, a node can be within r of one
   that is at home in cell p only if its distance to p is at most its distance to its own pivot plus 2r,
   and at most the radius of that cell plus r. It is copied to such cells as a visitor.
4. Cells are independent. A home node meets all nodes of its cell, so it sees every link it has, once. Large
   cells are cut into chunks of homes and chunks of nodes, and each pair of chunks is one group of
   bounded size: a matrix product in single precision, and double precision wherever that is near
   the threshold.
5. A group reports the number of links of each home and a spanning forest of its links, not its
   pairs. Components come from the forests by large-star and small-star.

The pivots are the nodes with the smallest hashes, MOST_PIVOTS at most. They decide what is compared
where, never what is found. On vectors without clusters the boundary of a cell is everything, and the join
compares all nodes of a label; the chunks keep that within memory.

Defined cases: null, empty or zero vectors and those with null or non-finite components are linked with
nothing, nor are vectors with a null label; vectors of different length are not compared; a null id is
never the smallest of its component and never kept; repeated rows are copies of each other; an empty
table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import joined
from tallyloom.llm.components import components
from tallyloom.session import as_table

MOST_PIVOTS = 64
CELL = 2048  # nodes that a cell should have: sets the number of pivots
CHUNK = 1024  # nodes of one side of a group
NEAR = 1e-4  # single precision is trusted this far from the threshold


@dataclass(frozen=True)
class Metric:
    cosine: float = 0.93

    @property
    def radius(self) -> float:
        return (2 - 2 * self.cosine) ** 0.5 + 1e-9


def usable(vector: Column) -> Column:
    """Whether a vector has a direction."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _by_size(lists: pa.Array) -> Iterator[np.ndarray]:
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * points @ pivots.T, 0))


def with_home(nodes: DataFrame, pivots: list[list[float]]) -> DataFrame:
    """(node, home, to_home) of all nodes; without a pivot of its length a node's home is cell 0."""
    by_size: dict[int, list[int]] = {}
    for i, p in enumerate(pivots):
        by_size.setdefault(len(p), []).append(i)
    units = {size: unit(np.array([pivots[i] for i in ids], float)) for size, ids in by_size.items()}

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pa.concat_arrays([batch.column(1)])
            home, far = np.zeros(len(lists), np.int64), np.zeros(len(lists))
            for rows in _by_size(lists):
                points = unit(_matrix(lists.take(pa.array(rows))))
                if points.shape[1] in units:
                    gaps = _distances(points, units[points.shape[1]])
                    best = gaps.argmin(axis=1)
                    home[rows] = np.array(by_size[points.shape[1]])[best]
                    far[rows] = gaps[np.arange(len(rows)), best]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(home), pa.array(far)], names=["node", "home", "to_home"])

    return nodes.select("node", "vector").mapInArrow(settle, "node long, home long, to_home double")


def with_cells(nodes: DataFrame, pivots: list[list[float]], radius: float) -> DataFrame:
    """(node, cell, gap): the cells a node can have links in, its home among them, by bisector bounds."""
    by_size: dict[int, list[int]] = {}
    for i, p in enumerate(pivots):
        by_size.setdefault(len(p), []).append(i)
    units = {size: unit(np.array([pivots[i] for i in ids], float)) for size, ids in by_size.items()}

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pa.concat_arrays([batch.column(1)])
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            out = []
            for rows in _by_size(lists):
                points = unit(_matrix(lists.take(pa.array(rows))))
                if points.shape[1] not in units:
                    out.append((ids[rows], np.zeros(len(rows), np.int64), np.zeros(len(rows))))
                    continue
                gaps = _distances(points, units[points.shape[1]])
                near = gaps <= gaps.min(axis=1, keepdims=True) + 2 * radius + 1e-9
                row, cell = np.nonzero(near)
                out.append((ids[rows][row], np.array(by_size[points.shape[1]])[cell], gaps[near]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in zip(*out)], names=["node", "cell", "gap"])

    return nodes.select("node", "vector").mapInArrow(reach, "node long, cell long, gap double")


def _roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``count`` nodes reaches over the pairs."""
    root = np.arange(count)
    while True:
        before = root.copy()
        least = np.minimum(root[left], root[right])
        np.minimum.at(root, left, least)
        np.minimum.at(root, right, least)
        np.minimum.at(root, before, root)
        root = root[root]
        if np.array_equal(root, before):
            return root


def _linked(homes: np.ndarray, others: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of homes, row of others) of unit vectors with at least that cosine."""
    rough = homes.astype(np.float32) @ others.astype(np.float32).T
    left, right = np.nonzero(rough >= cosine - NEAR)
    unsure = np.flatnonzero(rough[left, right] < cosine + NEAR)
    good = np.ones(len(left), bool)
    for low in range(0, len(unsure), 1 << 16):
        some = unsure[low:low + (1 << 16)]
        good[some] = np.einsum("ij,ij->i", homes[left[some]], others[right[some]]) >= cosine
    return left[good], right[good]


FOUND = "node long, other long, links long"


def _compare(cosine: float):
    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids = group.column("node").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        home = group.column("is_home").to_numpy(zero_copy_only=False)[order]
        copies = group.column("copies").to_numpy()[order]
        points = unit(_matrix(pa.concat_arrays(group.column("vector").chunks).take(pa.array(order))))
        mine, theirs = np.flatnonzero(home), np.flatnonzero(~home)
        left, right = _linked(points[mine], points[theirs], cosine)
        left, right = mine[left], theirs[right]
        other = ids[left] != ids[right]  # a home meets itself among the nodes of its cell
        left, right = left[other], right[other]
        links = np.bincount(left, weights=copies[right], minlength=len(ids)).astype(np.int64)
        root = _roots(len(ids), left, right)
        tied, seen = np.flatnonzero(ids[root] != ids), np.flatnonzero(links)
        return pa.table({
            "node": np.concatenate((ids[tied], ids[seen])),
            "other": pa.array(ids[root[tied]].tolist() + [None] * len(seen), pa.int64()),
            "links": pa.array([None] * len(tied) + links[seen].tolist(), pa.int64()),
        })
    return compare


def links_between(nodes: DataFrame, pivots: list[list[float]], metric: Metric) -> DataFrame:
    """FOUND rows of all groups: edges of spanning forests (node, other), and links of nodes (node, links)."""
    homes = as_table(nodes.drop("vector").join(with_home(nodes, pivots), "node"), "embedding-homes")
    # Per cell: its radius, and how many chunks its homes and all its nodes make.
    radii = homes.groupBy("label", "size", F.col("home").alias("cell")).agg(
        F.max("to_home").alias("radius"), F.ceil(F.count("*") / CHUNK).alias("home_chunks"))
    reach = with_cells(nodes, pivots, metric.radius).join(
        homes.select("node", "label", "size", "home"), "node")
    inside = as_table(joined(reach, radii, ["label", "size", "cell"])
                      .where(F.col("gap") <= F.col("radius") + metric.radius + 1e-9)
                      .drop("gap", "radius"), "embedding-cells")
    chunks = inside.groupBy("label", "size", "cell").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    dealt = joined(inside, chunks, ["label", "size", "cell"])
    spread = F.xxhash64("node")
    all_homes, all_others = (F.sequence(F.lit(0).cast("long"), F.col(c) - 1) for c in ("home_chunks", "chunks"))
    as_home = dealt.where("cell = home").select(
        "label", "size", "cell", "node", F.pmod(spread, F.col("home_chunks")).alias("i"),
        F.explode(all_others).alias("j"), F.lit(True).alias("is_home"))
    as_other = dealt.select(
        "label", "size", "cell", "node", F.explode(all_homes).alias("i"),
        F.pmod(spread, F.col("chunks")).alias("j"), F.lit(False).alias("is_home"))
    members = as_home.union(as_other).join(nodes.select("node", "vector", "copies"), "node")
    return members.groupBy("label", "size", "cell", "i", "j").applyInArrow(_compare(metric.cosine), FOUND)


def link(vectors: DataFrame, metric: Metric = Metric()) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding, label)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"), "label")
    good = F.col("label").isNotNull() & usable(F.col("vector"))
    nodes = as_table(
        rows.where(good).groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
        .withColumn("size", F.size("vector")).withColumn("node", F.monotonically_increasing_id()), "embedding-nodes")
    largest = nodes.groupBy("label", "size").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    wanted = min(MOST_PIVOTS, -(-largest // CELL))
    pivots = [] if wanted < 2 else [r["vector"] for r in nodes.orderBy(F.xxhash64("vector"), "node").limit(wanted).collect()]
    found = as_table(links_between(nodes.select("node", "label", "size", "vector", "copies"), pivots, metric),
                     "embedding-links")
    roots = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    counted = found.where("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    known = (nodes.select("node", "label", "vector", "first", "copies").join(roots, "node", "left")
             .join(counted, "node", "left").withColumn("root", F.coalesce("root", "node"))
             .withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1))
    firsts = known.groupBy("root").agg(F.min("first").alias("component_id"))
    whole = joined(known.select("label", "vector", "root", "n_links"), firsts, ["root"]).select(
        "label", "vector", "n_links", "component_id")
    linked = joined(rows.where(good), whole, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                     F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
