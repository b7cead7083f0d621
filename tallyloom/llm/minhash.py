"""Near-duplicate documents by MinHash, confirmed on whole shingle sets.

1. Every text gets its set of word shingles, reduced to MINIMA minima of universal hashes. Rows with
   the same set are one node: thousands of copies cost one row from here on.
2. BANDS bands of ROWS minima each give a node its bucket keys. At a similarity of 0.8 a pair shares
   no bucket with a probability of (1 - 0.8^6)^48, about 5e-7.
3. Buckets are not paired off. In each, all nodes are compared with one centre, the node with the
   largest buckets of all, which in a group of copies is the original. Nodes that are in one component
   after that need no comparison any more: what is left, pairs of nodes of different components in one
   bucket, is compared in full, so no link between components is lost.
4. A pair is a candidate only if the set sizes allow it and the signatures agree: one bit of each of
   SKETCH minima, within six standard deviations of what the threshold makes. Both are conditions of the
   joins that look for pairs. Candidates are confirmed on the full sets.
   Hundreds of copies of one original can all be too far from it and from each other. So the comparison
   with the centre also leaves each node the elements in which it differs from the centre, as their
   number and a bitmap of their hashes. Two nodes differ in all bits that only one of them has, at
   least: a bound that loses no link and rules out nearly all such pairs in the join.
5. Components of the confirmed links by alternating large-star and small-star.

Defined cases: a text without words, empty or null, has no shingles and is linked with nothing; with
fewer words than a shingle the whole sequence is its one shingle; a null id is never the smallest of
its component, and a component of null ids only has a null id; repeated rows are copies of each
other; an empty table gives an empty result. Columns beside those asked for are not read, and the
operator's own carry a prefix, so names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import bytes_of, filled, joined, slices
from tallyloom.llm.components import components
from tallyloom.llm.textstats import SPACE
from tallyloom.session import as_table

BANDS, ROWS = 48, 6
MINIMA = BANDS * ROWS
SKETCH = 256  # minima that give a bit each
DELTA_WORDS = 8  # of 64 bits each, in the bitmap of a difference
OWN = "_near_"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of the universal hashes, from a fixed seed."""
    draw = np.random.default_rng(20240607)
    high = np.iinfo(np.uint64).max
    return (draw.integers(0, high, MINIMA, np.uint64) | np.uint64(1),
            draw.integers(0, high, MINIMA, np.uint64))


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, lower-cased in A-Z, and the number of its text."""
    inside = ~SPACE[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[at] = True
    before = np.concatenate(([False], inside[:-1])) & ~breaks[:-1]
    first = np.flatnonzero(inside & ~before)
    upto = np.concatenate(([0], np.cumsum(inside)))
    ends = np.concatenate((upto[first], upto[-1:])).astype(np.int32)
    kept = _LOWER[data[inside]]
    words = pa.Array.from_buffers(
        pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(kept)])
    coded = words.dictionary_encode()
    hashed = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()),
                         np.uint64, len(coded.dictionary))
    owner = np.searchsorted(at, first, side="right") - 1
    return hashed[coded.indices.to_numpy(zero_copy_only=False)], owner


def shingle_sets(texts: pa.LargeStringArray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, text by text, each sorted; where each text's begin."""
    data, at = bytes_of(texts)
    hashes, owner = word_hashes(data, at)
    per_text = np.bincount(owner, minlength=len(texts))
    begin = np.concatenate(([0], np.cumsum(per_text)))
    span = np.minimum(np.maximum(per_text, 1), words)  # shorter texts: the whole sequence
    number = np.where(per_text > 0, per_text - span + 1, 0)
    edge = np.concatenate(([0], np.cumsum(number)))
    start = np.arange(edge[-1]) + np.repeat(begin[:-1] - edge[:-1], number)
    length = np.repeat(span, number)
    mixed = _scrambled(length.astype(np.uint64))
    for k in range(words):
        use = length > k
        step = hashes[np.minimum(start + k, max(len(hashes) - 1, 0))] if len(hashes) else mixed
        mixed = np.where(use, _scrambled((mixed + _MIX) ^ step), mixed)
    for low, high in zip(edge[:-1], edge[1:]):
        mixed[low:high].sort()
    fresh = np.ones(len(mixed), bool)
    fresh[1:] = mixed[1:] != mixed[:-1]
    fresh[edge[:-1][number > 0]] = True
    kept = np.concatenate(([0], np.cumsum(fresh)))
    return mixed[fresh], kept[edge]


def minima(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The MINIMA minima, one row per non-empty set."""
    full = at[:-1][at[1:] > at[:-1]]
    out = np.empty((len(full), MINIMA), np.uint64)
    if len(full):
        factors, offsets = _multipliers()
        hashed = np.empty_like(sets)
        for i in range(MINIMA):
            np.multiply(sets, factors[i], out=hashed)
            np.add(hashed, offsets[i], out=hashed)
            out[:, i] = np.minimum.reduceat(hashed, full)
    return out


def bucket_keys(least: np.ndarray) -> np.ndarray:
    """A key for each band of each row; bands have keys of their own."""
    keys = np.empty((len(least), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(least), band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = _scrambled((key + _MIX) ^ least[:, k])
        keys[:, band] = key
    return keys.view(np.int64)


def sketches(least: np.ndarray) -> np.ndarray:
    """A middle bit of the first SKETCH minima, packed into 64-bit numbers. (The highest are nearly all zero.)"""
    bits = ((least[:, :SKETCH] >> np.uint64(24)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.int64)


def with_signatures(docs: DataFrame, keep: list[str], words: int) -> DataFrame:
    """``keep``, the text, and with the prefix OWN: n, the set's digest, its bucket keys and its sketch.

    For an empty set the last three are null.
    """
    fields = [OWN + c for c in ("text", "n", "set", "keys", "sketch")]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = filled(batch.column(batch.num_columns - 1))
            for low, high in slices(texts):
                sets, at = shingle_sets(texts.slice(low, high - low), words)
                sizes = np.diff(at)
                digests = [hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() if b > a else None
                           for a, b in zip(at[:-1], at[1:])]
                least = minima(sets, at)
                empty = sizes == 0
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(low, high - low) for i in range(batch.num_columns)),
                     pa.array(sizes.astype(np.int64)), pa.array(digests, pa.binary()),
                     _rows(bucket_keys(least), empty), _rows(sketches(least), empty)], names=[*keep, *fields])

    read = docs.select(*keep, docs["text"].alias(OWN + "text"))
    numbers = T.ArrayType(T.LongType())
    return read.mapInArrow(sign, T.StructType([
        *read.schema.fields, T.StructField(fields[1], T.LongType()), T.StructField(fields[2], T.BinaryType()),
        T.StructField(fields[3], numbers), T.StructField(fields[4], numbers)]))


def _rows(values: np.ndarray, empty: np.ndarray) -> pa.ListArray:
    """A list per text: the next row of values, or null for an empty set."""
    ends = np.concatenate(([0], np.cumsum(~empty))) * values.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.reshape(-1)))
    return pc.if_else(pa.array(empty), pa.scalar(None, lists.type), lists)


@dataclass(frozen=True)
class Threshold:
    """Linked are sets with ``over * intersection >= share * union``."""

    share: int = 80
    over: int = 100

    @property
    def most_bits(self) -> float:
        """Sketch bits in which a linked pair differs at most, by six standard deviations."""
        differs = (1 - self.share / self.over) / 2
        return SKETCH * differs + 6 * (SKETCH * differs * (1 - differs)) ** 0.5

    def candidates(self, a: str, b: str) -> Column:
        """Whether the sizes and sketches of two structs (n, sketch) allow a link."""
        sizes = self.over * F.least(a + ".n", b + ".n") >= self.share * F.greatest(a + ".n", b + ".n")
        bits = [F.bit_count(F.col(a + ".sketch")[i].bitwiseXOR(F.col(b + ".sketch")[i])) for i in range(SKETCH // 64)]
        return sizes & (sum(bits[1:], bits[0]) <= F.lit(self.most_bits))


def _sets_of(nodes: DataFrame, words: int) -> DataFrame:
    """(node, set) from (node, text): the full shingle set as an array."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = filled(batch.column(1))
            for low, high in slices(texts):
                sets, at = shingle_sets(texts.slice(low, high - low), words)
                arrays = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), arrays], names=["node", "set"])

    return nodes.mapInArrow(expand, "node long, set array<long>")


class Groups:
    """Near-duplicate groups of one table; ``rows`` holds what was kept of it, with OWN columns."""

    def __init__(self, docs: DataFrame, keep: list[str], words: int, threshold: Threshold, order: str):
        self.words, self.threshold = words, threshold
        tagged = with_signatures(docs, keep, words).withColumn(
            OWN + "row", F.monotonically_increasing_id())
        # Written once: row numbers, texts and signatures are the same for all that follows.
        self.rows = as_table(tagged, "near-rows")
        # Keys and sketch are equal for equal sets, so the first will do.
        self.nodes = as_table(
            self.rows.where(F.col(OWN + "n") > 0).groupBy(OWN + "set").agg(
                F.min(OWN + "row").alias("node"),
                F.min(F.struct(F.col(order).isNull().alias("missing"), F.col(order).alias("id"),
                               F.col(OWN + "row").alias("row"))).alias("first"),
                F.first(OWN + "n").alias("n"), F.first(OWN + "keys").alias("keys"),
                F.first(OWN + "sketch").alias("sketch")), "near-nodes")

    def _members(self) -> DataFrame:
        """(key, node, info) of all buckets that hold two nodes or more; info has weight, node, n, sketch."""
        every = self.nodes.select("node", F.explode("keys").alias("key"))
        shared = every.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        found = as_table(joined(every, shared, ["key"]), "near-buckets")
        weights = found.groupBy("node").agg(F.sum("size").alias("weight"))
        info = weights.join(self.nodes.select("node", "n", "sketch"), "node").select(
            "node", F.struct("weight", "node", "n", "sketch").alias("info"))
        return as_table(joined(found.select("key", "node"), info, ["node"]), "near-members")

    def _sets(self, members: DataFrame) -> DataFrame:
        """(node, set) of the nodes that share a bucket, from the text of the row that stands for each."""
        # By shuffle at every size, as the ids grow with the table: a broadcast of few of them would only make
        # small runs say nothing about large ones.
        wanted = members.select(F.col("node").alias(OWN + "row")).distinct().hint("merge")
        texts = self.rows.select(OWN + "row", OWN + "text").join(wanted, OWN + "row", "left_semi")
        return as_table(_sets_of(texts, self.words), "near-sets")

    def _linked(self, both: Column) -> Column:
        share, over = self.threshold.share, self.threshold.over
        return over * both >= share * (F.size("set_a") + F.size("set_b") - both)

    def _confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (a, b) that are linked, out of candidates."""
        both = F.size(F.array_intersect("set_a", "set_b"))
        linked = (pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
                  .where(self._linked(both)))
        return as_table(linked.select("a", "b"), "near-links")

    def _around_centres(self, members: DataFrame, centres: DataFrame, sets: DataFrame) -> DataFrame:
        """(centre, node, linked, differs, bits) of all candidate pairs of a bucket's centre and its nodes.

        ``differs`` elements are in one of the two sets only, and ``bits`` are those of their hashes.
        """
        met = joined(members, centres, ["key"]).where(
            (F.col("node") != F.col("centre.node")) & self.threshold.candidates("info", "centre"))
        pairs = met.select(F.col("centre.node").alias("centre"), "node").distinct()
        full = pairs.join(sets.toDF("node", "set_a"), "node").join(sets.toDF("centre", "set_b"), "centre")
        apart = full.withColumn("apart", F.concat(F.array_except("set_a", "set_b"), F.array_except("set_b", "set_a")))
        word = ("aggregate(filter(apart, e -> ((e >> 6) & {mask}) = {w}), 0L,"
                " (bits, e) -> bits | shiftleft(1L, int(e & 63)))")
        bits = F.array(*[F.expr(word.format(mask=DELTA_WORDS - 1, w=w)) for w in range(DELTA_WORDS)])
        both = (F.size("set_a") + F.size("set_b") - F.size("apart")) / 2
        return as_table(apart.select("centre", "node", self._linked(both).alias("linked"),
                                     F.size("apart").alias("differs"), bits.alias("bits")), "near-deltas")

    def _fits(self) -> Column:
        """Condition of the join within a bucket, cheapest part first.

        All it reads are plain numbers of the two sides (a_ and b_), as it is evaluated for every pair of a
        bucket's rest. What the differences from the centre allow counts as true where one is not known.
        """
        share, over = self.threshold.share, self.threshold.over

        def bits(words: int, term) -> Column:
            each = [F.bit_count(term(i)) for i in range(words)]
            return sum(each[1:], each[0])

        def only(x: str, y: str) -> Column:
            return bits(DELTA_WORDS, lambda i: F.col(f"{x}_bits{i}").bitwiseAND(F.bitwise_not(F.col(f"{y}_bits{i}"))))

        n_a, n_b = F.col("a_n"), F.col("b_n")
        sizes = over * F.least(n_a, n_b) >= share * F.greatest(n_a, n_b)
        common = F.least(F.col("a_differs") - only("a", "b"), F.col("b_differs") - only("b", "a"))
        least = F.col("a_differs") + F.col("b_differs") - 2 * common
        near = (over + share) * least <= (over - share) * (n_a + n_b)
        agree = bits(SKETCH // 64, lambda i: F.col(f"a_sketch{i}").bitwiseXOR(F.col(f"b_sketch{i}")))
        unknown = F.col("a_differs").isNull() | F.col("b_differs").isNull()
        return sizes & (agree <= F.lit(self.threshold.most_bits)) & (unknown | near)

    def _across(self, members: DataFrame, centres: DataFrame, deltas: DataFrame) -> DataFrame:
        """Candidate pairs of nodes that share a bucket and are in different components.

        The largest component of a bucket meets the rest of it, and the rest meets itself.
        """
        links = deltas.where("linked").select(F.col("centre").alias("a"), F.col("node").alias("b"))
        labelled = as_table(joined(members, components(links), ["node"], "left").withColumn(
            "comp", F.coalesce("root", "node")).drop("root"), "near-labelled")
        largest = (labelled.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key")
                   .agg(F.max(F.struct("n", "comp")).alias("top"), F.count("*").alias("comps"))
                   .where("comps > 1").select("key", F.col("top.comp").alias("top")))
        known = largest.join(centres.select("key", F.col("centre.node").alias("centre")), "key")
        zero = F.array(*[F.lit(0).cast("long")] * DELTA_WORDS)
        differences = deltas.select("centre", "node", F.struct("differs", "bits").alias("delta"))
        itself = F.when(F.col("node") == F.col("centre"), F.struct(F.lit(0).alias("differs"), zero.alias("bits")))
        open_ = joined(joined(labelled, known, ["key"]), differences, ["centre", "node"], "left")
        delta = F.coalesce(itself, "delta")
        numbers = [F.col("info.n").alias("n"), delta["differs"].alias("differs"),
                   *[F.col("info.sketch")[i].alias(f"sketch{i}") for i in range(SKETCH // 64)],
                   *[delta["bits"][i].alias(f"bits{i}") for i in range(DELTA_WORDS)]]
        open_ = as_table(open_.select("key", "comp", "node", (F.col("comp") != F.col("top")).alias("rest"), *numbers),
                         "near-open")
        left = open_.where("rest").select("key", *[F.col(c).alias("a_" + c) for c in open_.columns if c != "key"])
        right = open_.select("key", *[F.col(c).alias("b_" + c) for c in open_.columns if c != "key"])
        met = ((left["key"] == right["key"]) & (F.col("a_comp") != F.col("b_comp"))
               & (~F.col("b_rest") | (F.col("a_node") < F.col("b_node"))) & self._fits())
        return left.join(right, met).select(
            F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()

    def roots(self) -> DataFrame:
        """(node, root) of all nodes that are linked with another."""
        members = self._members()
        sets = self._sets(members)
        centres = as_table(members.groupBy("key").agg(F.max("info").alias("centre")), "near-centres")
        deltas = self._around_centres(members, centres, sets)
        first = deltas.where("linked").select(F.col("centre").alias("a"), F.col("node").alias("b"))
        return components(first.union(self._confirmed(self._across(members, centres, deltas), sets)))

    def labelled(self) -> DataFrame:
        """The rows with ``first`` of their component: its smallest id and the row that has it."""
        roots = self.nodes.join(self.roots(), "node", "left").withColumn("root", F.coalesce("root", "node"))
        firsts = roots.groupBy("root").agg(F.min("first").alias("component"))
        known = joined(roots.select(OWN + "set", "root"), firsts, ["root"]).select(OWN + "set", "component")
        full = joined(self.rows.where(F.col(OWN + "n") > 0), known, [OWN + "set"])
        return full

    def alone(self) -> DataFrame:
        """The rows without any shingle."""
        return self.rows.where(F.col(OWN + "n") == 0)


def group(docs: DataFrame, words: int = 5, threshold: Threshold = Threshold()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    ids = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    groups = Groups(ids, ["doc_id"], words, threshold, "doc_id")
    full = groups.labelled().select(
        "doc_id", F.col(OWN + "n").alias("n_shingles"), F.col("component.id").alias("component_id"))
    empty = groups.alone().select("doc_id", F.lit(0).cast("long").alias("n_shingles"),
                                  F.col("doc_id").alias("component_id"))
    return full.union(empty).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def drop_near_duplicates(docs: DataFrame, words: int = 5, threshold: Threshold = Threshold()) -> DataFrame:
    """One row of each group, the one with the smallest id; all rows without words stay."""
    others = [c for c in docs.columns if c != "text"]
    groups = Groups(docs, others, words, threshold, "doc_id")
    chosen = groups.labelled().where(F.col("component.row") == F.col(OWN + "row"))
    return chosen.select(*others, OWN + "text").union(
        groups.alone().select(*others, OWN + "text")).withColumnRenamed(OWN + "text", "text").select(*docs.columns)
