"""Vectors as short codes: each part of a vector is replaced by the nearest entry of a codebook.

Everything is computed in whole numbers, so codes, errors and codebooks are the same whatever the number
of tasks, the order of rows or the library behind the matrix product.

1. Components become floor(scale * x). A vector is cut into equal consecutive parts, one codebook each;
   the first codebooks are the parts of the vectors with the smallest ids.
2. Squared distances to all entries come from |p|^2 - 2 p.e + |e|^2, and the products from matrix
   multiplication in double precision. Integers are split into limbs of so few bits that no sum of
   products passes 2^53, where doubles stop being exact; the products of limbs are put together again
   as 64-bit integers. The first smallest distance wins.
3. In a round every task adds up its vectors per entry and returns one row per entry it used. Spark sums
   these, and the new entries, floor(sum / count), come to the driver: 256 times the vector's length
   numbers at any size of the input. Entries without vectors stay.
4. After the rounds all vectors are coded with the last codebooks.

The vectors are written once as whole numbers; each round reads them once and shuffles a fixed number
of rows per task. A vector that a third of all rows repeat is work like any other.

Defined cases: rows whose vector is null, empty or holds null or non-finite components are dropped, as
are vectors of another length than most have, and those so large that a squared distance might pass
2^62; a length that the parts do not divide is filled up with zeros; rows with equal ids start in the
order of their vectors, rows without an id come last; fewer rows than entries make smaller codebooks;
equal labels, nulls among them, are summed together; a sum that no long holds is null; an empty table
gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import joined, merged
from tallyloom.llm.vectors import whole_vectors, width, within
from tallyloom.session import as_table

BATCH = 1 << 20  # bytes of vectors that are multiplied at once
EXACT = 53  # bits up to which doubles hold every integer


@dataclass(frozen=True)
class Codec:
    """Codebooks as whole numbers, one (entries x width) array per part; ``size`` is the vectors' length."""

    books: tuple[np.ndarray, ...]
    size: int

    def text(self) -> str:
        """All entries' components by part, entry and position, joined by commas; zeros that fill up a
        part beyond the vector's end are left out."""
        step, out = self.books[0].shape[1] if self.books else 0, []
        for part, book in enumerate(self.books):
            real = max(0, min(step, self.size - part * step))
            out += [str(int(v)) for v in book[:, :real].reshape(-1)]
        return ",".join(out)

    def digest(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Doubles of at most 2**bits that, weighted by 2**(bits * i), add up to the integers."""
    parts = []
    while values.size and np.abs(values).max() > 1 << bits:
        parts.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits
    return [*parts, values.astype(np.float64)]


def dot_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T of 64-bit integers, exact wherever the result fits 63 bits."""
    bits = (EXACT - max(left.shape[1] - 1, 0).bit_length()) // 2
    total = np.zeros((len(left), len(right)), np.int64)
    mine, theirs = limbs(left, bits), limbs(right, bits)
    for i, a in enumerate(mine):
        for j, b in enumerate(theirs):
            if bits * (i + j) < 64:  # higher ones vanish modulo 2^64
                total += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return total


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry of each point, the first one on ties."""
    gaps = (points * points).sum(axis=1)[:, None] - 2 * dot_products(points, book) + (book * book).sum(axis=1)
    best = gaps.argmin(axis=1)
    return best, gaps[np.arange(len(points)), best]


def cut(vectors: np.ndarray, parts: int) -> np.ndarray:
    """(part, row, position) of (row, component), filled up with zeros to equal parts."""
    rows, size = vectors.shape
    step = -(-size // parts)
    filled = np.zeros((rows, step * parts), np.int64)
    filled[:, :size] = vectors
    return filled.reshape(rows, parts, step).transpose(1, 0, 2)


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), size)


def _sums(rows: DataFrame, codec: Codec) -> DataFrame:
    """(part, entry, n, total): of each entry in use, how many vectors chose it and their sum."""
    parts, step = len(codec.books), codec.books[0].shape[1]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, len(codec.books[0])), np.int64)
        totals = np.zeros((*counts.shape, step), np.int64)
        for batch in merged(batches, BATCH):
            for part, points in enumerate(cut(_matrix(batch.column(0), codec.size), parts)):
                chosen = nearest(points, codec.books[part])[0]
                order = np.argsort(chosen, kind="stable")
                used, begins = np.unique(chosen[order], return_index=True)
                totals[part, used] += np.add.reduceat(points[order], begins, axis=0)
                counts[part] += np.bincount(chosen, minlength=counts.shape[1])
        part, entry = np.nonzero(counts)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(totals[part, entry].reshape(-1)), step)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(counts[part, entry]), lists.cast(pa.list_(pa.int64()))],
            names=["part", "entry", "n", "total"])

    found = rows.select("x").mapInArrow(add_up, "part long, entry long, n long, total array<long>")
    return found.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(step)]).alias("total"))


def fit(rows: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> Codec:
    """Codebooks after ``rounds`` rounds over all rows (vec_id, x)."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry is coded in two hex digits: 1 to 256 entries")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    if not first:
        return Codec((), 0)
    start = np.array([r["x"] for r in first], np.int64)
    codec = Codec(tuple(cut(start, parts)), start.shape[1])
    for _ in range(rounds):
        books = [book.copy() for book in codec.books]
        for r in _sums(rows, codec).collect():
            books[r["part"]][r["entry"]] = np.array(r["total"], np.int64) // r["n"]
        codec = Codec(tuple(books), codec.size)
    return codec


def encode(rows: DataFrame, codec: Codec, keep: list[str]) -> DataFrame:
    """``keep``, code (two hex digits a part) and error (squared distance over all parts) of all rows."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in merged(batches, BATCH):
            pieces = cut(_matrix(batch.column(batch.num_columns - 1), codec.size), len(codec.books))
            found = [nearest(points, book) for points, book in zip(pieces, codec.books)]
            codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            errors = sum(gap for _, gap in found)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([row.tobytes().hex() for row in codes]), pa.array(errors)],
                names=[*keep, "code", "error"])

    read = rows.select(*keep, "x")
    schema = T.StructType([*read.schema.fields[:-1], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])
    if not codec.books:
        return read.sparkSession.createDataFrame([], schema)
    return read.mapInArrow(work, schema)


def decode(coded: DataFrame, codec: Codec, keep: list[str]) -> DataFrame:
    """``keep`` and x: the codebook entries that each code stands for."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index = np.array([list(bytes.fromhex(c)) for c in batch.column(batch.num_columns - 1).to_pylist()],
                             np.int64).reshape(batch.num_rows, len(codec.books))
            back = np.concatenate([book[index[:, i]] for i, book in enumerate(codec.books)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(list(back[:, :codec.size]), pa.list_(pa.int64()))],
                names=[*keep, "x"])

    read = coded.where(F.col("code").isNotNull()).select(*keep, "code")
    schema = T.StructType([*read.schema.fields[:-1], T.StructField("x", T.ArrayType(T.LongType()))])
    if not codec.books:
        return read.sparkSession.createDataFrame([], schema)
    return read.mapInArrow(work, schema)


def vectors_of(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, label, x) of the rows that can be coded."""
    rows = whole_vectors(vectors, scale, ["vec_id", "label"])
    return rows.where(within(F.col("x"), isqrt((1 << 62) // max(width(rows), 1)) // 2))


def compress(vectors: DataFrame, scale: int = 1024, parts: int = 4, entries: int = 256,
             rounds: int = 4) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of every row that can be coded."""
    rows = vectors_of(vectors, scale)
    codec = fit(rows, parts, entries, rounds)
    coded = as_table(encode(rows, codec, ["vec_id", "label"]), "vector-codes")
    by_label = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    return joined(coded, by_label, ["label"]).withColumn("codebooks_sha256", F.lit(codec.digest()))
