"""What several operators share: settings, id handling and slices of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import apply_plan_settings

# Rows that go to Python at once, and bytes of text that are worked on at once there. Both bound the
# memory of a task; neither changes a result.
ARROW_ROWS = 256
SLICE_BYTES = 2 << 20

# White space that separates words, and what a word is: the same everywhere.
WORD = r"[^\x20\x09-\x0D]+"


def session(spark: SparkSession) -> SparkSession:
    apply_plan_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the key and the seed only: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), key.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def filled(texts: pa.Array) -> pa.LargeStringArray:
    """Texts with nulls as empty texts, starting at offset 0 of their own buffer."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    return pa.concat_arrays([texts, pa.array([], pa.large_string())])


def slices(texts: pa.LargeStringArray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most so many bytes each; a longer text is a range of its own."""
    ends = offsets_of(texts)
    row = 0
    while row < len(texts):
        last = int(np.searchsorted(ends, ends[row] + most, side="right")) - 1
        last = min(max(last, row + 1), len(texts))
        yield row, last
        row = last


def merged(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches, each closed once it holds so many bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def offsets_of(texts: pa.Array) -> np.ndarray:
    at = np.frombuffer(texts.buffers()[1], np.int64)
    return at[texts.offset:texts.offset + len(texts) + 1]


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins and the last ends."""
    at = offsets_of(texts)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def joined(rows: DataFrame, per_key: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Rows joined with an aggregate per key, by hash and struct of the key.

    Neither is a plain column, so the join never reuses the partitioning of the aggregate: both sides
    come from an exchange of their own, which is the shape in which Spark splits a hot key.
    """
    other = per_key.select(F.xxhash64(*keys).alias("_join_hash"), F.struct(*keys).alias("_join_key"),
                           *[c for c in per_key.columns if c not in keys])
    on = (F.xxhash64(*[rows[k] for k in keys]) == F.col("_join_hash")) & (
        F.struct(*[rows[k] for k in keys]) == F.col("_join_key"))
    return rows.join(other, on, how).drop("_join_hash", "_join_key")
