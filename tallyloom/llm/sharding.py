"""Sharding by extendible hashing.

The directory is indexed by leading bits of a hash of the key. A bucket that holds more bytes than a
shard may is split on its next bit, and only such buckets are, so shards are as large as the limit
allows and an append changes only the shards it fills.

The split is computed from sums: bytes are added up per cell of DEPTH bits (a few bits beyond the
expected number of shards), the sums of all shorter prefixes follow from those, and a shard is a
prefix that fits while its parent does not. Cells that still do not fit are taken up again with
further bits. When the 60 bits of the key's hash are used up, 60 bits of the row's content go on, so
a key that holds much of the data is split as well. Rows alike in key and content cannot be told apart
by any hash: there the copies are counted, and given out anew to as many shards as they need. So every
shard fits its limit, but for a single row that is larger itself.

Only sums, counts and flags reach the driver. The directory is a table of ``2 ** DEPTH`` rows, in
proportion to the number of shards; Spark broadcasts it only below its own threshold.

Defined cases: a null key is a key of its own; null and empty values count no bytes; ties do not
arise, as a prefix decides; repeated rows share a shard while they fit in one; an empty table gives
no shards. Columns of the input are kept, and own ones carry a prefix.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import joined
from tallyloom.session import as_table

OWN = "_shard_"
FOLDER = OWN + "folder"  # what the folders of written shards are named by
BITS = 60  # of each of the two hashes
EXTRA_BITS = 5  # of the first directory beyond the expected number of shards
STEP = 8  # bits of every further directory


def hash_bits(text: Column) -> Column:
    """60 bits of an MD5 digest as a number that is not negative."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _content(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _prefix(depth: int) -> Column:
    """The first bits of a row's two hashes, as text of zeros and ones."""
    bits = F.lpad(F.bin(OWN + "key"), BITS, "0")
    if depth > BITS:
        bits = F.concat(bits, F.lpad(F.bin(OWN + "content"), BITS, "0"))
    return F.substring(bits, 1, depth)


def _hashed(docs: DataFrame, key: str, size: Column) -> DataFrame:
    named = F.coalesce(docs[key].cast("string"), F.lit("null"))
    return (docs.withColumn(OWN + "bytes", F.coalesce(size.cast("long"), F.lit(0).cast("long")))
            .withColumn(OWN + "key", hash_bits(named))
            .withColumn(OWN + "content", hash_bits(_content(docs.columns))))


def _leaves(rows: DataFrame, low: int, high: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(prefix, bytes) of the shards between two depths, and the cells that need more bits.

    All prefixes at ``low`` are known to be too large, but for the empty one. Of the cells it is told
    whether all their rows have one key, or even one content.
    """
    key, content = F.col(OWN + "key"), F.col(OWN + "content")
    cells = as_table(rows.groupBy(_prefix(high).alias("cell")).agg(
        F.sum(OWN + "bytes").alias("bytes"), (F.min(key) == F.max(key)).alias("one_key"),
        (F.min(content) == F.max(content)).alias("one_content")), "shard-cells")
    depths = F.sequence(F.lit(low), F.lit(high))
    tree = (cells.select(F.explode(depths).alias("depth"), "cell", "bytes")
            .groupBy(F.expr("substring(cell, 1, depth)").alias("prefix")).agg(F.sum("bytes").alias("bytes")))
    full = tree.where(F.col("bytes") > limit).select(F.col("prefix").alias("parent"))
    fits = tree.where(F.col("bytes") <= limit)
    below = fits.withColumn("parent", F.expr("substring(prefix, 1, length(prefix) - 1)")).where("prefix <> ''")
    shards = below.join(full, "parent", "left_semi").select("prefix", "bytes")
    if low == 0:
        shards = shards.union(fits.where("prefix = ''").select("prefix", "bytes"))
    return shards, cells.where(F.col("bytes") > limit).drop("bytes")


def _directory(shards: DataFrame, high: int) -> DataFrame:
    """One entry per cell: all continuations of a shard's prefix to the depth of the directory."""
    rest = F.lit(high) - F.length("prefix")
    ends = F.expr("explode(sequence(0L, shiftleft(1L, rest) - 1))").alias("end")
    return (shards.select("prefix", "bytes", rest.alias("rest")).select("*", ends)
            .select(F.concat("prefix", F.when(F.col("rest") > 0, F.lpad(F.bin("end"), F.col("rest"), F.lit("0")))
                             .otherwise(F.lit(""))).alias("cell"),
                    F.col("prefix").alias(OWN + "id"), F.col("bytes").alias(OWN + "total")))


def assign(docs: DataFrame, key: str, size: Column, limit: int) -> DataFrame:
    """``docs`` with OWN bytes, id (the shard's prefix bits) and total (the shard's bytes).

    The plan is the join of the rows with the directories; nothing of the rows is moved for it while
    Spark can broadcast a directory.
    """
    if limit <= 0:
        raise ValueError("a shard needs a positive limit")
    rows = _hashed(docs, key, size)
    narrow = rows.select(OWN + "bytes", OWN + "key", OWN + "content")
    total = narrow.agg(F.sum(OWN + "bytes")).first()[0] or 0
    low, high = 0, min(BITS, max(0, math.ceil(math.log2(max(total / limit, 1)))) + EXTRA_BITS)
    done, open_rows, open_narrow = [], rows, narrow
    while True:
        shards, over = _leaves(open_narrow, low, high, limit)
        known = _directory(shards, high)
        placed = open_rows.withColumn(OWN + "cell", _prefix(high))
        done.append(joined(placed, known.withColumnRenamed("cell", OWN + "cell"), [OWN + "cell"]).drop(OWN + "cell"))
        one_key, one_content = over.agg(F.min("one_key"), F.min("one_content")).first()
        if one_key is None:
            break
        wanted = over.select(F.col("cell").alias(OWN + "cell"))
        open_rows = joined(placed, wanted, [OWN + "cell"], "left_semi").drop(OWN + "cell")
        if one_key and one_content:
            done.append(_copies(open_rows, docs.columns, limit))
            break
        open_narrow = as_table(open_rows.select(OWN + "bytes", OWN + "key", OWN + "content"), "shard-open")
        # Further bits of a key's hash are of no use where each cell holds one key.
        low, high = high, (BITS + STEP if one_key and high < BITS else
                           min(high + STEP, BITS if high < BITS else 2 * BITS))
    return reduce(DataFrame.union, [d.select(*docs.columns, OWN + "bytes", OWN + "id", OWN + "total") for d in done])


def _copies(rows: DataFrame, columns: list[str], limit: int) -> DataFrame:
    """Rows alike in everything, given out again: as many to each shard as fit, one at least."""
    counted = rows.withColumn(OWN + "cell", _prefix(2 * BITS)).groupBy(OWN + "cell").agg(
        F.min(F.struct(*columns)).alias("row"), F.min(OWN + "bytes").alias(OWN + "bytes"), F.count("*").alias("copies"))
    fit = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(limit) / F.greatest(F.col(OWN + "bytes"), F.lit(1))))
    each = counted.withColumn("fit", fit).withColumn(
        "copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    number = F.floor(F.col("copy") / F.col("fit"))
    held = F.least("fit", F.col("copies") - number * F.col("fit"))
    return each.select(*[F.col(f"row.`{c}`").alias(c) for c in columns], OWN + "bytes",
                       F.concat_ws("-", F.col(OWN + "cell"), number.cast("string")).alias(OWN + "id"),
                       (held * F.col(OWN + "bytes")).alias(OWN + "total"))


def write(assigned: DataFrame, path: str) -> None:
    """A folder ``_shard_folder=<id>`` per shard; the shard of all rows, without bits, is ``all``.

    The rebalance hint keeps a shard in one task unless it is larger than a task should be.
    """
    shard = F.when(F.col(OWN + "id") == "", "all").otherwise(F.col(OWN + "id"))
    (assigned.withColumn(FOLDER, shard).drop(OWN + "id").hint("rebalance", FOLDER)
     .write.partitionBy(FOLDER).parquet(path))


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``write`` wrote, with the columns of ``schema`` and OWN bytes, total and id.

    The ids are declared as text: inferred, they would lose leading zeros.
    """
    own = [T.StructField(OWN + "bytes", T.LongType()), T.StructField(OWN + "total", T.LongType()),
           T.StructField(FOLDER, T.StringType())]
    back = spark.read.schema(T.StructType([*schema.fields, *own])).parquet(path)
    return back.withColumn(OWN + "id", F.when(F.col(FOLDER) == "all", "").otherwise(F.col(FOLDER))).drop(FOLDER)


def oracle(limit: int) -> str:
    """The shards of the documents by doc_id: for each row the shortest prefix that fits.

    It leaves out documents above the limit and returns rows alike in id and size once; the query has
    both, and a brute-force test covers them.
    """
    return f"""WITH hashed AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes, lpad(bin(
        ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT), {BITS}, '0') AS bits FROM documents),
    spread AS (SELECT *, left(bits, depth::INT) AS prefix FROM hashed, range(0, 41) AS r(depth)),
    summed AS (SELECT *, sum(n_bytes) OVER (PARTITION BY prefix) AS total FROM spread),
    fitting AS (SELECT doc_id, n_bytes, min_by(prefix, depth) AS shard, min_by(total, depth) AS shard_bytes
        FROM summed WHERE total <= {limit} GROUP BY doc_id, n_bytes)
    SELECT doc_id, n_bytes, shard, length(shard) AS depth, shard_bytes::BIGINT AS shard_bytes FROM fitting"""
