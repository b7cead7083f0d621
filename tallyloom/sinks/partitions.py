"""Tables kept by partition, of which a save writes what changed and nothing else.

Every partition has a digest tree: rows are hashed, the hashes of each bucket of keys are folded to a
digest (count, sum, exclusive or), those of the buckets to one of the partition, and those of the
partitions to one of the table. Digests of parts add up to that of the whole, whatever the order of
rows. Two states are compared from the top: equal tables are done at once, equal partitions are
neither written nor read, and within a changed partition only the changed buckets are.

A save writes the changed partitions to a folder of its own and makes one commit that says which partitions
it replaces. Readers fold the commits: the newest folder of each partition. Until the commit is there a
save has changed nothing, and older folders stay for readers of older versions. Partition labels are
collected on the driver where folders are listed, as Spark lists them itself; rows never are.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.keyed import rows_with_key
from tallyloom.session import as_table
from tallyloom.sinks.commits import CommitLog, delete, exists, put_if_absent
from tallyloom.sinks.snapshot import ShrinkError
from tallyloom.sources.scan import empty

BUCKETS = 64
BUCKET = "_bucket"  # stored with the rows, sorted by, so that a filter on it skips row groups
ENTRY = ("at timestamp, operation string, info string, folder string, n_partitions bigint, n_rows bigint, "
         "rows bigint, hash_sum string, hash_xor bigint, columns string")
DIGEST = "rows bigint, hash_sum decimal(38,0), hash_xor bigint"
STATE = (f"label string, folder string, number bigint, {DIGEST}, "
         f"buckets array<struct<bucket: int, rows: bigint, hash_sum: decimal(38,0), hash_xor: bigint>>")
METHODS = ("new", "update", "skip", "remove")
LABEL = r"^[A-Za-z0-9_.\-]+$"


class ConflictError(RuntimeError):
    """Other savers kept changing the partitions of this save."""


def row_mark(columns: Sequence[str]) -> Column:
    """A hash of a row with a null flag per column; the order of the columns does not matter."""
    marks = [c for name in sorted(columns) for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return F.xxhash64(*marks)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in sorted(keys)]), F.lit(buckets)).cast("int")


def _folded(prefix: str = "") -> list[Column]:
    """The digest of a whole from the digests of its parts."""
    return [F.sum(f"{prefix}rows").alias("rows"), F.sum(f"{prefix}hash_sum").cast("decimal(38,0)").alias("hash_sum"),
            F.bit_xor(f"{prefix}hash_xor").alias("hash_xor")]


def digest_tree(df: DataFrame, by: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """K8: (label, rows, hash_sum, hash_xor, buckets) of every partition, its buckets in order.

    Rows are combined per (label, bucket) before the shuffle, so a partition with a third of all rows
    costs one row per bucket and task.
    """
    mark = row_mark([c for c in df.columns if c != by]).alias("mark")
    marked = df.select(F.col(f"`{by}`").alias("label"), bucket_of(keys, buckets).alias("bucket"), mark)
    leaves = marked.groupBy("label", "bucket").agg(
        F.count("*").alias("rows"), F.sum(F.col("mark").cast("decimal(38,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("mark").alias("hash_xor"))
    # At most ``buckets`` digests a partition.
    return leaves.groupBy("label").agg(*_folded(), F.array_sort(
        F.collect_list(F.struct("bucket", "rows", "hash_sum", "hash_xor"))).alias("buckets"))


def same_digest(left: str, right: str) -> Column:
    return (F.col(f"{left}.rows") == F.col(f"{right}.rows")) & (
        F.col(f"{left}.hash_sum") == F.col(f"{right}.hash_sum")) & (
        F.col(f"{left}.hash_xor") == F.col(f"{right}.hash_xor"))


@dataclass(frozen=True)
class Saved:
    """What a save did: the commit it made (None if nothing had changed) and one row per partition."""

    number: int | None
    partitions: DataFrame  # label, method, rows, previous_rows


class PartitionStore:
    """One table below a root, partitioned by a text column, its rows told apart by keys."""

    def __init__(self, spark: SparkSession, root: str, by: str, keys: Sequence[str], buckets: int = BUCKETS,
                 every: int = 10, put: Callable[[SparkSession, str, str], bool] = put_if_absent):
        self.spark, self.root, self.by, self.keys, self.buckets = spark, root.rstrip("/"), by, list(keys), buckets
        self.log = CommitLog(spark, root, ENTRY, every, put)

    # --- states ----------------------------------------------------------------------------

    def _actions_path(self, folder: str) -> str:
        return f"{self.root}/actions/{folder}"

    def _state_path(self, number: int) -> str:
        return f"{self.root}/states/{number:012d}"

    def entry(self, number: int):
        """The entry of a commit."""
        found = self.log.entries(number).where(F.col("number") == number).take(1)
        if not found:
            raise ValueError(f"there is no version {number}")
        return found[0]

    def state(self, number: int | None = None) -> DataFrame:
        """STATE: the folder and the digest tree of every partition as of a commit (default: now)."""
        number = self.log.head() if number is None else number
        if number < 0:
            return empty(self.spark, STATE)
        base = number - number % self.log.every
        base = base if base and exists(self.spark, f"{self._state_path(base)}/_SUCCESS") else -1
        entries = self.log.entries(number).where(F.col("number") > base).select("folder").collect()
        actions = [self._actions_path(r["folder"]) for r in entries]
        schema = f"{STATE}, action string"
        parts = self.spark.read.schema(schema).parquet(*actions) if actions else empty(self.spark, schema)
        if base >= 0:
            kept = self.spark.read.schema(STATE).parquet(self._state_path(base))
            parts = parts.unionByName(kept.withColumn("action", F.lit("keep")))
        names = [f.name for f in empty(self.spark, STATE).schema]
        newest = parts.groupBy("label").agg(F.max_by(
            F.struct(*[c for c in names if c != "label"], "action"), "number").alias("s"))
        return newest.where(F.col("s.action") != "remove").select(
            "label", *[F.col(f"s.{c}").alias(c) for c in names if c != "label"])

    def history(self) -> DataFrame:
        """Every commit: number, at, operation, info, partitions and rows written, rows of the table."""
        return self.log.entries().drop("folder", "columns")

    # --- reading ---------------------------------------------------------------------------

    def _schema(self, number: int) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.entry(number)["columns"]))

    def rows_of(self, places: DataFrame, schema: T.StructType) -> DataFrame:
        """The rows, with their bucket, of the partitions in ``places`` (label, folder)."""
        paths = [f"{self.root}/data/folder={r['folder']}/{self.by}={r['label']}"
                 for r in places.select("folder", "label").distinct().collect()]
        stored = T.StructType([*[f for f in schema if f.name != self.by], T.StructField(BUCKET, T.IntegerType()),
                               T.StructField(self.by, T.StringType()), T.StructField("folder", T.StringType())])
        if not paths:
            return empty(self.spark, stored)
        return self.spark.read.schema(stored).option("basePath", f"{self.root}/data").parquet(*paths)

    def read(self, number: int | None = None, labels: Sequence[str] | None = None) -> DataFrame:
        """The table as of a commit (default: now), or some of its partitions."""
        number = self.log.head() if number is None else number
        schema, places = self._schema(number), self.state(number)
        if labels is not None:
            places = places.where(F.col("label").isin(list(labels)))
        return self.rows_of(places, schema).select(*[f"`{f.name}`" for f in schema])

    # --- saving ----------------------------------------------------------------------------

    def save(self, df: DataFrame, info: str = "", shrink: str = "raise", whole: bool = False,
             second: Callable[[], DataFrame] | None = None, tries: int = 5) -> Saved:
        """K7 per partition: ``new``, ``update`` or ``skip``; only new and changed ones are written.

        Partitions that ``df`` has no rows of stay as they are; with ``whole`` they are removed. A partition
        that gets fewer rows than it has (removed: none) is judged by ``shrink``: ``raise``, ``verify`` (a
        second extract must have the same digest) or ``allow``. Where another save was committed
        meanwhile, this one is judged again on top of it: partitions that the other brought to the same
        content are left out, all others are replaced, and the other's rows stay readable as a version.
        """
        if shrink not in ("raise", "verify", "allow"):
            raise ValueError(f"shrink must be raise, verify or allow, not {shrink}")
        self._check_columns(df)
        tree = as_table(digest_tree(df, self.by, self.keys, self.buckets), "digest-tree")
        odd = tree.where(F.col("label").isNull() | ~F.col("label").rlike(LABEL)).select("label").take(1)
        if odd:
            raise ValueError(f"{odd[0]['label']!r} cannot be the label of a partition")
        if not tree.take(1):
            raise ValueError("no rows, nothing is saved")
        folder, written = f"{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}", None
        seen: dict[str, DataFrame] = {}
        try:
            for turn in range(tries):
                head = self.log.head()
                judged = as_table(self._judge(tree, head, whole), "judged-partitions")
                self._check_shrink(judged, shrink, second, seen)
                changed = judged.where("method <> 'skip'")
                if not changed.take(1):
                    self._discard(folder, turn)
                    return Saved(None, self._outcome(judged))
                if written is None:
                    written = self._write(df, changed.where("method <> 'remove'"), folder)
                elif changed.where("method <> 'remove'").join(written, "label", "left_anti").take(1):
                    # Another save changed a partition that this one had found unchanged.
                    missing = changed.where("method <> 'remove'").join(written, "label", "left_anti")
                    written = written.union(self._write(df, missing, folder))
                if self._commit(judged, changed, folder, f"{folder}-{turn}", head, df.schema, info):
                    return Saved(head + 1, self._outcome(judged))
            raise ConflictError(f"{tries} tries, each time another save came first")
        except Exception:
            self._discard(folder, tries)
            raise

    def _check_columns(self, df: DataFrame) -> None:
        missing = [c for c in (self.by, *self.keys) if c not in df.columns]
        if missing or any(c in df.columns for c in (BUCKET, "folder")):
            raise ValueError(f"columns {missing} are missing" if missing else f"{BUCKET} and folder are names of the store")
        if not isinstance(df.schema[self.by].dataType, T.StringType):
            raise ValueError(f"{self.by} must be text")
        head = self.log.head()
        if head < 0:
            return
        before = {f.name: f.dataType for f in self._schema(head)}
        turned = [f.name for f in df.schema if before.get(f.name, f.dataType) != f.dataType]
        if turned:
            raise ValueError(f"columns {turned} have another type than before")

    def _judge(self, tree: DataFrame, head: int, whole: bool) -> DataFrame:
        """The tree beside what is there: label, both digests, the method."""
        new = tree.select("label", F.struct("rows", "hash_sum", "hash_xor").alias("new"), "buckets")
        old = self.state(head).select("label", F.struct("rows", "hash_sum", "hash_xor").alias("old"), "folder")
        both = new.join(old, "label", "full")
        gone = F.lit("remove") if whole else F.lit(None).cast("string")
        method = (F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), gone)
                  .when(same_digest("new", "old"), "skip").otherwise("update"))
        return both.withColumn("method", method).where("method is not null")

    def _check_shrink(self, judged: DataFrame, shrink: str, second, seen: dict) -> None:
        """K10 per partition."""
        if shrink == "allow":
            return
        fewer = judged.where("coalesce(new.rows, 0) < old.rows")
        if shrink == "verify" and second is not None:
            if "tree" not in seen:
                seen["tree"] = as_table(digest_tree(second(), self.by, self.keys, self.buckets), "second-tree")
            again = seen["tree"].select("label", F.struct("rows", "hash_sum", "hash_xor").alias("again"))
            both = fewer.join(again, "label", "left")
            agreed = F.coalesce(same_digest("new", "again"), F.col("new").isNull() & F.col("again").isNull())
            fewer = both.where(~agreed)
        bad = fewer.select("label", "old.rows", F.coalesce("new.rows", F.lit(0)).alias("now")).orderBy("label").take(1)
        if bad:
            raise ShrinkError(f"{bad[0]['label']}: {bad[0]['rows']} rows before, {bad[0]['now']} now")

    def _write(self, df: DataFrame, changed: DataFrame, folder: str) -> DataFrame:
        """The rows of changed partitions below the save's own folder; returns their labels."""
        labels = as_table(changed.select("label"), "written-labels")
        picked = df.withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        picked = rows_with_key(picked, labels.withColumnRenamed("label", self.by), [self.by])
        # A partition in few files, each in order of buckets; one too large for a task is split.
        (picked.hint("rebalance", self.by).sortWithinPartitions(self.by, BUCKET)
         .write.mode("append").partitionBy(self.by).parquet(f"{self.root}/data/folder={folder}"))
        return labels

    def _commit(self, judged, changed, folder, actions, head, schema, info, operation: str = "save") -> bool:
        action = F.when(F.col("method") == "remove", "remove").otherwise("add")
        (changed.select(
            "label", F.lit(folder).alias("folder"), F.lit(head + 1).cast("long").alias("number"), "new.rows",
            "new.hash_sum", "new.hash_xor", "buckets", action.alias("action"))
         .write.parquet(self._actions_path(actions)))
        total = self.state(head).select("label", "rows", "hash_sum", "hash_xor").join(
            changed.select("label"), "label", "left_anti").unionByName(
            changed.where("method <> 'remove'").select("label", "new.rows", "new.hash_sum", "new.hash_xor")
        ).agg(*_folded()).first()
        facts = changed.agg(F.count("*").alias("n"), F.coalesce(F.sum("new.rows"), F.lit(0)).alias("rows")).first()
        known = [] if head < 0 else list(self._schema(head))
        names = {f.name for f in known}
        columns = T.StructType([*known, *[f for f in schema if f.name not in names]])
        entry = {"at": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(), "operation": operation,
                 "info": info, "folder": actions, "n_partitions": facts["n"], "n_rows": facts["rows"],
                 "rows": total["rows"] or 0, "hash_sum": str(total["hash_sum"] or 0), "hash_xor": total["hash_xor"] or 0,
                 "columns": columns.json()}
        if not self.log.append(entry, head):
            delete(self.spark, self._actions_path(actions))
            return False
        if (head + 1) and (head + 1) % self.log.every == 0:
            self.state(head + 1).write.mode("overwrite").parquet(self._state_path(head + 1))
        return True

    def _discard(self, folder: str, turns: int) -> None:
        """Deletes what a save wrote and did not commit; what a commit names stays."""
        made = self.log.entries().where(F.col("folder").startswith(folder)).take(1)
        if not made:
            delete(self.spark, f"{self.root}/data/folder={folder}")
            for turn in range(turns):
                delete(self.spark, self._actions_path(f"{folder}-{turn}"))

    def _outcome(self, judged: DataFrame) -> DataFrame:
        return judged.select("label", "method", F.coalesce("new.rows", F.lit(0)).cast("long").alias("rows"),
                             F.col("old.rows").alias("previous_rows"))

    # --- comparing -------------------------------------------------------------------------

    def changed_buckets(self, first: int, second: int) -> DataFrame:
        """(label, bucket) whose digests differ between two versions (-1: the empty table)."""
        if first >= 0 and second >= 0:
            a, b = self.entry(first), self.entry(second)
            if all(a[c] == b[c] for c in ("rows", "hash_sum", "hash_xor")):
                return empty(self.spark, "label string, bucket int")

        def side(number: int, name: str) -> DataFrame:
            digest = F.struct("rows", "hash_sum", "hash_xor").alias(name)
            return self.state(number).select("label", digest, F.col("buckets").alias(f"{name}_buckets"))

        both = side(first, "a").join(side(second, "b"), "label", "full")
        changed = as_table(both.where(~F.coalesce(same_digest("a", "b"), F.lit(False))), "changed-partitions")

        def leaves(name: str) -> DataFrame:
            each = changed.select("label", F.explode(f"{name}_buckets").alias("leaf"))
            return each.select("label", "leaf.bucket", F.struct("leaf.rows", "leaf.hash_sum", "leaf.hash_xor").alias(name))

        pairs = leaves("a").join(leaves("b"), ["label", "bucket"], "full")
        return pairs.where(~F.coalesce(same_digest("a", "b"), F.lit(False))).select("label", "bucket")

    def rows_in(self, number: int, buckets: DataFrame) -> DataFrame:
        """The rows of a version in given (label, bucket): other partitions are not listed, row groups of
        other buckets not read."""
        if number < 0:
            raise ValueError("the empty table has no columns")
        schema = self._schema(number)
        places = self.state(number).join(buckets.select("label").distinct(), "label", "left_semi")
        numbers = sorted(r["bucket"] for r in buckets.select("bucket").distinct().collect())  # at most self.buckets
        rows = self.rows_of(places, schema).where(F.col(BUCKET).isin(numbers))
        wanted = buckets.select(F.col("label").alias(self.by), F.col("bucket").alias(BUCKET))
        return rows_with_key(rows, wanted, [self.by, BUCKET]).select(*[f"`{f.name}`" for f in schema])
