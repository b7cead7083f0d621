"""What of a versioned table can go, and putting many small files into few.

Both work on metadata: the listing of the table's folder, the actions of its commits, the holds of its readers.
Deleting and rewriting change no version that can still be read.
"""

from __future__ import annotations

import datetime as dt
import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import as_table, shared_root
from tallyloom.sinks.commits import CommitLog, _hadoop, delete
from tallyloom.sinks.partitions import BUCKET, STATE, PartitionStore
from tallyloom.sources.scan import file_listing

HOLD = "reader string, version bigint, until timestamp"


# --- holds ---------------------------------------------------------------------------------

def _holds(store: PartitionStore) -> CommitLog:
    return CommitLog(store.spark, f"{store.root}/holds", HOLD)


def hold(store: PartitionStore, reader: str, version: int, until: dt.datetime) -> None:
    """Keeps a version readable until a moment (UTC); a later hold of the same reader replaces it."""
    log = _holds(store)
    while not log.append({"reader": reader, "version": version, "until": until.isoformat()}, log.head()):
        pass


def held(store: PartitionStore, now: dt.datetime) -> DataFrame:
    """(version) that some reader still holds."""
    newest = _holds(store).entries().groupBy("reader").agg(F.max_by(F.struct("version", "until"), "number").alias("h"))
    return newest.where(F.col("h.until") >= F.lit(now)).select("h.version").distinct()


# --- mark ----------------------------------------------------------------------------------

def spans(store: PartitionStore) -> DataFrame:
    """(label, folder, valid_from, valid_to): the versions that each stored partition is part of.

    What is gathered per label is one number per commit that touched it.
    """
    committed = store.log.entries().select("folder").withColumnRenamed("folder", "committed")
    actions = (store.spark.read.schema(f"{STATE}, action string").option("recursiveFileLookup", True)
               .parquet(f"{store.root}/actions").withColumn("committed", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)))
    done = actions.join(committed, "committed", "left_semi")
    per_label = done.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("number", "folder", "action"))).alias("a"))
    each = per_label.select("label", "a", F.posexplode("a").alias("i", "own"))
    later = F.get(F.col("a"), F.col("i") + 1)["number"]
    return each.where("own.action = 'add'").select(
        "label", "own.folder", F.col("own.number").alias("valid_from"), later.alias("valid_to"))


def stored(store: PartitionStore) -> DataFrame:
    """(label, folder, n_files, bytes, modified) of what lies in the table's folder; no file is opened."""
    files = file_listing(store.spark, [f"{store.root}/data"])
    inside = F.split(F.col("file_path"), "/")
    label = F.substring_index(F.element_at(inside, -2), "=", -1)
    folder = F.substring_index(F.element_at(inside, -3), "=", -1)
    return files.groupBy(label.alias("label"), folder.alias("folder")).agg(
        F.count("*").alias("n_files"), F.sum("length").alias("bytes"), F.max("modified").alias("modified"))


def vacuum_plan(store: PartitionStore, older_than: dt.datetime, grace: dt.timedelta = dt.timedelta(hours=24),
                now: dt.datetime | None = None) -> DataFrame:
    """(label, folder, n_files, bytes, reason) of what no reader needs any more.

    Kept is what belongs to the current version, to the one that was current at ``older_than``, to any since,
    or to one that a reader holds. ``superseded`` went out of use before; ``orphan`` was written by a save
    that made no commit, and is left alone during ``grace``, as its save may still be at work.
    """
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    first = max(store.log.at(older_than), 0)
    used = as_table(spans(store), "version-spans")
    # One number per reader that holds a version.
    versions = [r["version"] for r in held(store, now).collect()]
    by_hold = F.exists(F.lit(versions).cast("array<bigint>"), lambda v: (F.col("valid_from") <= v) & (
        F.col("valid_to").isNull() | (F.col("valid_to") > v))) if versions else F.lit(False)
    needed = used.where(F.col("valid_to").isNull() | (F.col("valid_to") > first) | by_hold).select("label", "folder").distinct()
    loose = stored(store).join(needed, ["label", "folder"], "left_anti").join(
        used.select("label", "folder", F.lit(True).alias("known")).distinct(), ["label", "folder"], "left")
    reason = F.when(F.col("known"), "superseded").when(F.col("modified") < F.lit(now - grace), "orphan")
    return loose.withColumn("reason", reason).where("reason is not null").select("label", "folder", "n_files", "bytes", "reason")


def vacuum(store: PartitionStore, older_than: dt.datetime, grace: dt.timedelta = dt.timedelta(hours=24),
           now: dt.datetime | None = None) -> int:
    """Deletes what ``vacuum_plan`` names; returns the number of folders. Rows of versions kept do not change."""
    plan = as_table(vacuum_plan(store, older_than, grace, now), "vacuum-plan")
    count = 0
    for r in plan.select("folder", "label").toLocalIterator():
        delete(store.spark, f"{store.root}/data/folder={r['folder']}/{store.by}={r['label']}")
        count += 1
    return count


def drop_scratch(spark, older_than: dt.timedelta = dt.timedelta(days=1)) -> int:
    """Deletes scratch tables that have not been written to for that long; returns their number."""
    _, target, system = _hadoop(spark, f"{shared_root(spark).rstrip('/')}/scratch")
    if not system.exists(target):
        return 0
    limit = (dt.datetime.now(dt.timezone.utc) - older_than).timestamp() * 1000
    old = [f.getPath().toString() for f in system.listStatus(target) if f.getModificationTime() < limit]
    for path in old:
        delete(spark, path)
    return len(old)


# --- compaction ----------------------------------------------------------------------------

def packed(sizes: list[int], target: int) -> int:
    """Files of at most ``target`` bytes that hold files of these sizes, the largest first into the first that fits;
    a larger file is one of its own. At most 11/9 of the fewest possible, and one."""
    room: list[int] = []
    for size in sorted(sizes, reverse=True):
        at = next((i for i, left in enumerate(room) if left >= size), None)
        if at is None:
            room.append(max(target - size, 0))
        else:
            room[at] -= size
    return len(room)


def compaction_plan(store: PartitionStore, target_bytes: int) -> DataFrame:
    """(label, folder, n_files, bytes, n_packed) of partitions whose files fit into fewer.

    The files of one partition are packed in one group of sizes.
    """
    files = file_listing(store.spark, [f"{store.root}/data"])
    inside = F.split(F.col("file_path"), "/")
    placed = files.select(F.substring_index(F.element_at(inside, -2), "=", -1).alias("label"),
                          F.substring_index(F.element_at(inside, -3), "=", -1).alias("folder"), "length")
    now = placed.join(store.state().select("label", "folder"), ["label", "folder"])

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"label": [group["label"].iloc[0]], "folder": [group["folder"].iloc[0]], "n_files": [len(group)],
                             "bytes": [int(group["length"].sum())], "n_packed": [packed(group["length"].tolist(), target_bytes)]})

    sized = now.groupBy("label", "folder").applyInPandas(pack, "label string, folder string, n_files long, bytes long, n_packed long")
    return sized.where("n_packed < n_files")


def compact(store: PartitionStore, target_bytes: int) -> int | None:
    """Rewrites the partitions of the plan into fewer files and commits that as one version.

    Rows, digests and all other partitions stay as they are. A partition that a save replaced meanwhile is
    left to the next compaction. Returns the commit, None if there was nothing to do.
    """
    spark, folder = store.spark, f"{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"
    plan = as_table(compaction_plan(store, target_bytes), "compaction-plan")
    if not plan.take(1):
        return None
    head = store.log.head()
    schema = store._schema(head)
    rows = store.rows_of(plan, schema).drop("folder")
    counts = plan.select(F.col("label").alias(store.by), "n_packed")
    # Buckets are dealt to as many parts as the partition is to have files; a part is in one task.
    dealt = rows.join(counts, store.by).withColumn("_part", F.floor(F.col(BUCKET) * F.col("n_packed") / store.buckets))
    parts = min(plan.agg(F.sum("n_packed")).first()[0], 100_000)
    (dealt.drop("n_packed").repartition(int(parts), store.by, "_part").sortWithinPartitions(store.by, BUCKET).drop("_part")
     .write.partitionBy(store.by).parquet(f"{store.root}/data/folder={folder}"))
    for turn in range(5):
        head = store.log.head()
        state = store.state(head).join(plan.select("label", "folder"), ["label", "folder"], "left_semi")
        same = as_table(state.select("label", F.lit("update").alias("method"), F.struct("rows", "hash_sum", "hash_xor").alias("new"),
                                     "buckets"), "compacted")
        if not same.take(1):
            break
        if store._commit(same, same, folder, f"{folder}-{turn}", head, store._schema(head), "", operation="compact"):
            return head + 1
    delete(spark, f"{store.root}/data/folder={folder}")
    return None
