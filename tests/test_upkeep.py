"""Retention, compaction, clustering and streams into versioned tables."""

import datetime as dt
import glob
import itertools
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.resolve import dedupe_by_strategy
from tallyloom.session import as_table, scratch_path
from tallyloom.sinks import cluster, retention
from tallyloom.sinks.partitions import PartitionStore
from tallyloom.streaming.resolved import keep_resolved

ROWS = "k long, v string, p string"
BASE = [(i, f"v{i}", f"p{i % 3}") for i in range(30)]
DAY = dt.timedelta(days=1)


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, ROWS)


@pytest.fixture
def kept(spark):
    return PartitionStore(spark, scratch_path(spark, "store"), "p", ["k"])


def content(df):
    return sorted(map(tuple, df.select("k", "v", "p").collect()))


def changed(turn, label):
    return [(k, f"{v}-{turn}" if p == label else v, p) for k, v, p in BASE]


def utc():
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def marked(df):
    return sorted((r["label"], r["reason"]) for r in df.collect())


def test_only_what_no_kept_version_needs_goes(spark, frame, kept):
    for turn, label in enumerate(("p0", "p1", "p0")):
        kept.save(frame(changed(turn, label)))
    plan = retention.vacuum_plan(kept, utc() + DAY)
    # p0 was written by saves 0, 1 and 2, p1 by 0, 1 and 2, p2 once.
    assert marked(plan) == [("p0", "superseded")] * 2 + [("p1", "superseded")] * 2
    assert marked(retention.vacuum_plan(kept, utc() - DAY)) == []  # the first version is within the time to keep
    assert retention.vacuum(kept, utc() + DAY) == 4
    assert content(kept.read()) == sorted(changed(2, "p0"))
    assert retention.vacuum_plan(kept, utc() + DAY).count() == 0
    kept.save(frame(changed(3, "p2")))
    assert content(kept.read(2)) == sorted(changed(2, "p0"))


def test_a_reader_of_an_old_version_is_unharmed(frame, kept):
    for turn in range(4):
        kept.save(frame(changed(turn, "p1")))
    retention.hold(kept, "report", 1, utc() + DAY)
    retention.hold(kept, "old report", 0, utc() - DAY)  # has let go
    assert retention.vacuum(kept, utc() + DAY) == 2  # of versions 0 and 2
    assert content(kept.read(1)) == sorted(changed(1, "p1"))
    assert content(kept.read(3)) == sorted(changed(3, "p1"))
    retention.hold(kept, "report", 3, utc() + DAY)  # a later hold replaces the earlier
    assert marked(retention.vacuum_plan(kept, utc() + DAY)) == [("p1", "superseded")]


def test_orphans_have_a_time_of_grace(spark, frame, kept):
    kept.save(frame(BASE))
    frame(BASE).write.partitionBy("p").parquet(f"{kept.root}/data/folder=left-over")
    assert retention.vacuum_plan(kept, utc() + DAY).count() == 0
    later = utc() + 2 * DAY
    assert marked(retention.vacuum_plan(kept, utc() + DAY, now=later)) == [(f"p{i}", "orphan") for i in range(3)]
    assert retention.vacuum(kept, utc() + DAY, now=later) == 3
    assert content(kept.read()) == sorted(BASE)


def test_scratch_tables_are_dropped_by_age(spark):
    path = as_table(spark.range(3), "to-drop").inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert retention.drop_scratch(spark, DAY) >= 0 and os.path.exists(path)
    os.utime(path, (time.time() - 3 * 86_400,) * 2)
    assert retention.drop_scratch(spark, DAY) >= 1 and not os.path.exists(path)


def fewest(sizes, target):
    """The fewest bins, by trying all assignments."""
    best = len(sizes)
    for bins in itertools.product(range(best), repeat=len(sizes)):
        used = {}
        for b, s in zip(bins, sizes):
            used[b] = used.get(b, 0) + s
        if max(used.values()) <= target:
            best = min(best, len(used))
    return best


def test_packing_is_near_the_fewest():
    draw = random.Random(4)
    for _ in range(25):
        sizes = [draw.randrange(1, 60) for _ in range(draw.randrange(1, 7))]
        target = draw.randrange(max(sizes), 130)
        assert fewest(sizes, target) <= retention.packed(sizes, target) <= 11 / 9 * fewest(sizes, target) + 1
    assert retention.packed([500, 1, 1], 10) == 2 and retention.packed([], 10) == 0


def test_compaction_leaves_rows_and_others_alone(spark, frame, kept, monkeypatch):
    many = [(i, f"v{i}", "big" if i % 4 else "small") for i in range(4000)]
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        kept.save(frame(many).repartition(8))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    kept.save(frame([(9000, "x", "alone")]))
    before = {r["label"]: r["n_files"] for r in retention.stored(kept).collect()}
    plan = {r["label"]: (r["n_files"], r["n_packed"]) for r in retention.compaction_plan(kept, 1 << 20).collect()}
    assert plan["big"] == (before["big"], 1) and "alone" not in plan
    folder = {r["label"]: r["folder"] for r in kept.state().collect()}
    assert retention.compact(kept, 1 << 20) == 2
    now = {r["label"]: r["folder"] for r in kept.state().collect()}
    assert now["alone"] == folder["alone"] and now["big"] != folder["big"]
    files = glob.glob(f"{kept.root.removeprefix('file://')}/data/folder={now['big']}/p=big/*.parquet")
    assert len(files) == 1
    assert content(kept.read()) == sorted([*many, (9000, "x", "alone")]) and content(kept.read(0)) == sorted(many)
    assert kept.changed_buckets(1, 2).count() == 0 and kept.entry(2)["operation"] == "compact"
    assert retention.compact(kept, 1 << 20) is None
    assert {r["method"] for r in kept.save(frame(many)).partitions.collect()} == {"skip"}


# --- clustering ----------------------------------------------------------------------------

def test_the_curve_goes_from_neighbour_to_neighbour():
    side = 1 << cluster.BITS
    at = {cluster.curve_place(x, y): (x, y) for x in range(side) for y in range(side)}
    assert sorted(at) == list(range(side * side))
    assert all(abs(at[i][0] - at[i + 1][0]) + abs(at[i][1] - at[i + 1][1]) == 1 for i in range(side * side - 1))


@pytest.fixture(scope="module")
def clustered(spark):
    path = scratch_path(spark, "clustered")
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.format_string("s%04d", F.pmod(F.xxhash64("id"), F.lit(700)))).alias("symbol"),
        F.when(F.col("id") % 50 > 0, F.pmod(F.xxhash64(F.col("id") * 7), F.lit(3000)).cast("int")).alias("day"), "id")
    cluster.write_clustered(rows, path, ("symbol", "day"), 64)
    return path, rows


def test_either_filter_reads_few_files(spark, clustered):
    path, rows = clustered
    total = spark.read.parquet(f"{path}/index").count()
    assert total > 40
    for wanted in ({"symbol": ("s0100", "s0110")}, {"day": (100, 130)}):
        assert cluster.files_for(spark, path, wanted).count() <= total / 3
    assert cluster.files_for(spark, path, {"symbol": ("s0100", "s0110"), "day": (100, 130)}).count() <= 4
    sizes = [r["n_rows"] for r in spark.read.parquet(f"{path}/index").collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 2000  # a third of all rows is one symbol


@pytest.mark.parametrize("wanted", [{"symbol": ("s0100", "s0110")}, {"day": (0, 40)}, {"symbol": ("HOT", "HOT"), "day": (5, 50)},
                                    {"symbol": ("t", "z")}])
def test_clustered_reads_find_all_rows(spark, clustered, wanted):
    path, rows = clustered
    want = rows
    for c, (low, high) in wanted.items():
        want = want.where(F.col(c).between(low, high))
    got = cluster.read_clustered(spark, path, wanted)
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())


def test_rows_without_values_are_kept(spark):
    path = scratch_path(spark, "clustered")
    rows = spark.createDataFrame([(None, None), ("a", None), (None, 3)], "s string, d int")
    cluster.write_clustered(rows, path, ("s", "d"), 4)
    assert spark.read.parquet(f"{path}/rows").count() == 3
    assert [tuple(r) for r in cluster.read_clustered(spark, path, {"d": (0, 9)}).collect()] == [(None, 3)]


# --- streams -------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_into_batches_gives_the_batch_result(spark, seed):
    draw = random.Random(seed)
    revisions = [(draw.choice("ab"), draw.choice([2020, 2021]), draw.choice("01"), draw.choice(["20200105", "20210301", None]),
                  draw.choice("12"), float(i)) for i in range(40)]
    schema = "symbol string, period_end int, update_flag string, ann_date string, report_type string, amount double"
    rows = spark.createDataFrame(revisions, schema).withColumn("label", F.col("period_end").cast("string"))
    want = dedupe_by_strategy(rows, ["symbol", "period_end", "label"], "keep_official_report")
    root = scratch_path(spark, "stream")
    store = PartitionStore(spark, f"{root}/table", "label", ["symbol", "period_end", "label"])
    draw.shuffle(revisions)
    cuts = sorted(draw.sample(range(1, 40), 2))
    for low, high in zip([0, *cuts], [*cuts, 40]):
        part = spark.createDataFrame(revisions[low:high], schema).withColumn("label", F.col("period_end").cast("string"))
        part.coalesce(1).write.mode("append").parquet(f"{root}/drop")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/drop")
        keep_resolved(stream, store, "keep_official_report", f"{root}/progress").awaitTermination()
    assert sorted(map(tuple, store.read().collect()), key=repr) == sorted(map(tuple, want.select(*store.read().columns).collect()), key=repr)
    before = store.log.head()
    keep_resolved(spark.readStream.schema(rows.schema).parquet(f"{root}/drop"), store, "keep_official_report",
                  f"{root}/progress").awaitTermination()
    assert store.log.head() == before  # nothing new has landed


def test_a_row_that_moves_leaves_its_old_partition(spark):
    schema = "symbol string, amount double, update_flag string, ann_date string, label string"
    root = scratch_path(spark, "stream")
    store = PartitionStore(spark, f"{root}/table", "label", ["symbol"])
    for batch in ([("a", 1.0, "0", "20200101", "one"), ("b", 1.0, "0", "20200101", "one")], [("a", 2.0, "1", "20200201", "two")]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{root}/drop")
        stream = spark.readStream.schema(schema).parquet(f"{root}/drop")
        keep_resolved(stream, store, "keep_latest_update", f"{root}/progress").awaitTermination()
    assert sorted((r["symbol"], r["amount"], r["label"]) for r in store.read().collect()) == [("a", 2.0, "two"), ("b", 1.0, "one")]
