"""Commit log, partition saves, digests and changes between versions."""

import glob
import os
import re
import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.session import scratch_path
from tallyloom.sinks import changes
from tallyloom.sinks.commits import CommitLog, put_if_absent
from tallyloom.sinks.partitions import ConflictError, PartitionStore, digest_tree
from tallyloom.sinks.snapshot import ShrinkError

ROWS = "k long, v string, p string"


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, ROWS)


@pytest.fixture
def kept(spark):
    return lambda **options: PartitionStore(spark, scratch_path(spark, "store"), "p", ["k"], **options)


def local(path):
    return path.removeprefix("file://")


def files(store):
    found = glob.glob(f"{local(store.root)}/data/**/*.parquet", recursive=True)
    return {f: (os.path.getmtime(f), os.path.getsize(f)) for f in found}


def done(saved):
    return {r["label"]: r["method"] for r in saved.partitions.collect()}


def content(df):
    return sorted(map(tuple, df.select("k", "v", "p").collect()), key=repr)


BASE = [(i, f"v{i}", f"p{i % 4}") for i in range(40)]


# --- the log -------------------------------------------------------------------------------

def test_two_hundred_commits_read_one_fold_and_the_rest(spark):
    log = CommitLog(spark, scratch_path(spark, "log"), "what string", every=25)
    assert log.head() == -1 and log.entries().count() == 0
    for n in range(200):
        assert log.append({"what": f"w{n}"}, n - 1)
    fold, tail = log.sources()
    assert log.head() == 199 and fold == 175 and len(tail) == 24
    assert sorted((r["number"], r["what"]) for r in log.entries().collect()) == [(n, f"w{n}") for n in range(200)]
    assert log.entries(30).count() == 31  # before the newest fold
    assert [r["number"] for r in log.since(197)] == [198, 199]


def test_a_number_is_given_once(spark):
    root = scratch_path(spark, "log")
    log, other = (CommitLog(spark, root, "what string") for _ in range(2))
    assert log.append({"what": "mine"}, -1)
    assert not other.append({"what": "theirs"}, -1)
    assert [r["what"] for r in other.entries().collect()] == ["mine"]
    with pytest.raises(ValueError, match="no commit 5"):
        log.append({"what": "later"}, 5)


def test_of_many_writers_one_puts(spark):
    path, won = f"{scratch_path(spark, 'race')}/one", []
    threads = [threading.Thread(target=lambda n=n: won.append(n) if put_if_absent(spark, path, f"writer {n}") else None)
               for n in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1
    assert open(local(path)).read() == f"writer {won[0]}"
    assert os.listdir(os.path.dirname(local(path))) == ["one"]


def test_folds_half_written_are_not_read(spark):
    log = CommitLog(spark, scratch_path(spark, "log"), "what string", every=3)
    for n in range(4):
        log.append({"what": "w"}, n - 1)
    os.remove(f"{local(log.folder)}/folds/000000000003/_SUCCESS")
    assert log.folded() == -1 and log.entries().count() == 4 and log.head() == 3


# --- saves ---------------------------------------------------------------------------------

def test_only_changed_partitions_are_written(frame, kept):
    store = kept()
    assert done(store.save(frame(BASE))) == dict.fromkeys(["p0", "p1", "p2", "p3"], "new")
    before = files(store)
    changed = [(k, "other" if k == 2 else v, p) for k, v, p in BASE]
    saved = store.save(frame(changed).repartition(7))
    assert done(saved) == {"p0": "skip", "p1": "skip", "p2": "update", "p3": "skip"} and saved.number == 1
    after = files(store)
    assert {f: after[f] for f in before} == before
    new = set(after) - set(before)
    assert new and all("/p=p2/" in f for f in new)
    assert content(store.read()) == sorted(changed, key=repr)
    assert content(store.read(0)) == sorted(BASE, key=repr)
    assert content(store.read(labels=["p1"])) == sorted([r for r in BASE if r[2] == "p1"], key=repr)


def test_an_equal_save_writes_nothing(frame, kept):
    store = kept()
    store.save(frame(BASE))
    before = sorted(glob.glob(f"{local(store.root)}/**", recursive=True))
    saved = store.save(frame(BASE[::-1]).select("v", "p", "k").select("k", "v", "p"))
    assert saved.number is None and set(done(saved).values()) == {"skip"}
    assert sorted(glob.glob(f"{local(store.root)}/**", recursive=True)) == before


def test_partitions_that_are_gone(frame, kept):
    store = kept()
    store.save(frame(BASE))
    some = [r for r in BASE if r[2] in ("p0", "p1")]
    assert done(store.save(frame(some))) == {"p0": "skip", "p1": "skip"}  # the others stay
    with pytest.raises(ShrinkError):
        store.save(frame(some), whole=True)
    assert done(store.save(frame(some), whole=True, shrink="allow")) == {
        "p0": "skip", "p1": "skip", "p2": "remove", "p3": "remove"}
    assert content(store.read()) == sorted(some, key=repr)
    assert done(store.save(frame(BASE))) == {"p0": "skip", "p1": "skip", "p2": "new", "p3": "new"}
    assert [r["rows"] for r in sorted(store.history().collect())] == [40, 20, 40]


def test_fewer_rows_need_a_second_extract(frame, kept):
    store, fewer = kept(), [r for r in BASE if r[0] != 2]
    store.save(frame(BASE))
    with pytest.raises(ShrinkError, match="p2: 10 rows before, 9 now"):
        store.save(frame(fewer))
    with pytest.raises(ShrinkError):
        store.save(frame(fewer), shrink="verify", second=lambda: frame(BASE))
    assert done(store.save(frame(fewer), shrink="verify", second=lambda: frame(fewer)))["p2"] == "update"
    assert len(files(store)) == len({f for f in files(store)})


def test_what_cannot_be_saved(spark, frame, kept):
    store = kept()
    for bad in ([], [(1, "v", None)], [(1, "v", "a/b")], [(1, "v", "")]):
        with pytest.raises(ValueError):
            store.save(frame(bad))
    assert store.log.head() == -1
    store.save(frame(BASE))
    with pytest.raises(ValueError, match="another type"):
        store.save(frame(BASE).withColumn("v", F.lit(1)))
    with pytest.raises(ValueError, match="missing"):
        store.save(frame(BASE).drop("k"))
    with pytest.raises(ValueError, match="no version 7"):
        store.entry(7)


def test_new_columns_and_repeated_rows(frame, kept):
    store = kept()
    rows = [*BASE, BASE[0], (None, None, "p0"), (None, None, "p0")]
    store.save(frame(rows))
    assert content(store.read()) == sorted(rows, key=repr)
    store.save(frame(BASE[1:2]).withColumn("extra", F.lit(5)), shrink="allow")
    now = store.read()
    assert now.columns == ["k", "v", "p", "extra"]
    assert {r["extra"] for r in now.where("p = 'p1'").collect()} == {5}
    assert {r["extra"] for r in now.where("p = 'p0'").collect()} == {None}
    assert store.read(0).columns == ["k", "v", "p"]


def test_a_save_that_breaks_leaves_nothing(spark, frame, kept, monkeypatch):
    store = kept()
    store.save(frame(BASE))
    before = sorted(glob.glob(f"{local(store.root)}/**", recursive=True))
    changed = frame(BASE).withColumn("v", F.lit("x"))
    written = PartitionStore._write

    def torn(self, df, some, folder):
        broken = df.withColumn("v", F.when(F.col("k") == 39, F.raise_error(F.lit("disk full"))).otherwise(F.col("v")))
        return written(self, broken, some, folder)
    monkeypatch.setattr(PartitionStore, "_write", torn)
    with pytest.raises(PySparkException, match="disk full"):
        store.save(changed)
    monkeypatch.undo()

    def lost(spark, path, text):
        raise OSError("gone")
    with pytest.raises(OSError):
        PartitionStore(spark, store.root, "p", ["k"], put=lost).save(changed)
    assert sorted(glob.glob(f"{local(store.root)}/**", recursive=True)) == before
    assert content(store.read()) == sorted(BASE, key=repr)


# --- savers at the same time ---------------------------------------------------------------

def interleaved(spark, store, meanwhile):
    """A saver of the same table whose first commit comes after ``meanwhile``."""
    calls = []

    def put(session, path, text):
        if not calls:
            calls.append(path)
            meanwhile()
        return put_if_absent(session, path, text)
    return PartitionStore(spark, store.root, "p", ["k"], put=put)


def test_two_savers_of_different_partitions_lose_nothing(spark, frame, kept):
    store = kept()
    store.save(frame(BASE))
    slow = interleaved(spark, store, lambda: store.save(frame([(k, "theirs", p) for k, v, p in BASE if p == "p3"])))
    saved = slow.save(frame([(k, "mine", p) for k, v, p in BASE if p == "p1"]))
    assert saved.number == 2
    want = [(k, {"p1": "mine", "p3": "theirs"}.get(p, v), p) for k, v, p in BASE]
    assert content(store.read()) == sorted(want, key=repr)
    assert [(r["number"], r["rows"]) for r in sorted(store.history().select("number", "rows").collect())] == [(0, 40), (1, 40), (2, 40)]


def test_two_savers_of_one_partition(spark, frame, kept):
    store = kept()
    store.save(frame(BASE))
    mine = frame([(k, "same", p) for k, v, p in BASE if p == "p1"])
    again = interleaved(spark, store, lambda: store.save(mine)).save(mine)
    assert again.number is None and done(again) == {"p1": "skip"}  # the other brought the same
    assert store.log.head() == 1
    last = interleaved(spark, store, lambda: store.save(frame([(k, "theirs", p) for k, v, p in BASE if p == "p1"]))).save(
        frame([(k, "last", p) for k, v, p in BASE if p == "p1"]))
    assert last.number == 3
    assert {r["v"] for r in store.read(labels=["p1"]).collect()} == {"last"}
    assert {r["v"] for r in store.read(2, labels=["p1"]).collect()} == {"theirs"}


def test_a_partition_found_unchanged_is_judged_again(spark, frame, kept):
    store = kept()
    store.save(frame(BASE))
    slow = interleaved(spark, store, lambda: store.save(frame([(k, "theirs", p) for k, v, p in BASE if p == "p0"])))
    mine = [(k, "mine" if p == "p1" else v, p) for k, v, p in BASE]
    assert done(slow.save(frame(mine)))["p0"] == "update"
    assert content(store.read()) == sorted(mine, key=repr)


def test_more_rows_of_another_saver_are_not_shrunk_away(spark, frame, kept):
    store = kept()
    store.save(frame(BASE))
    more = frame([r for r in BASE if r[2] == "p1"] + [(100, "new", "p1")])
    slow = interleaved(spark, store, lambda: store.save(more))
    with pytest.raises(ShrinkError):
        slow.save(frame([(k, "mine", p) for k, v, p in BASE if p == "p1"]))
    assert store.read(labels=["p1"]).count() == 11 and store.log.head() == 1


def test_a_saver_that_never_comes_first_gives_up(spark, frame, kept):
    store = kept()
    store.save(frame(BASE))
    before = files(store)
    unlucky = PartitionStore(spark, store.root, "p", ["k"], put=lambda *a: False)
    with pytest.raises(ConflictError):
        unlucky.save(frame([(1, "x", "p1")]), shrink="allow", tries=2)
    assert files(store) == before


def test_states_from_checkpoints(spark, frame, kept):
    store = kept(every=2)
    for turn in range(5):
        store.save(frame([(k, f"{v}-{turn if p == f'p{turn % 4}' else ''}", p) for k, v, p in BASE]))
    assert sorted(os.listdir(f"{local(store.root)}/states")) == ["000000000002", "000000000004"]
    for number in range(5):
        want = [(k, f"{v}-{number if p == f'p{number % 4}' else ''}", p) for k, v, p in BASE]
        assert content(store.read(number)) == sorted(want, key=repr)


# --- digests and changes -------------------------------------------------------------------

def test_digests_add_up_and_ignore_order(frame):
    one = digest_tree(frame(BASE), "p", ["k"], 8)
    two = digest_tree(frame(BASE[::-1]).repartition(5).select("p", "v", "k"), "p", ["k"], 8)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    for r in one.collect():
        assert r["rows"] == sum(b["rows"] for b in r["buckets"]) and r["hash_sum"] == sum(b["hash_sum"] for b in r["buckets"])


def test_only_changed_buckets_are_compared(frame, kept):
    store = kept(buckets=8)
    many = [(i, f"v{i}", f"p{i % 3}") for i in range(900)]
    store.save(frame(many))
    store.save(frame([(k, "x" if k in (3, 4) else v, p) for k, v, p in many]))
    buckets = store.changed_buckets(0, 1)
    assert sorted(r["label"] for r in buckets.collect()) == ["p0", "p1"]
    read = store.rows_in(1, buckets)
    assert 2 <= read.count() < 150  # two of 24 buckets
    assert re.search(r"PushedFilters: \[[^\]]*_bucket", read._jdf.queryExecution().executedPlan().toString())
    assert sorted(map(tuple, changes.digest_diff(store, 0, 1).collect())) == [(3, "update"), (4, "update")]
    store.save(frame(many))
    assert store.changed_buckets(0, 2).count() == 0 and changes.digest_diff(store, 0, 2).count() == 0


def test_changes_of_repeated_and_moved_rows(frame, kept):
    store = kept()
    store.save(frame([(1, "a", "p0"), (1, "a", "p0"), (2, "b", "p0"), (3, "c", "p0"), (None, "n", "p0")]))
    store.save(frame([(1, "a", "p0"), (2, "b", "p1"), (3, "c", "p0"), (3, "d", "p0"), (None, "m", "p0")]), shrink="allow")
    found = sorted(map(tuple, changes.change_feed(store, 0, 1).select("k", "v", "p", "version", "change").collect()), key=repr)
    assert found == sorted([
        (1, "a", "p0", 1, "delete"), (2, "b", "p0", 1, "update_before"), (2, "b", "p1", 1, "update_after"),
        (3, "d", "p0", 1, "insert"), (None, "n", "p0", 1, "update_before"), (None, "m", "p0", 1, "update_after")], key=repr)
    with pytest.raises(ValueError):
        changes.change_feed(store, 1, 1)


def test_rows_that_come_and_go_have_several_intervals(frame, kept):
    store = kept()
    there, other = [(1, "a", "p0"), (2, "b", "p0")], [(2, "b", "p0"), (9, "z", "p0")]
    for rows in (there, other, there, other, there):
        store.save(frame(rows))
    history = changes.validity(store)
    spans = sorted((r["valid_from"], r["valid_to"]) for r in history.where("k = 1").collect())
    assert spans == [(0, 1), (2, 3), (4, None)]
    for number, rows in enumerate((there, other, there, other, there)):
        assert content(changes.as_of(history, number)) == rows


def test_one_partition_with_most_rows_is_spread(spark, kept):
    """A third of all rows and more in one partition: the tree takes one row per bucket and task."""
    rows = spark.range(60_000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"),
                                      F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 40)).alias("p"))
    plan = digest_tree(rows, "p", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("partial_sum") >= 1
    store = kept()
    store.save(rows)
    assert store.read().count() == 60_000
    changed = rows.withColumn("v", F.when(F.col("k") == 1, "x").otherwise(F.col("v")))
    assert done(store.save(changed))["hot"] == "update"
    assert [tuple(r) for r in changes.digest_diff(store, 0, 1).collect()] == [(1, "update")]
