"""What is refused: repeated periods, stale savers, missing keys; and dates with slashes."""

import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.operators import derived, filters, resolve, spine
from tallyloom.plans import processors
from tallyloom.session import scratch_path
from tallyloom.sinks import snapshot
from tallyloom.sinks.commits import put_if_absent
from tallyloom.sinks.snapshot import SnapshotStore, StaleError

CUMULATIVE = "code string, y int, q int, v double"


@pytest.mark.parametrize("metric", [
    lambda df: derived.single_quarter(df, "code", "y", "q", "v", "sq"),
    lambda df: derived.trailing_year(df, "code", "y", "q", "v", "ttm"),
    lambda df: derived.growth(df, "code", "y", "q", "v", "yoy", 4),
    lambda df: derived.growth(df, "code", "y", "q", "v", "qoq", 1)])
def test_a_repeated_period_stops_the_job_and_is_named(spark, metric):
    good = spark.createDataFrame([("a", 2020, q, float(q)) for q in range(1, 5)], CUMULATIVE)
    assert metric(good).count() == 4
    twice = good.union(spark.createDataFrame([("a", 2020, 3, 9.0)], CUMULATIVE))
    with pytest.raises(PySparkException, match="repeated period: a 2020 3"):
        metric(twice).collect()


def test_slashes_in_days_are_read(spark):
    rows = [("a", 1, 1, "2020/05/01", "1"), ("a", 1, 1, "2020/05/02", "1"), ("b", 1, 1, "2020-05-01", "1"), ("b", 1, 1, "20200502", "1")]
    df = spark.createDataFrame(rows, "ts_code string, end_date int, f_ann_date int, ann_date string, update_flag string")
    assert sorted((r["ts_code"], r["ann_date"]) for r in resolve.resolve_11(df).collect()) == [("a", "2020/05/02"), ("b", "20200502")]


def test_a_missing_key_column_is_refused(spark):
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    rows = spark.createDataFrame([("600519.SH", 1.0)], "ts_code string, factor double")
    with pytest.raises(ValueError, match="trade_date"):
        processors.run(rows, "adj_factor", store, "adj")
    assert store.manifest().count() == 0


def interleaved(spark, store, meanwhile):
    calls = []

    def put(session, path, text):
        if not calls:
            calls.append(path)
            meanwhile()
        return put_if_absent(session, path, text)
    other = SnapshotStore(spark, store.root)
    other.log.put = put
    return other


def test_of_two_savers_of_a_dataset_one_is_told(spark):
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    store.save(spark.range(10), "d")
    slow = interleaved(spark, store, lambda: store.save(spark.range(20), "d"))
    with pytest.raises(StaleError):
        slow.save(spark.range(30), "d")
    assert store.read("d").count() == 20 and store.manifest().count() == 2


def test_savers_of_different_datasets_both_publish(spark):
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    slow = interleaved(spark, store, lambda: store.save(spark.range(20), "other"))
    assert slow.save(spark.range(30), "mine").method == "new"
    assert (store.read("mine").count(), store.read("other").count()) == (30, 20)


def test_many_savers_at_once_publish_one_first_version(spark):
    store, told = SnapshotStore(spark, scratch_path(spark, "store")), []

    def save(n):
        try:
            SnapshotStore(spark, store.root).save(spark.range(n), "d")
        except (StaleError, snapshot.ShrinkError) as error:
            told.append(error)
    threads = [threading.Thread(target=save, args=(n,)) for n in (10, 11, 12, 13)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    firsts = store.manifest().where(F.col("previous_version").isNull()).count()
    assert firsts == 1 and store.manifest().count() + len(told) == 4


def test_an_error_after_the_commit_does_not_delete_the_version(spark, monkeypatch):
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    made = store.log.append

    def late(entry, after):
        made(entry, after)
        raise OSError("the answer was lost")
    monkeypatch.setattr(store.log, "append", late)
    with pytest.raises(OSError):
        store.save(spark.range(5), "d")
    assert SnapshotStore(spark, store.root).read("d").count() == 5


def test_a_calendar_without_bounds_is_refused(spark):
    days = [("20240101", 1), ("20240102", 0), ("20240103", 1)]
    good = spark.createDataFrame(days, "cal_date string, is_open int")
    assert spine.calendar_index(good).count() == 3
    assert spine.calendar_index(good.limit(0)).count() == 0
    with pytest.raises(PySparkException, match="calendar spans too many days: 2024-01-01 9999-12-31"):
        spine.calendar_index(good.union(spark.createDataFrame([("99991231", 1)], good.schema)))


def test_text_is_compared_as_numbers(spark):
    df = spark.createDataFrame([("10",), ("9",), ("x",), ("",), (None,), ("1e1",)], "v string")
    assert [r.v for r in filters.matching(df, "v", ">9").collect()] == ["10", "1e1"]
    assert [r.v for r in filters.matching(df, "v", "<=9").collect()] == ["9"]
