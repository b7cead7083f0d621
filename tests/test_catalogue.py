"""The catalogue of landed files, overlapping intervals, and scans that read each file once."""

import datetime as dt
import os
import random
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyloom.operators.overlap import overlap_join
from tallyloom.plans.cleaning import landed_source
from tallyloom.sources import landing, scan
from tallyloom.sources.catalogue import FileCatalogue


def land(folder, values, note=True, name="data"):
    folder.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table({"k": values}), folder / f"{name}.parquet")
    if note:
        (folder / f"{name}.json").write_text('{"data_md5": "m"}')


def short(df):
    return sorted((r["path"].split("/landing/", 1)[1], r["state"]) for r in df.collect())


@pytest.fixture
def area(tmp_path):
    root = tmp_path / "landing"
    land(root / "a" / "daily" / "202401" / "05", [1])
    land(root / "a" / "daily" / "202402" / "07", [2])
    land(root / "b" / "monthly" / "202401", [3])
    land(root / "b" / "monthly" / "202403", [4], note=False)
    land(root / "b" / "quarterly" / "2024Q1", [5])
    land(root / "b" / "prices" / "200011", [6])
    land(root / "b" / "master", [7])
    return root


GRAINS = {"daily": "DAILY", "monthly": "MONTHLY", "quarterly": "QUARTERLY", "prices": "SYMBOL", "master": "SNAPSHOT"}


def test_files_with_their_grain(spark, area, tmp_path):
    kept = FileCatalogue(spark, str(tmp_path / "catalogue"), str(area), GRAINS)
    assert len(short(kept.refresh())) == 7
    rows = {r["method"] + ":" + r["period"]: r for r in kept.files().collect()}
    assert sorted(rows) == ["daily:20240105", "daily:20240207", "master:snapshot", "monthly:202401", "monthly:202403",
                            "prices:200011", "quarterly:2024Q1"]
    assert (rows["quarterly:2024Q1"]["period_start"], rows["quarterly:2024Q1"]["period_end"]) == (dt.date(2024, 1, 1), dt.date(2024, 3, 31))
    assert rows["prices:200011"]["period_start"] is None and rows["prices:200011"]["source"] == "b"
    assert sorted(map(tuple, kept.landed().collect())) == [
        ("daily", "20240105"), ("daily", "20240207"), ("master", "snapshot"), ("monthly", "202401"), ("prices", "200011"),
        ("quarterly", "2024Q1")]  # 202403 has no sidecar yet
    assert ("prices", "200011") not in set(map(tuple, kept.periods().collect()))
    files = landing.landed_files(spark, str(area), "prices", grain="SYMBOL")
    assert landing.available_periods(files).collect() == []
    guessed = landing.landed_files(spark, str(area), "prices")
    assert [r["period"] for r in landing.available_periods(guessed).collect()] == ["200011"]


def test_refresh_tells_the_difference(spark, area, tmp_path):
    kept = FileCatalogue(spark, str(tmp_path / "catalogue"), str(area), GRAINS)
    kept.refresh()
    assert kept.refresh().collect() == [] and kept.store.log.head() == 0
    land(area / "a" / "daily" / "202402" / "08", [9])
    shutil.rmtree(area / "b" / "quarterly")
    os.utime(area / "b" / "monthly" / "202401" / "data.parquet", (1e9, 1e9))
    (area / "b" / "monthly" / "202403" / "data.json").write_text("{}")  # the sidecar arrives
    assert short(kept.refresh()) == [
        ("a/daily/202402/08/data.parquet", "new"), ("b/monthly/202401/data.parquet", "changed"),
        ("b/monthly/202403/data.parquet", "changed"), ("b/quarterly/2024Q1/data.parquet", "gone")]
    assert {r["method"] for r in kept.files(0).collect()} - {r["method"] for r in kept.files().collect()} == {"quarterly"}
    methods = [r["label"] for r in kept.store.state().where("number = 1").collect()]
    assert sorted(methods) == ["daily", "monthly"]  # others were not written again


def test_an_area_out_of_reach_is_refused(spark, area, tmp_path):
    kept = FileCatalogue(spark, str(tmp_path / "catalogue"), str(area), GRAINS)
    kept.refresh()
    shutil.rmtree(area)
    with pytest.raises(ValueError, match="no rows"):
        kept.refresh()
    assert kept.files().count() == 7


def test_requests_meet_their_files(spark, area, tmp_path):
    kept = FileCatalogue(spark, str(tmp_path / "catalogue"), str(area), GRAINS)
    kept.refresh()
    asked = spark.createDataFrame([
        ("r1", "daily", dt.date(2024, 1, 1), dt.date(2024, 2, 7)), ("r2", "monthly", dt.date(2023, 1, 1), dt.date(2030, 1, 1)),
        ("r3", "quarterly", dt.date(2024, 3, 31), dt.date(2024, 3, 31)), ("r4", "prices", dt.date(2000, 1, 1), dt.date(2030, 1, 1)),
        ("r5", "daily", dt.date(2024, 2, 1), dt.date(2024, 1, 1))], "id string, method string, start_day date, end_day date")
    got = sorted((r["id"], r["period"]) for r in kept.files_for(asked).collect())
    assert got == [("r1", "20240105"), ("r1", "20240207"), ("r2", "202401"), ("r2", "202403"), ("r3", "2024Q1")]


def test_overlaps_agree_with_all_pairs(spark):
    draw = random.Random(6)

    def spans(count, tag):
        out = []
        for i in range(count):
            first = draw.choice([None, dt.date(2019, 1, 1) + dt.timedelta(draw.randrange(1500))])
            last = None if first is None or draw.random() < 0.05 else first + dt.timedelta(draw.choice([-3, 0, 5, 40, 900]))
            out.append((draw.choice(["HOT", "HOT", "HOT", "x", None]), f"{tag}{i}", first, last))
        return out
    left, right = spans(120, "l"), spans(80, "r")
    a = spark.createDataFrame(left, "k string, a string, af date, al date")
    b = spark.createDataFrame(right, "k string, b string, bf date, bl date")
    joined = overlap_join(a, b, ["k"], ("af", "al"), ("bf", "bl"))
    assert joined.columns == ["k", "a", "af", "al", "b", "bf", "bl"]
    want = sorted((x[1], y[1]) for x in left for y in right
                  if None not in (*x, *y) and x[0] == y[0] and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and y[2] <= x[3])
    assert want and sorted((r["a"], r["b"]) for r in joined.collect()) == want
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError, match="both sides"):
        overlap_join(a, a, ["k"], ("af", "al"), ("af", "al"))


def test_files_outside_the_period_are_not_opened(spark, area):
    """A broken file of another period stops nothing, although nothing is skipped."""
    (area / "b" / "monthly" / "202401" / "data.parquet").write_text("broken")
    where = landing.period_patterns(str(area), "monthly", "20240301", "20240315")
    assert [r["k"] for r in scan.landing_scan(spark, where).collect()] == [4]
    assert landing.period_patterns(str(area), "monthly", "20240301", "20240201") == []
    none = landed_source(spark, str(area), "monthly", "20250101", "20250201")
    assert none.count() == 0 and landed_source(spark, str(area), "monthly", "2025", "20250201").count() == 0
    days = landed_source(spark, str(area), "daily", "20240201", "20240207")
    assert [r["k"] for r in days.collect()] == [2]  # the day's folder lies below its month


def test_each_file_is_read_once(spark, area, monkeypatch):
    """The table that a tolerant scan leaves is what all later steps read."""
    tables = []
    kept = scan.as_table
    monkeypatch.setattr(scan, "as_table", lambda df, label: tables.append(label) or kept(df, label))
    rows = landed_source(spark, str(area), "daily")
    assert tables == ["landed-rows", "unreadable-files"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "landed-rows" in plan
    assert sorted(r["k"] for r in rows.collect()) == [1, 2]


def test_files_without_rows_are_reported(spark, tmp_path):
    pq.write_table(pa.table({"k": [1]}), tmp_path / "one.parquet")
    pq.write_table(pa.table({"k": pa.array([], pa.int64())}), tmp_path / "none.parquet")
    listed = []
    rows = scan.landing_scan(spark, [str(tmp_path)], unreadable="skip", report=listed.append)
    assert rows.count() == 1 and [r["path"].rsplit("/", 1)[1] for r in listed[0].collect()] == ["none.parquet"]
    assert scan.landing_scan(spark, [str(tmp_path / "no")], unreadable="skip").count() == 0


def test_only_broken_files(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("nothing")
    listed = []
    rows = scan.landing_scan(spark, [str(tmp_path)], unreadable="skip", report=listed.append)
    assert rows.count() == 0 and rows.columns == ["file_path", "file_md5"] and listed[0].count() == 1
