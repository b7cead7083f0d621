"""Snapshots, layout, landing and files."""

import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyloom.plans import processors
from tallyloom.plans.cleaning import clean_and_save, clean_method, landed_source
from tallyloom.plans.steps import cleaning_registry
from tallyloom.quality.gates import DuplicateKeyError
from tallyloom.quality.reconcile import ReconcileError
from tallyloom.sinks import writers
from tallyloom.sinks.layout import request_errors, with_layout
from tallyloom.sinks.snapshot import ShrinkError, SnapshotStore, fingerprint
from tallyloom.sources import landing, scan


@pytest.fixture
def master(spark):
    return spark.createDataFrame([(f"{i:06d}.SZ", f"name{i}", float(i)) for i in range(100)],
                                 "ts_code string, name string, v double")


def test_snapshot_life(spark, master, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.latest("m") is None and store.read("m") is None
    assert store.save(master, "m").method == "new"
    assert store.save(master.repartition(7), "m").method == "skip"
    changed = master.withColumn("v", F.col("v") + 1)
    done = store.save(changed, "m")
    assert done.method == "update" and store.read("m").agg(F.sum("v")).first()[0] == 5050.0
    row = store.latest("m")
    assert row.previous_rows == 100 and row.previous_version and row.rows == 100
    assert sorted(r.superseded for r in store.versions("m").collect()) == [False, True]
    assert store.save(changed, "m", force=True).method == "update"


def test_snapshot_refusals(spark, master, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no rows"):
        store.save(master.limit(0), "m")
    store.save(master, "m")
    half = master.where("v < 50")
    with pytest.raises(ShrinkError):
        store.save(half, "m")
    with pytest.raises(ShrinkError):
        store.save(half, "m", shrink="verify")
    with pytest.raises(ShrinkError):
        store.save(half, "m", shrink="verify", second=lambda: master.where("v < 40"))
    with pytest.raises(ValueError, match="shrink must be"):
        store.save(half, "m", shrink="maybe")
    assert store.latest("m").rows == 100
    assert store.save(half, "m", shrink="verify", second=lambda: half.repartition(3)).rows == 50
    assert store.save(master.where("v < 10"), "m", shrink="allow").rows == 10


def test_fingerprint(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (2, 2)], "a int, b int")
    mark = fingerprint(df).first()
    assert fingerprint(df.orderBy(F.rand(1)).repartition(3)).first() == mark
    swapped = spark.createDataFrame([(None, 1), (1, 1), (2, 2)], "a int, b int")
    assert fingerprint(swapped).first() != mark
    assert fingerprint(df.union(df)).first() != mark


def test_processor_publishes_only_what_passes(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    good = [(f"{i:06d}.SH", 20240331, 20240401, "20240401", "1", "1", 10.0, 4.0, 6.0)
            for i in range(50)]
    schema = ("ts_code string, end_date int, f_ann_date int, ann_date string, update_flag string, "
              "comp_type string, total double, a double, b double")
    section = {"total": {"renamed_field": "total_assets", "relationship": "1", "report_item": "t"},
               "a": {"renamed_field": "cash", "relationship": "1_1"},
               "b": {"renamed_field": "other", "relationship": "1_1"}}
    done = processors.run(spark.createDataFrame(good, schema), "balance_sheet", store, "bs", section)
    assert done.method == "new"
    assert "total_assets" in store.read("bs").columns
    twice = good + [good[0][:6] + (11.0, 5.0, 6.0)] * 2
    with pytest.raises(DuplicateKeyError):
        processors.run(spark.createDataFrame(twice, schema), "balance_sheet", store, "bs", section,
                       rejects_root=str(tmp_path), run_id="r")
    assert spark.read.parquet(f"{tmp_path}/rejects/r").count() == 3
    off = [g[:6] + (90000.0, 1.0, 1.0) for g in good]
    with pytest.raises(ReconcileError, match="group 1"):
        processors.run(spark.createDataFrame(off, schema), "balance_sheet", store, "bs", section)
    assert store.latest("bs").rows == 50 and store.manifest().count() == 1


@pytest.mark.parametrize("grain, date, symbol, errors, period", [
    ("SNAPSHOT", None, None, [], "snapshot"),
    ("DAILY", "20241231", None, [], "20241231"),
    ("daily", "20241231", None, [], "20241231"),
    ("MONTHLY", "202412", None, [], "202412"),
    ("MONTHLY", "20241231", None, [], "202412"),
    ("QUARTERLY", "20240630", None, [], "2024Q2"),
    ("SYMBOL", None, "SH600519", [], "SH600519"),
    ("SYMBOL", None, "600519.BJ", [], "600519.BJ"),
    ("SYMBOL", None, "600519", [], "600519"),
    ("DAILY", None, None, ["date_missing"], None),
    ("DAILY", "202412", None, ["date_not_yyyymmdd"], None),
    ("MONTHLY", "2024", None, ["date_not_yyyymm"], None),
    ("QUARTERLY", "20240401", None, ["date_not_quarter_end"], None),
    ("SYMBOL", None, "", ["symbol_missing"], None),
    ("SYMBOL", None, "XX600519", ["symbol_format"], None),
    ("HOURLY", "20241231", None, ["unknown_grain"], None),
    (None, "20241231", None, ["unknown_grain"], None),
])
def test_layout(spark, grain, date, symbol, errors, period):
    df = spark.createDataFrame([(grain, date, symbol)], "g string, d string, s string")
    row = with_layout(df, "g", "d", "s").first()
    assert (row.errors, row.period) == (errors, period)
    assert df.select(request_errors(F.col("g"), F.col("d"), F.col("s"))).first()[0] == errors


def land(folder, table, digest="x"):
    folder.mkdir(parents=True)
    pq.write_table(table, folder / "data.parquet")
    if digest:
        (folder / "data.json").write_text(json.dumps({"data_md5": digest, "rows": 1}, indent=1))


def test_landing(spark, tmp_path, rows):
    root = tmp_path / "landing"
    land(root / "a" / "m" / "202401" / "05", pa.table({"k": ["1"], "v": [1.0]}), "d1")
    land(root / "a" / "m" / "202402", pa.table({"k": ["2"], "w": ["x"]}), "d2")
    land(root / "b" / "m" / "2024Q3", pa.table({"k": ["3"], "v": [3.0]}), "d3")
    land(root / "b" / "m" / "snapshot", pa.table({"k": ["4"], "v": [4.0]}), "d4")
    land(root / "b" / "m" / "2023", pa.table({"k": ["5"], "v": [5.0]}), None)
    files = landing.landed_files(spark, str(root), "m")
    assert files.count() == 4
    assert [r.period for r in landing.available_periods(files).collect()] == [
        "20240105", "202402", "2024Q3"]
    def periods(start, end):
        return sorted(r.period for r in landing.in_range(files, start, end).collect())
    assert periods("20240105", "20240210") == ["20240105", "202402"]
    assert periods("20240930", "20241231") == ["2024Q3"]
    assert periods("bad", "20241231") == []
    assert landing.first_files(files, 2).count() == 2
    got = landed_source(spark, str(root), "m")
    assert rows(got, "k", "v", "w", "file_md5") == sorted(
        [("1", 1.0, None, "d1"), ("2", None, "x", "d2"), ("3", 3.0, None, "d3"),
         ("4", 4.0, None, "d4")], key=repr)
    cleaned = clean_method(spark, str(root), "m",
                           [{"function": "extract_end_date_from_path"},
                            {"function": "filter_data", "field_name": "end_date",
                             "condition": "notna"}], cleaning_registry())
    assert rows(cleaned, "k", "end_date") == [("3", "20240930")]
    assert landed_source(spark, str(root), "absent").count() == 0
    saved = str(tmp_path / "saved")
    assert clean_and_save(spark, str(root), "m", [], cleaning_registry(), saved, "csv",
                          "20240101", "20240229") == 2
    with pytest.raises(ValueError):
        clean_and_save(spark, str(root), "m", [], cleaning_registry(), saved, "xlsx")


def test_steps_see_rows_in_landed_order(spark, tmp_path, rows):
    root = tmp_path / "landing"
    land(root / "a" / "m" / "202401", pa.table({"k": ["x", "x", "y"], "v": [1.0, None, None]}))
    land(root / "a" / "m" / "202402", pa.table({"k": ["x", "z", "z"], "v": [None, 5.0, 5.0]}))
    def run(*steps):
        return clean_method(spark, str(root), "m", steps, cleaning_registry())
    filled = run({"function": "fill_na", "field_name": "v", "method": "ffill"})
    assert rows(filled, "k", "v") == [("x", 1.0), ("x", 1.0), ("x", 1.0), ("y", 1.0), ("z", 5.0),
                                      ("z", 5.0)]
    first = run({"function": "drop_duplicates", "subset": ["k"]})
    assert rows(first, "k", "v") == sorted([("x", 1.0), ("y", None), ("z", 5.0)], key=repr)
    assert run({"function": "drop_duplicates"}).count() == 5
    assert "file_row" not in first.columns


def test_scan_with_type_drift_and_bad_files(spark, tmp_path, rows):
    for i, value in enumerate(([1.5], ["n/a"], [2])):
        pq.write_table(pa.table({"k": [str(i)], "v": value}), tmp_path / f"f{i}.parquet")
    paths = [str(tmp_path / f"f{i}.parquet") for i in range(3)]
    text = scan.landing_scan(spark, [f"file://{p}" for p in paths])
    assert rows(text, "k", "v") == [("0", "1.5"), ("1", "n/a"), ("2", "2")]
    typed = scan.landing_scan(spark, [f"file://{p}" for p in paths],
                              expected=spark.createDataFrame([], "v double").schema)
    assert rows(typed, "k", "v") == [("0", 1.5), ("1", None), ("2", 2.0)]
    (tmp_path / "bad.parquet").write_text("not parquet")
    whole = pa.table({"k": [str(i) for i in range(50_000)], "v": [f"{i * 7919}" for i in range(50_000)]})
    pq.write_table(whole, tmp_path / "half.parquet", row_group_size=5000)
    content = bytearray((tmp_path / "half.parquet").read_bytes())
    content[len(content) // 2:len(content) // 2 + 2000] = b"x" * 2000
    (tmp_path / "half.parquet").write_bytes(bytes(content))
    broken = [str(tmp_path / f"{name}.parquet") for name in ("bad", "half")]
    with pytest.raises(Exception):
        scan.landing_scan(spark, [paths[1], broken[1]]).collect()
    listed = []
    some = scan.landing_scan(spark, [paths[0], *broken], unreadable="skip", report=listed.append)
    assert rows(some, "k") == [("0",)]  # a broken file is left out whole
    assert sorted(r[0].removeprefix("file:") for r in rows(listed[0], "path")) == sorted(broken)
    errors = dict((p.rsplit("/", 1)[1], e) for p, e in rows(listed[0], "path", "error"))
    assert errors["bad.parquet"].startswith("no rows") and errors["half.parquet"].endswith("of 50000 rows")
    assert scan.landing_scan(spark, []).columns == ["file_path", "file_md5"]


def test_missing_tables(spark, tmp_path):
    schema = spark.createDataFrame([], "a int").schema
    assert scan.read_table(spark, str(tmp_path / "no"), schema, strict=False).count() == 0
    assert scan.read_csv(spark, str(tmp_path / "no"), "a int", strict=False).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan.read_table(spark, str(tmp_path / "no"))
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(path)
    wanted = spark.createDataFrame([], "a bigint, c string").schema
    assert scan.read_table(spark, path, wanted).first().asDict() == {"a": 1, "c": None}
    spark.sql("select double('NaN') as v union all select 1.0D").write.parquet(path + "2")
    clean = scan.read_table(spark, path + "2", spark.createDataFrame([], "v double").schema)
    assert clean.where("v is null").count() == 1 and clean.where("v > 0").count() == 1
    with pytest.raises(TypeError):
        scan.read_table(spark, path, spark.createDataFrame([], "b double").schema)


def test_per_entity_files_keep_order(spark, tmp_path):
    hot = spark.range(5000).selectExpr(
        "case when id % 3 = 0 then '000001' else lpad(cast(id % 40 as string), 6, '0') end as symbol",
        "date_add(date'2000-01-01', cast(id as int)) as date", "cast(id as double) as v")
    path = str(tmp_path / "feed")
    assert writers.write_per_entity(hot, path, "symbol", "date") == 40
    back = writers.read_per_entity(spark, path, "date date, v double, symbol string")
    assert back.exceptAll(hot.select("date", "v", "symbol")).count() == 0 and back.count() == 5000
    # Files of the hot entity, read in name order, are in date order.
    lines = []
    for file in sorted((tmp_path / "feed" / "symbol=000001").glob("part-*.csv")):
        lines += file.read_text().splitlines()[1:]
    assert lines == sorted(lines) and len(lines) > 1000


def test_formats(spark, tmp_path):
    df = spark.createDataFrame([("000001", 1.5)], "code string, v double")
    assert writers.write_cleaned(df, str(tmp_path / "p")) == 1
    with pytest.raises(ValueError):
        writers.write_cleaned(df, str(tmp_path / "x"), "xlsx")
    path = writers.write_norm_csv(df, str(tmp_path), "quotes", ["code"], source="v",
                                  decisions=df.selectExpr("code", "'kept' as decision"))
    assert scan.read_csv(spark, path, "code string, v double").first().code == "000001"
    note = json.loads(spark.read.text(f"{tmp_path}/norm/quotes/v_quotes_schema").first().value)
    assert note == {"columns": {"code": "string", "v": "double"}, "primary_keys": ["code"], "rows": 1}
    assert spark.read.json(f"{tmp_path}/norm/quotes/v_quotes_decisions").count() == 1
    assert writers.read_back(spark, str(tmp_path / "p"), df).first().same_schema


def test_range_prunes_partitions(spark, tmp_path):
    from tallyloom.sinks.layout import write_partitioned
    days = spark.range(730).selectExpr(
        "id", "date_format(date_add(date'2023-01-01', cast(id as int)), 'yyyyMMdd') as day")
    path = str(tmp_path / "t")
    write_partitioned(days, path, F.lit("monthly"), F.col("day"))
    part = landing.read_layout(spark, path, "20240215", "20240301")
    assert part.count() == 60
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [", 1)[1][:300]
    assert "period" in filters


def test_computed_plan_is_written_once(spark, master, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.save_computed(master, "m").method == "new"
    assert store.save_computed(master.repartition(3), "m").method == "skip"
    with pytest.raises(ShrinkError):
        store.save_computed(master.limit(10), "m")
    assert store.manifest().count() == 1 and store.read("m").count() == 100
