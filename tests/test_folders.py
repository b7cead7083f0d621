"""Many small folders: the same files as Spark's own writer, replaced whole, whatever is retried."""

import datetime as dt
import os

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from catalog import QUERIES
from tallyloom.sinks import folders, layout, writers
from tallyloom.sources.landing import read_layout

ROWS = [("a", dt.date(2024, 1, 1), 1.0, 'say "x", y\n z', True), ("a", dt.date(2024, 1, 2), 1e20, "", None),
        ("b=/%'é", None, float("nan"), " kept? ", False), ("", dt.date(1500, 2, 3), -0.0, None, True),
        (None, dt.date(2024, 1, 3), 1e-7, "\\", None), ("000001", None, None, None, None)]
SCHEMA = "symbol string, day date, v double, `te,xt` string, f boolean"


def sorted_rows(spark, data=ROWS):
    return spark.createDataFrame(data, SCHEMA).repartition(1).sortWithinPartitions("symbol", "day")


def lines(root):
    """Per folder its lines; the two empty names share a folder, so its files count together."""
    found = {}
    for folder, _, names in os.walk(root):
        for name in sorted(n for n in names if n.endswith(".csv")):
            found.setdefault(os.path.relpath(folder, root), set()).update(open(f"{folder}/{name}", "rb").read().split(b"\n"))
    return found


def test_same_bytes_as_spark_writes(spark, tmp_path):
    rows = sorted_rows(spark)
    layout.write_partitions(rows, str(tmp_path / "spark"), ["symbol"], "csv", header=True)
    layout.write_partitions(rows, str(tmp_path / "own"), ["symbol"], "csv", many=True, header=True)
    assert lines(tmp_path / "own") == lines(tmp_path / "spark") and len(lines(tmp_path / "own")) == 4
    assert (tmp_path / "own" / "_SUCCESS").exists() and not [n for n in os.listdir(tmp_path / "own") if n.startswith(".")]
    # Hadoop's writer leaves a checksum beside each file, and starts a process for either.
    assert [n for _, _, names in os.walk(tmp_path / "spark") for n in names if n.endswith(".csv.crc")]
    assert not [n for _, _, names in os.walk(tmp_path / "own") for n in names if n.endswith(".crc")]


def test_same_rows_from_parquet(spark, tmp_path):
    rows = sorted_rows(spark).withColumns({
        "n": F.lit(3).cast("decimal(20,3)"), "at": F.lit(dt.datetime(1900, 1, 1, 1, 2, 3, 4)), "b": F.lit(b"\x00x"),
        "plain": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "s": F.lit(1).cast("smallint")})
    for name, many in (("spark", False), ("own", True)):
        layout.write_partitions(rows, str(tmp_path / name), ["symbol"], many=many)
    own, theirs = (spark.read.parquet(str(tmp_path / n)) for n in ("own", "spark"))
    assert own.schema == theirs.schema
    assert sorted(map(repr, own.collect())) == sorted(map(repr, theirs.collect())) and own.count() == 6


@pytest.mark.parametrize("replace", ["partitions", "all"])
def test_folders_are_replaced_whole(spark, tmp_path, replace):
    root = str(tmp_path / "t")
    layout.write_partitions(sorted_rows(spark), root, ["symbol"], "csv", header=True)  # files of Spark's own writer
    fewer = sorted_rows(spark, ROWS[1:2])
    for _ in range(2):
        layout.write_partitions(fewer, root, ["symbol"], "csv", replace, many=True, header=True)
    assert sorted(n for n in os.listdir(root) if "=" in n) == (["symbol=a"] if replace == "all" else sorted(lines(root)))
    assert [n for n in os.listdir(f"{root}/symbol=a") if n.endswith(".crc")] == [] and len(os.listdir(f"{root}/symbol=a")) == 1
    back = spark.read.schema(SCHEMA).option("header", True).csv(root)
    assert back.where("symbol = 'a'").count() == 1


def test_a_step_that_runs_again_changes_nothing(spark, tmp_path):
    import pyarrow as pa
    root, staging = str(tmp_path / "t"), str(tmp_path / "t" / ".staging-r1")
    os.makedirs(f"{staging}/t0")
    os.makedirs(f"{root}/k=1")
    for name in (f"{root}/k=1/part-old.csv", f"{staging}/t0/part-00000-r1.c0.csv"):
        with open(name, "w") as file:
            file.write(name)
    listed = pa.RecordBatch.from_pylist([{"folder": "k=1", "staged": "t0/part-00000-r1.c0.csv", "name": "part-00000-r1.c0.csv"}])
    for _ in range(2):
        assert [b.to_pylist() for b in folders._publisher(root, staging, "r1")([listed])] == [[{"n": 1}]]
        assert os.listdir(f"{root}/k=1") == ["part-00000-r1.c0.csv"]
    lost = listed.set_column(2, "name", pa.array(["part-00000-r1.c1.csv"]))
    with pytest.raises(FileNotFoundError):
        list(folders._publisher(root, staging, "r1")([lost]))


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    root = str(tmp_path / "t")
    layout.write_partitions(sorted_rows(spark), root, ["symbol"], "csv", many=True, header=True)
    before = lines(root)
    bad = sorted_rows(spark).withColumn("v", F.when(F.col("symbol") == "b=/%'é", F.raise_error(F.lit("no")).cast("double")))
    with pytest.raises(Exception, match="no"):
        layout.write_partitions(bad, root, ["symbol"], "csv", many=True, header=True)
    assert lines(root) == before and not [n for n in os.listdir(root) if n.startswith(".")]


def test_names_of_digits_stay_apart(spark, tmp_path):
    """Counted by folder: 1 and 000001 are two entities."""
    feed = spark.createDataFrame([("1", "2024-01-01"), ("000001", "2024-01-01")], "symbol string, date string").selectExpr(
        "symbol", "date", "1 as v")
    assert writers.write_per_entity(feed, str(tmp_path / "f"), "symbol", "date") == 2


def test_symbols_are_written_by_every_task(spark, tmp_path):
    """A folder per symbol is work per folder: its ranges are not merged by size. A symbol with most rows is spread."""
    path = str(tmp_path / "t")
    rows = spark.range(4000).selectExpr("id", "lpad(if(id % 2 = 0, 7, id), 6, '0') as symbol")
    layout.write_partitioned(rows, path, F.lit("SYMBOL"), F.lit(None).cast("string"), F.col("symbol"))
    assert read_layout(spark, path).exceptAll(read_layout(spark, path, many=True)).count() == 0
    back = read_layout(spark, path, many=True)
    assert back.columns == ["id", "symbol", "grain", "period"] and back.where("period <> symbol").count() == 0
    assert back.count() == 4000 and back.select("period").distinct().count() == 2000
    tasks = back.select(F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).alias("task"), "period").distinct()
    assert tasks.select("task").distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tasks.where("period = '000007'").count() > 1


def test_values_come_from_the_folder_names(spark, tmp_path):
    """Very many folders are read as files: Spark's finding of partitions is quadratic in their number."""
    odd = ["0012", "a/b=c%20 d+e", "é:[x]{y}", "50%", " sp ", "", None]
    rows = spark.createDataFrame([(s, i) for i, s in enumerate(odd)], "symbol string, v int").repartition(1).sortWithinPartitions("symbol")
    for name, many in (("spark", False), ("own", True)):
        layout.write_partitions(rows, str(tmp_path / name), ["symbol"], "csv", many=many, header=True)
        back = writers.read_per_entity(spark, str(tmp_path / name), "v int, symbol string")
        assert sorted((r.v, r.symbol) for r in back.collect()) == [(i, s or None) for i, s in enumerate(odd)]
        assert "PartitionFilters: []" in back._jdf.queryExecution().executedPlan().toString()


def read_both(monkeypatch, read):
    """What Spark's reader and the tasks return, as sorted rows; a table counts as one of many files for the latter."""
    found = []
    for few in (10_000, 0):
        monkeypatch.setattr(folders, "FEW_FILES", few)
        back = read()
        tree = back._jdf.queryExecution().executedPlan().toString()
        assert ("MapInArrow" in tree) == (few == 0)
        # Spark's reader lists every file of what it scans in the driver: here only the list of files is left.
        assert (few == 0) == ("Location: InMemoryFileIndex(1 paths)" in tree and "listed-files" in tree)
        found.append((back.schema.simpleString(), sorted(map(repr, back.collect()))))
    return found


CSV_BYTES = ("﻿\n v,d,te\r\n1.5,2024-01-01,a\r\n\n  \n\x01\n,,\n\"x,2024-01-02,b\n2.5,bad,\"q \"\"r, s\"\n-0.0,2024-01-03\r"
             "9,2024-01-04,\"two\nlines\",more\nNaN,,\"\"\n1e3,2024-01-05, é\x0b~").encode() + b"\xff\n3,2024-01-06, kept "


def test_tasks_read_text_as_spark_does(spark, tmp_path, monkeypatch):
    """the files of very many folders are listed and read by tasks."""
    for folder, data in (("symbol=000001", CSV_BYTES), ("symbol=a%2Fb+c%2520 é", b"v,d,te\n1,2024-01-01,x"),
                         ("symbol=__HIVE_DEFAULT_PARTITION__", b"\n\nv,d,te"), ("symbol=e", b""), ("symbol=n/deep/er", b"h\n7,,\n"),
                         ("_hidden", b"h\n8,,"), ("_odd=1/symbol=u", b"h\n9,,")):
        os.makedirs(tmp_path / "t" / folder)
        for name in ("part-0.csv", ".part-0.csv.crc", "_SUCCESS"):
            (tmp_path / "t" / folder / name).write_bytes(data)
    schema = "te string, symbol string, v double, d date"
    theirs, own = read_both(monkeypatch, lambda: writers.read_per_entity(spark, str(tmp_path / "t"), schema))
    assert own == theirs and len(own[1]) == 13
    assert folders.count_folders(spark, str(tmp_path / "t"), ".csv") == 4
    placed = writers.read_per_entity(spark, str(tmp_path / "t"), schema, places=True).where("symbol = '000001'")
    assert sorted((r.file, r.line) for r in placed.collect()) == [("part-0.csv", i) for i in range(10)]


def test_tasks_read_parquet_as_spark_does(spark, tmp_path, monkeypatch):
    """all types that a folder's file may hold, files with fewer columns and files of narrower types."""
    rows = sorted_rows(spark).withColumns({
        "n": F.lit(3).cast("decimal(20,3)"), "at": F.lit(dt.datetime(1900, 1, 1, 1, 2, 3, 4)), "b": F.lit(b"\x00x"),
        "plain": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "s": F.lit(1).cast("smallint"), "w": F.col("v") * 2,
        "grain": F.lit("SYMBOL"), "period": F.col("symbol")})
    by = ["grain", "period"]
    for name, many in (("spark", False), ("own", True)):
        root = str(tmp_path / name)
        layout.write_partitions(rows, root, by, many=many)
        rows.selectExpr("symbol", "cast(7 as float) as v", "'z' as grain", "'a=b' as period").coalesce(1).write.partitionBy(
            *by).mode("append").parquet(root)
        theirs, own = read_both(monkeypatch, lambda: read_layout(spark, root, many=True))
        assert own == theirs and len(own[1]) == 12
    text = rows.selectExpr("'x' as v", "'zz' as grain", "'c' as period")
    text.write.partitionBy(*by).mode("append").parquet(root)
    with pytest.raises(Exception, match="v is string, not double"):
        read_layout(spark, root, many=True).collect()


def test_a_large_file_is_read_in_pieces(spark, tmp_path, monkeypatch):
    """Batches of tasks hold some thousand rows, however long a file is."""
    rows = spark.range(200_000).selectExpr("id", "repeat('x', 20) as pad", "'SYMBOL' as grain", "if(id < 3, 'b', 'a') as period")
    layout.write_partitions(rows.coalesce(1).sortWithinPartitions("period", "id"), str(tmp_path / "p"), ["grain", "period"], many=True)
    layout.write_partitions(rows.drop("grain").coalesce(1).sortWithinPartitions("period", "id"), str(tmp_path / "c"), ["period"], "csv",
                            many=True, header=True)
    monkeypatch.setattr(folders, "FEW_FILES", 0)
    for back in (read_layout(spark, str(tmp_path / "p"), many=True),
                 writers.read_per_entity(spark, str(tmp_path / "c"), "id long, pad string, period string", ["period"])):
        total = back.groupBy("period").agg(F.count("*"), F.sum("id"), F.min(F.length("pad"))).orderBy("period").collect()
        assert [tuple(r) for r in total] == [("a", 199_997, 199_999 * 100_000 - 3, 20), ("b", 3, 3, 20)]
    batches = list(folders._text_reader(str(tmp_path / "c"), ["period"], True)(
        folders.list_files(spark, str(tmp_path / "c"), 1).toArrow().to_batches()))
    assert max(b.num_rows for b in batches) < 60_000 and sum(b.num_rows for b in batches) == 200_000


@pytest.mark.parametrize("name", ["layout_symbols", "pit_feed_job", "feed_order", "per_entity_feed", "entity_append"])
def test_queries_of_many_folders(spark, rows, monkeypatch, name):
    """The same rows whoever reads the folders back."""
    few = rows(QUERIES[name](spark, SF_DIR))
    monkeypatch.setattr(folders, "FEW_FILES", 0)
    df = QUERIES[name](spark, SF_DIR)
    assert rows(df) == few and few
    assert name == "feed_order" or "listed-files" in df._jdf.queryExecution().executedPlan().toString()
