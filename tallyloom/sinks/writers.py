"""Table, CSV and report sinks."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.columns import ordered
from tallyloom.sinks.folders import count_folders, folder_value, local_path, read_lines
from tallyloom.sinks.layout import write_partitions

FORMATS = ("parquet", "csv")


def write_table(df: DataFrame, path: str, fields: Sequence[str] = (), mode: str = "overwrite",
                row_group_bytes: int | None = None, rows_per_file: int | None = None) -> int:
    """K1, K2: existing fields in order as Snappy Parquet; returns the row count of the write."""
    options = {"compression": "snappy"}
    if row_group_bytes:
        options["parquet.block.size"] = row_group_bytes
    if rows_per_file:
        options["maxRecordsPerFile"] = rows_per_file
    seen = Observation()
    (ordered(df, fields).observe(seen, F.count("*").alias("rows"))
     .write.mode(mode).options(**options).parquet(path))
    return seen.get["rows"]


def write_manifest_row(spark: SparkSession, path: str, row: dict) -> None:
    """K2, K3: facts about a table as one JSON line next to it."""
    spark.createDataFrame([(json.dumps(row, sort_keys=True, default=str),)], "value string") \
        .coalesce(1).write.mode("append").text(path)


def write_raw(df: DataFrame, root: str, source: str, interface: str, stage: str, created_at: str,
              keys: Sequence[str]) -> int:
    """K2: raw layer table and its metadata."""
    base = f"{root}/raw/{source}/{interface}"
    rows = write_table(df, f"{base}/{stage}")
    write_manifest_row(df.sparkSession, f"{base}/_meta", {
        "source": source, "interface": interface, "stage": stage, "created_at": created_at,
        "primary_keys": list(keys), "rows": rows})
    return rows


def write_norm_csv(df: DataFrame, root: str, interface: str, keys: Sequence[str],
                   partition: str | None = None, source: str | None = None,
                   decisions: DataFrame | None = None) -> str:
    """K3: CSV by interface, its schema as JSON, its decisions as JSON lines."""
    name = f"{source}_{interface}" if source else interface
    base = f"{root}/norm/{interface}" + (f"/{partition}" if partition else "")
    target = f"{base}/{name}.csv"
    seen = Observation()
    (df.observe(seen, F.count("*").alias("rows"))
     .write.mode("overwrite").option("header", True).csv(target))
    write_manifest_row(df.sparkSession, f"{base}/{name}_schema", {
        "columns": {f.name: f.dataType.simpleString() for f in df.schema},
        "primary_keys": list(keys), "rows": seen.get["rows"]})
    if decisions is not None:
        decisions.write.mode("append").json(f"{base}/{name}_decisions")
    return target


def in_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """O1: sorted ranges for a write with many small directories.

    The number of ranges is given, so that adaptive execution does not merge them by size: opening
    files, not the bytes in them, is what such a write spends its time on.
    """
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(count, *keys).sortWithinPartitions(*keys)


def write_per_entity(df: DataFrame, path: str, key: str, day: str,
                     columns: Sequence[str] | None = None, upper: bool = False,
                     replace: str = "partitions") -> int:
    """One CSV directory per entity, in date order; returns the number of entities there.

    Entities that are not in the rows keep their files; ``replace="all"`` drops them.

    Ranges over (entity, day) rather than a hash of the entity: small entities share a task, an
    entity with much of the data is spread over several tasks and gets one file per range, and
    the file names sort in date order.
    """
    label = F.upper(key) if upper else F.col(key)
    kept = [c for c in (columns or df.columns) if c != key]
    if day not in kept:
        kept.append(day)
    rows = df.select(label.alias(key), *[f"`{c}`" for c in kept])
    write_partitions(in_ranges(rows, key, day), path, [key], "csv", replace, many=True, header=True)
    # Counted from the directory names; no file is opened.
    root = local_path(df.sparkSession, path)
    if root is not None:
        return count_folders(df.sparkSession, root, ".csv")
    files = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    return files.select(key).distinct().count()


def read_per_entity(spark: SparkSession, path: str, schema, by: Sequence[str] = ("symbol",),
                    places: bool = False) -> DataFrame:
    """K4 read back: files below ``<by>=`` folders; the declared schema keeps the zeros of numeric-looking names.

    ``places`` adds the name of a row's ``file`` and a number ``line``, one more than that of the line above it.
    Very many files are listed and read by tasks (``sinks/folders``).
    """
    declared = spark.createDataFrame([], schema).schema
    rest = [f for f in declared if f.name not in by]
    lines = read_lines(spark, path, by, header=True) if rest else None
    if lines is not None:
        quoted = [(f.name.replace("`", "``"), f.dataType.simpleString()) for f in rest]
        parsed = F.from_csv("_text", ", ".join(f"`{name}` {kind}" for name, kind in quoted))
        rows = lines.withColumn("_row", parsed)
        return rows.select(*[F.col("_row").getField(f.name).alias(f.name) for f in rest],
                           *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in declared if f.name in by],
                           *([F.col("_file").alias("file"), F.col("_line").alias("line")] if places else []))
    files = spark.read.schema(T.StructType(rest)).option("header", True).option("recursiveFileLookup", True).csv(path)
    numbered = [F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line")] if places else []
    return files.select("*", *[folder_value(f.name).cast(f.dataType).alias(f.name) for f in declared if f.name in by], *numbered)


def write_feed_lists(calendar: DataFrame, instruments: DataFrame, path: str) -> None:
    """K5: calendar as one column, instruments tab separated, both without a header.

    Both are sorted; small ones come out as one file, as adaptive execution merges their ranges.
    """
    calendar.orderBy("date").write.mode("overwrite").option("header", False).csv(
        f"{path}/day")
    instruments.orderBy("symbol").write.mode("overwrite").option(
        "header", False).option("sep", "\t").csv(f"{path}/all")


def write_cleaned(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """K6: cleaned table as Parquet or CSV; another format raises."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt}")
    if fmt == "parquet":
        return write_table(df, path)
    seen = Observation()
    (df.observe(seen, F.count("*").alias("rows"))
     .write.mode("overwrite").option("header", True).csv(path))
    return seen.get["rows"]


def write_rejects(rows: DataFrame, root: str, run_id: str) -> str:
    """Rejected rows of a run."""
    path = f"{root}/rejects/{run_id}"
    rows.write.mode("append").parquet(path)
    return path


def write_audit_report(results: DataFrame, summary: DataFrame, path: str) -> None:
    """Audit results and their summary as JSON lines."""
    results.coalesce(1).write.mode("overwrite").json(f"{path}/results")
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def read_back(spark: SparkSession, path: str, expected: DataFrame | None = None) -> DataFrame:
    """Q12: rows and columns of a written table, and whether its schema is the expected one."""
    table = spark.read.parquet(path)
    same = expected is None or [(f.name, f.dataType) for f in table.schema] == [
        (f.name, f.dataType) for f in expected.schema]
    return table.agg(F.count("*").alias("n_rows")).withColumns(
        {"n_columns": F.lit(len(table.columns)), "same_schema": F.lit(same)})
