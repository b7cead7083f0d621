"""What lies in the landing area: files, their periods, and which of them to read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.dates import path_period, period_end, period_grain, period_start
from tallyloom.sinks.folders import folder_value, read_parquet
from tallyloom.sources.scan import file_listing, file_stem

UNDATED = ("SYMBOL", "SNAPSHOT")  # grains whose folders name no period

def method_folder(root: str, method: str) -> str:
    """Where the files of a method lie, over all sources."""
    return f"{root.rstrip('/')}/*/{method}"


def period_patterns(root: str, method: str, start: str, end: str) -> list[str]:
    """Path patterns of the folders whose period can overlap a range: years, quarters and months.

    As many as the range has periods, however many files there are. A folder's name may have a prefix
    (``month=199702``); days are folders below their month.
    """
    first, last = (int(t[:4]) * 12 + int(t[4:6]) - 1 for t in (start, end))
    months = [(m // 12, m % 12) for m in range(first, last + 1)]
    names = {f"{y:04d}{m + 1:02d}" for y, m in months} | {f"{y:04d}{q}{m // 3 + 1}" for y, m in months for q in "Qq"}
    names |= {f"{y:04d}" for y, _ in months}
    return [f"{method_folder(root, method)}/*{{{','.join(sorted(names))}}}"] if names else []


def file_period(path: Column, method: str) -> Column:
    """the period label in the part of a path below its method's folder."""
    return path_period(F.substring_index(path, f"/{method}/", -1))


def landed_files(spark: SparkSession, root: str, method: str, with_sidecar: bool = True,
                 grain: str | None = None) -> DataFrame:
    """The Parquet files of a method over all sources, those with a sidecar if so asked.

    Files of a method kept by symbol (``grain="SYMBOL"``) or as a whole carry no period, whatever their folders
    are called; without a grain the period is read from the path.
    """
    where = [method_folder(root, method)]
    data = file_listing(spark, where).withColumnRenamed("file_path", "path").withColumn("stem", file_stem(F.col("path")))
    if with_sidecar:
        notes = file_listing(spark, where, "*.json")
        data = data.join(notes.select(file_stem(F.col("file_path")).alias("stem")), "stem", "left_semi")
    label = file_period(F.col("path"), method)
    if grain is not None:
        label = F.when(period_grain(label) == grain.lower(), label) if grain.upper() not in UNDATED else F.lit(None).cast("string")
    return with_period_bounds(data.withColumn("period", label))


def with_period_bounds(files: DataFrame) -> DataFrame:
    """First and last day of each file's ``period``.

    The bounds come from a generator, not a projection: a filter on them then stays above the path
    parsing instead of being rewritten into many copies of it.
    """
    label = F.col("period")
    start = period_start(label)
    bounds = F.struct(start.alias("period_start"), period_end(label, start).alias("period_end"))
    return files.select("*", F.inline(F.array(bounds)))


def in_range(files: DataFrame, start: str | Column, end: str | Column) -> DataFrame:
    """Files whose period overlaps the closed range; undated files and bad bounds drop out."""
    first = F.try_to_date(F.lit(start) if isinstance(start, str) else start, "yyyyMMdd")
    last = F.try_to_date(F.lit(end) if isinstance(end, str) else end, "yyyyMMdd")
    return files.where((F.col("period_start") <= last) & (F.col("period_end") >= first))


def read_layout(spark: SparkSession, path: str, start: str | None = None,
                end: str | None = None, many: bool = False) -> DataFrame:
    """S5 on a table partitioned by ``grain`` and ``period``.

    The range is a condition on the partition columns alone, so Spark lists and reads only the
    partitions in it. Both are read as text: an inferred period would lose leading zeros.
    ``many`` reads a whole table of very many folders, such as symbols, as plain files instead, by tasks where
    there are more than Spark's reader should list.
    """
    if many and (rows := read_parquet(spark, path, ("grain", "period"))) is not None:
        return rows
    if many:
        files = spark.read.option("recursiveFileLookup", True).parquet(path)
        return files.select("*", folder_value("grain").alias("grain"), folder_value("period").alias("period"))
    label, inferred = F.col("period"), "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(inferred)
    spark.conf.set(inferred, "false")
    try:
        # Read with the types in the files, so the folders are listed once and not again for a schema.
        table = spark.read.parquet(path)
    finally:
        spark.conf.set(inferred, before)
    if start is None or end is None:
        return table
    first = period_start(label)
    return table.where((first <= F.to_date(F.lit(end), "yyyyMMdd"))
                       & (period_end(label, first) >= F.to_date(F.lit(start), "yyyyMMdd")))


def available_periods(files: DataFrame) -> DataFrame:
    """The distinct period labels in order. Files kept per symbol carry no period.

    Without a stored grain six digits are a month wherever the month is one, so a method kept by symbol needs
    its grain given to ``landed_files`` or kept in the catalogue: 200011 is a month, or a symbol.
    """
    return files.where(F.col("period_start").isNotNull()).select("period").distinct().orderBy(
        "period")


def first_files(files: DataFrame, max_files: int | None) -> DataFrame:
    """The first N files by path."""
    ranked = files.orderBy("path")
    return ranked if max_files is None else ranked.limit(max_files)
