"""Table and file scans."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.amounts import nan_to_null
from tallyloom.operators.lookup import remapped_master
from tallyloom.operators.resolve import distinct_rows
from tallyloom.session import as_table

# Position of a row in its file; with ``file_path`` it is the order the rows were landed in.
ROW_IN_FILE = "file_row"


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def type_family(dtype: T.DataType) -> str:
    if isinstance(dtype, T.FractionalType):
        return "number"
    return "number" if isinstance(dtype, T.IntegralType) else dtype.typeName()


def conform(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Expected columns in order; missing ones are null, an incompatible type raises.

    NaN becomes null, as every comparison in the rest of the package takes null for "no value".
    """
    columns = []
    for field in expected:
        if field.name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        actual = df.schema[field.name].dataType
        if type_family(actual) != type_family(field.dataType):
            raise TypeError(f"{field.name} is {actual.simpleString()}, "
                            f"expected {field.dataType.simpleString()}")
        value = F.col(f"`{field.name}`").cast(field.dataType)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            value = nan_to_null(value)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def read_table(spark: SparkSession, path: str, expected: T.StructType | None = None,
               strict: bool = True) -> DataFrame:
    """A Parquet table; a missing path raises, or is an empty frame when not strict."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        if strict or not is_missing_path(error):
            raise
        return empty(spark, expected or T.StructType([]))
    return conform(df, expected) if expected is not None else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             strict: bool = True) -> DataFrame:
    """CSV with a header and a declared schema, so that codes keep their zeros."""
    try:
        return (spark.read.schema(schema).option("header", True).option("encoding", "UTF-8")
                .option("enforceSchema", False).csv(path))
    except AnalysisException as error:
        if strict or not is_missing_path(error):
            raise
        return empty(spark, schema)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(path, r"\.[A-Za-z]+$", "")


def sidecar_digests(spark: SparkSession, where: Sequence[str]) -> DataFrame:
    """S3: ``data_md5`` of each sidecar in files, folders or path patterns, under the stem it shares with
    its data file."""
    try:
        rows = (spark.read.schema("data_md5 string").option("multiLine", True).option("recursiveFileLookup", True)
                .option("pathGlobFilter", "*.json").json(list(where)))
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return empty(spark, "stem string, file_md5 string")
    return rows.select(file_stem(F.col("_metadata.file_path")).alias("stem"),
                       F.col("data_md5").alias("file_md5"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """K8: MD5 of the bytes of every Parquet file below a path, under the file's stem."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", True).load(path))
    return files.select(file_stem(F.col("path")).alias("stem"), F.md5("content").alias("file_md5"))


def _footer_types(spark: SparkSession, where: Sequence[str], tolerant: bool) -> list[tuple[str, str]]:
    """(path, column types) per file, read from the footers in tasks; only for files that do not agree."""
    def each(batches):
        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        for batch in batches:
            found = []
            for path in batch["file_path"]:
                system, local = fs.FileSystem.from_uri(path.replace("file:///", "/", 1).replace("file:/", "/", 1))
                try:
                    schema = pq.read_schema(local, filesystem=system)
                except (pa.ArrowException, OSError):
                    if tolerant:
                        continue  # reported with the files that have no rows
                    raise
                found.append((path, ";".join(f"{f.name}:{f.type}" for f in schema)))
            yield pd.DataFrame(found, columns=["path", "types"])

    files = file_listing(spark, where).select("file_path").repartition(spark.sparkContext.defaultParallelism)
    return [(r.path, r.types) for r in files.mapInPandas(each, "path string, types string").collect()]


def file_listing(spark: SparkSession, where: Sequence[str], pattern: str = "*.parquet") -> DataFrame:
    """(file_path, modified, length) of the files in folders or path patterns; no file is opened."""
    schema = "file_path string, modified timestamp, length bigint"
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .option("pathGlobFilter", pattern).load(list(where)))
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return empty(spark, schema)
    about = F.col("_metadata")
    return files.select(about["file_path"].alias("file_path"), about["file_modification_time"].alias("modified"),
                        about["file_size"].alias("length"))


def _reader(spark: SparkSession, tolerant: bool):
    return (spark.read.option("mergeSchema", True).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").option("ignoreCorruptFiles", tolerant)
            .option("ignoreMissingFiles", tolerant))


def _placed(rows: DataFrame) -> DataFrame:
    return rows.select("*", F.col("_metadata.file_path").alias("file_path"),
                       F.col("_metadata.row_index").alias(ROW_IN_FILE))


def _union_of_kinds(spark: SparkSession, where: Sequence[str], tolerant: bool) -> DataFrame:
    """Files whose columns differ in type: one read per set of types, drifting columns as text."""
    kinds: dict[str, list[str]] = {}
    for path, types in _footer_types(spark, where, tolerant):
        kinds.setdefault(types, []).append(path)
    parts = [_placed(_reader(spark, tolerant).parquet(*members)) for members in kinds.values()]
    seen: dict[str, set[str]] = {}
    for part in parts:
        for field in part.schema:
            seen.setdefault(field.name, set()).add(field.dataType.simpleString())
    drifting = {name for name, types in seen.items() if len(types) > 1}
    texts = [part.withColumns({c: F.col(f"`{c}`").cast("string")
                               for c in part.columns if c in drifting}) for part in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), texts)


def _merged_scan(spark: SparkSession, where: Sequence[str], tolerant: bool) -> DataFrame | None:
    """The rows of all files; None where no file has a schema to read by."""
    try:
        return _placed(_reader(spark, tolerant).parquet(*where))
    except AnalysisException as error:
        if is_missing_path(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        if error.getCondition() != "CANNOT_MERGE_SCHEMAS":
            raise
    except Exception as error:
        # Schema merging runs as a job, so its conflict can also arrive as a job failure.
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    return _union_of_kinds(spark, where, tolerant)


UNREADABLE = "path string, error string"


def _whole_files(spark: SparkSession, where: Sequence[str], rows: DataFrame | None) -> tuple[DataFrame | None, DataFrame]:
    """The rows of files that were read to their end, and (path, error) of the others.

    The data are read once, into a table. Spark leaves a file at the first page it cannot read; how many rows
    it should have had is counted from the footers alone, which a scan without columns reads. A file
    with fewer rows than that is left out whole.
    """
    listed = file_listing(spark, where).select("file_path")
    if rows is None:
        return None, listed.select(F.col("file_path").alias("path"), F.lit("no rows: empty or no Parquet file").alias("error"))
    table = as_table(rows, "landed-rows")
    got = table.groupBy("file_path").agg(F.count("*").alias("n_read"))
    stated = (_reader(spark, True).schema("_none string").parquet(*where)
              .groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("n_stated")))
    both = listed.join(stated, "file_path", "left").join(got, "file_path", "left")
    short = F.coalesce("n_read", F.lit(0)) < F.col("n_stated")
    bad = as_table(both.where(F.col("n_stated").isNull() | short).select(
        F.col("file_path").alias("path"),
        F.when(short, F.concat(F.lit("read "), F.coalesce("n_read", F.lit(0)), F.lit(" of "), "n_stated", F.lit(" rows")))
        .otherwise("no rows: empty or no Parquet file").alias("error")), "unreadable-files")
    return table.join(bad, table["file_path"] == bad["path"], "left_anti"), bad


def landing_scan(spark: SparkSession, where: Sequence[str], digests: DataFrame | None = None,
                 expected: T.StructType | None = None, position: bool = False,
                 unreadable: str = "raise", report: Callable[[DataFrame], object] | None = None,
                 need_digest: bool = False) -> DataFrame:
    """The rows of files, folders or path patterns by column name, with ``file_path`` and ``file_md5``.

    ``position`` adds the row's place in its file, for steps that depend on row order. A broken file stops
    the job; with ``unreadable="skip"`` files that cannot be read to their end are left out whole, and
    ``report`` gets them as (path, error). No file at all gives an empty frame. Columns a file lacks
    are null. Columns that change type between files come as text unless ``expected`` says otherwise, in
    which case they are cast leniently. ``need_digest`` keeps only files that have one.
    """
    if unreadable not in ("raise", "skip"):
        raise ValueError(f"unreadable must be raise or skip, not {unreadable}")
    tolerant, where = unreadable == "skip", list(where)
    rows = _merged_scan(spark, where, tolerant) if where else None
    if tolerant and where:
        rows, bad = _whole_files(spark, where, rows)
        if report is not None:
            with_notes = bad if not need_digest else bad.join(
                digests.select("stem"), file_stem(F.col("path")) == F.col("stem"), "left_semi")
            report(with_notes)
    if rows is None:
        return empty(spark, "file_path string, file_md5 string" + (f", {ROW_IN_FILE} bigint" if position else ""))
    if not position:
        rows = rows.drop(ROW_IN_FILE)
    if expected is not None:
        rows = rows.withColumns({f.name: F.col(f"`{f.name}`").try_cast(f.dataType)
                                 for f in expected if f.name in rows.columns})
    if digests is None:
        return rows.withColumn("file_md5", F.lit(None).cast("string"))
    with_stem = rows.withColumn("stem", file_stem(F.col("file_path")))
    return with_stem.join(digests, "stem", "inner" if need_digest else "left").drop("stem")


def merge_pages(pages: Sequence[DataFrame], spark: SparkSession | None = None,
                schema: T.StructType | None = None) -> DataFrame:
    """Pages of one extract joined by name, whole-row duplicates removed."""
    if not pages:
        return empty(spark, schema)
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)
    return distinct_rows(union)


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """Cleaned sources joined by name; columns a source lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """The trade calendar with ``cal_date`` as text."""
    return read_table(spark, path).withColumn("cal_date", F.col("cal_date").cast("string"))


def read_master(spark: SparkSession, path: str, code_map: DataFrame) -> DataFrame:
    """The security master with its codes remapped."""
    return remapped_master(read_table(spark, path), code_map)
