"""Validation of storage requests and the partition columns that follow from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.contracts import GRAINS
from tallyloom.sinks.folders import can_write, write_folders

# Accepted symbol formats and quarter ends.
SYMBOL_FORMATS = (r"^(SH|SZ|BJ)\d{6}$", r"^\d{6}\.(SH|SZ|BJ)$", r"^\d{6}$")
QUARTER_ENDS = ("0331", "0630", "0930", "1231")


def request_errors(grain: Column, date: Column, symbol: Column) -> Column:
    """the reasons a request cannot be stored; an empty array means it can."""
    kind = F.upper(grain)
    blank_date = date.isNull() | (date == "")
    blank_symbol = symbol.isNull() | (symbol == "")
    eight = date.rlike(r"^\d{8}$")
    named = kind.isin(*GRAINS)
    known_symbol = symbol.rlike("|".join(SYMBOL_FORMATS))
    dated = kind.isin("DAILY", "MONTHLY", "QUARTERLY")
    reasons = [
        (grain.isNull() | ~named, "unknown_grain"),
        (dated & blank_date, "date_missing"),
        ((kind == "DAILY") & ~blank_date & ~eight, "date_not_yyyymmdd"),
        ((kind == "MONTHLY") & ~blank_date & ~eight & ~date.rlike(r"^\d{6}$"),
         "date_not_yyyymm"),
        ((kind == "QUARTERLY") & ~blank_date & ~eight, "date_not_yyyymmdd"),
        ((kind == "QUARTERLY") & eight & ~F.substring(date, 5, 4).isin(*QUARTER_ENDS),
         "date_not_quarter_end"),
        ((kind == "SYMBOL") & blank_symbol, "symbol_missing"),
        ((kind == "SYMBOL") & ~blank_symbol & ~known_symbol, "symbol_format"),
    ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(reason)) for bad, reason in reasons]))


def partition_label(grain: Column, date: Column, symbol: Column) -> Column:
    """The partition a request belongs to: day, month, quarter, symbol or snapshot."""
    kind = F.upper(grain)
    quarter = F.ceil(F.substring(date, 5, 2).try_cast("int") / 3).cast("string")
    return (
        F.when(kind == "DAILY", date)
        .when(kind == "MONTHLY", F.substring(date, 1, 6))
        .when(kind == "QUARTERLY", F.concat(F.substring(date, 1, 4), F.lit("Q"), quarter))
        .when(kind == "SYMBOL", symbol)
        .when(kind == "SNAPSHOT", F.lit("snapshot"))
    )


def with_layout(df: DataFrame, grain: str, date: str, symbol: str) -> DataFrame:
    """Requests with their errors and, where there are none, their partition columns."""
    g, d, s = F.col(grain), F.col(date), F.col(symbol)
    checked = df.withColumn("errors", request_errors(g, d, s))
    valid = F.size("errors") == 0
    return checked.withColumns({
        "grain": F.when(valid, F.upper(g)),
        "period": F.when(valid, partition_label(g, d, s))})


REPLACE_MODES = ("partitions", "all")


def write_partitions(rows: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet",
                     replace: str = "partitions", many: bool = False, **options) -> None:
    """Rows under ``<by>=`` folders.

    ``partitions`` replaces exactly the folders that the rows fall into and leaves all others as they
    are; ``all`` replaces the whole table. A folder is replaced as a whole, so a shorter rewrite
    leaves no file of the longer one. ``many`` says that the rows are sorted into very many small folders,
    for which a local file system is written in another way (``sinks/folders``) with the same outcome.
    """
    if replace not in REPLACE_MODES:
        raise ValueError(f"replace must be one of {REPLACE_MODES}, not {replace}")
    if many and set(options) <= {"header"} and can_write(rows, path, by, fmt):
        write_folders(rows, path, by, fmt, replace, **options)
        return
    mode = "dynamic" if replace == "partitions" else "static"
    (rows.write.mode("overwrite").format(fmt).options(partitionOverwriteMode=mode, **options)
     .partitionBy(*by).save(path))


def write_partitioned(df: DataFrame, path: str, grain: Column, date: Column,
                      symbol: Column | None = None, replace: str = "partitions",
                      rejects: Callable[[DataFrame], object] | None = None) -> None:
    """Rows written under ``grain=/period=``, each request asked first.

    Rows whose request cannot be stored go to ``rejects`` with their ``errors``; without it the first
    of them stops the write. The rebalance hint gathers each period for large files and lets adaptive
    execution split a period that is too large for one task.
    """
    named = symbol is not None
    symbol = symbol if named else F.lit(None).cast("string")
    errors = request_errors(grain, date, symbol)
    if rejects is not None:
        rejects(df.withColumn("errors", errors).where(F.size("errors") > 0))
        df = df.where(F.size(errors) == 0)
        label = partition_label(grain, date, symbol)
    else:
        stop = F.raise_error(F.concat(F.lit("request cannot be stored: "), F.array_join(errors, ", ")))
        label = F.when(F.size(errors) > 0, stop.cast("string")).otherwise(
            partition_label(grain, date, symbol))
    rows = df.withColumns({"grain": F.upper(grain), "period": label})
    by = ("grain", "period")
    if named and can_write(rows, path, by, "parquet"):
        # A folder per symbol: ranges of a given number, as the folders and not the bytes are the work. The
        # hash of the row spreads a symbol with much of the data.
        spread = F.xxhash64(*[f"`{c}`" for c in df.columns])
        count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = rows.repartitionByRange(count, *by, spread).sortWithinPartitions(*by)
        write_partitions(ranges, path, by, replace=replace, many=True)
        return
    write_partitions(rows.hint("rebalance", *by), path, by, replace=replace)
