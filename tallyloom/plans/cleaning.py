"""Cleaning jobs from landed files to one table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.dates import parse_compact, period_end, period_start
from tallyloom.plans.steps import Step, run_steps
from tallyloom.sinks.writers import FORMATS, write_cleaned
from tallyloom.sources.landing import file_period, first_files, in_range, landed_files, method_folder, period_patterns
from tallyloom.sources.scan import ROW_IN_FILE, landing_scan, sidecar_digests, union_sources


def clean_sources(sources: Mapping[str, DataFrame], settings: Mapping[str, Mapping],
                  registry: Mapping[str, Step], on_error: str = "raise") -> DataFrame:
    """Each enabled source through its own steps, then all of them by column name."""
    parts = []
    for name, df in sources.items():
        setting = settings.get(name, {})
        if setting.get("enabled", True):
            parts.append(run_steps(df, setting.get("steps", ()), registry, on_error))
    if not parts:
        raise ValueError("no enabled source")
    return union_sources(parts)


def landed_source(spark: SparkSession, root: str, method: str, start: str | None = None,
                  end: str | None = None, max_files: int | None = None,
                  report: Callable[[DataFrame], object] | None = None) -> DataFrame:
    """The landed files of a method with provenance and row order, optionally of a period.

    Only files with a sidecar count. Folders are chosen by patterns of the range, and files outside it by a
    condition on their path, which Spark applies to its file index; no path list is made, but for the first
    ``max_files``. Files that cannot be read to their end are left out whole; ``report`` gets them.
    """
    where, ranged = [method_folder(root, method)], start is not None and end is not None
    if ranged:
        if not (valid_day(start) and valid_day(end)):
            return landing_scan(spark, [], position=True)
        where = period_patterns(root, method, start, end)
    notes = sidecar_digests(spark, where)
    if max_files is not None:
        files = landed_files(spark, root, method)
        chosen = first_files(in_range(files, start, end) if ranged else files, max_files)
        where = [r["path"] for r in chosen.select("path").collect()]
    rows = landing_scan(spark, where, notes, position=True, unreadable="skip", report=report, need_digest=True)
    if not ranged:
        return rows
    label = file_period(F.col("file_path"), method)
    first = period_start(label)
    return rows.where((first <= parse_compact(F.lit(end))) & (period_end(label, first) >= parse_compact(F.lit(start))))


def valid_day(text: str) -> bool:
    try:
        return len(text) == 8 and bool(dt.datetime.strptime(text, "%Y%m%d"))
    except ValueError:
        return False


def clean_method(spark: SparkSession, root: str, method: str, steps: Sequence[Mapping],
                 registry: Mapping[str, Step], start: str | None = None, end: str | None = None,
                 max_files: int | None = None,
                 report: Callable[[DataFrame], object] | None = None) -> DataFrame:
    """One method from its landed files through the cleaning steps."""
    rows = landed_source(spark, root, method, start, end, max_files, report)
    return run_steps(rows, steps, registry).drop(ROW_IN_FILE)


def clean_and_save(spark: SparkSession, root: str, method: str, steps: Sequence[Mapping],
                   registry: Mapping[str, Step], path: str, fmt: str = "parquet",
                   start: str | None = None, end: str | None = None,
                   max_files: int | None = None,
                   report: Callable[[DataFrame], object] | None = None) -> int:
    """The cleaned table of a method, written; returns its row count."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt}")
    cleaned = clean_method(spark, root, method, steps, registry, start, end, max_files, report)
    return write_cleaned(cleaned, path, fmt)
