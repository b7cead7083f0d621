"""Aggregations over whole tables and per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.keyed import keys_present, per_key


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """G1: rows per key, null keys left out."""
    return per_key(df.where(keys_present(keys)), keys, F.count("*").alias("n_rows"))


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total rows and rows beyond the first of their key, in one row."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
                     F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls and null ratio per column, counted in one pass."""
    names = list(columns or df.columns)
    counts = df.agg(F.count("*").alias("_rows"),
                    *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_c{i}")
                      for i, c in enumerate(names)])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"_c{i}").alias("n_null"))
               for i, c in enumerate(names)]
    rows = counts.select("_rows", F.inline(F.array(*entries)))
    return rows.select("column_name", "n_null",
                       F.try_divide(F.col("n_null"), F.col("_rows")).alias("null_ratio"))


def instruments(df: DataFrame, symbol: str = "symbol", day: str = "date") -> DataFrame:
    """First and last day per symbol, symbol in upper case, days as ISO text."""
    spans = df.groupBy(symbol).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    return spans.select(F.upper(symbol).alias("symbol"),
                        F.date_format("_first", "yyyy-MM-dd").alias("start_datetime"),
                        F.date_format("_last", "yyyy-MM-dd").alias("end_datetime"))


def calendar_days(df: DataFrame, day: str = "date") -> DataFrame:
    """The distinct days as ISO text, in order."""
    days = df.select(F.date_format(day, "yyyy-MM-dd").alias("date")).distinct()
    return days.where(F.col("date").isNotNull()).orderBy("date")


def entity_count(df: DataFrame, key: str) -> DataFrame:
    """G12."""
    return df.agg(F.count_distinct(key).alias("n_entities"))
