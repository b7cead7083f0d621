"""Wide to long, and parameter lists to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.contracts import INTERVAL_SUFFIX
from tallyloom.functions.codes import to_feed_code
from tallyloom.functions.dates import fiscal_period, parse_compact
from tallyloom.operators.lookup import mapped_name

# Columns of a statement that are no values.
NOT_VALUES = {"ts_code", "symbol", "period", "datetime", "end_date", "ann_date", "f_ann_date",
              "update_flag", "comp_type", "report_type", "file_path", "file_md5"}


def to_point_in_time(df: DataFrame, interval: str = "quarterly",
                     field_names: Mapping[str, str] | None = None,
                     on_invalid: str = "raise") -> DataFrame:
    """A statement as (symbol, period, datetime, field, value), nulls left out.

    With a mapping only its fields are taken; without one every numeric value column is.
    """
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    names = field_names or {c: c for c in df.columns if c in numeric and c not in NOT_VALUES}
    values = [c for c in names if c in df.columns]
    suffix = INTERVAL_SUFFIX["annual" if interval == "annual" else "quarterly"]
    wide = df.select(
        to_feed_code(F.col("ts_code"), on_invalid=on_invalid).alias("symbol"),
        fiscal_period(F.col("end_date"), interval).alias("period"),
        parse_compact(F.col("ann_date")).alias("datetime"),
        *[F.col(f"`{c}`").cast("double").alias(c) for c in values])
    cells = wide.unpivot(["symbol", "period", "datetime"], values, "field", "value")
    return cells.where(F.col("value").isNotNull()).withColumn(
        "field", F.concat(mapped_name(F.col("field"), dict(names)), F.lit(suffix)))


def statements_to_point_in_time(sources: Mapping[str, DataFrame], interval: str = "quarterly",
                                field_names: Mapping[str, Mapping[str, str]] | None = None
                                ) -> DataFrame:
    """Every statement table reshaped, told apart by ``data_type``."""
    field_names = field_names or {}
    parts = [to_point_in_time(df, interval, field_names.get(name)).withColumn(
        "data_type", F.lit(name)) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, parts)


def explode_blocks(df: DataFrame, lists: Sequence[str]) -> DataFrame:
    """R2: lists of equal length zipped by position into one row each.

    Adds ``block_index`` (from 0) and ``total_blocks``. Lists of unequal length raise.
    """
    first = F.size(lists[0])
    equal = reduce(and_, [F.size(c) == first for c in lists])
    zipped = F.when(equal, F.arrays_zip(*lists)).otherwise(
        F.raise_error(F.lit("parameter lists differ in length")))
    kept = [c for c in df.columns if c not in lists]
    rows = df.select(*kept, first.alias("total_blocks"),
                     F.posexplode(zipped).alias("block_index", "_block"))
    return rows.select(*kept, "block_index", "total_blocks",
                       *[F.col(f"_block.{c}").alias(c) for c in lists])
