"""Record resolution and de-duplication.

Rows with a null key part never match a group here (D1-D3), as a grouped pandas frame leaves
them out; D4-D6 treat null keys as equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.contracts import DIVIDEND_MAX_SPREAD
from tallyloom.functions.amounts import lenient_number, relative_spread
from tallyloom.functions.dates import day_order
from tallyloom.operators.keyed import (
    descending, first_per_key, key_matches, keys_present, per_key, rows_with_key,
    rows_without_key, tagged)


def statement_keys(columns: Sequence[str]) -> list[str]:
    """The revision key: code and period end, plus the announcement day there is."""
    for day in ("f_ann_date", "ann_date"):
        if day in columns:
            return ["ts_code", "end_date", day]
    return ["ts_code", "end_date"]


def _flag_pairs(df: DataFrame, keys: Sequence[str], flag: str, *aggs: Column) -> DataFrame:
    """Keys of exactly two rows with the lowest, highest and summed flag."""
    value = lenient_number(F.col(flag))
    stats = per_key(df, keys, F.count("*").alias("_n"),
                    F.min(value).alias("_low"), F.max(value).alias("_high"),
                    F.sum(value).alias("_sum"), *aggs)
    return stats.where(F.col("_n") == 2)


def resolve_01(df: DataFrame, keys: Sequence[str] | None = None,
               flag: str = "update_flag") -> DataFrame:
    """Of two rows flagged 0 and 1 the one flagged 1 stays; all else stays."""
    keys = keys or statement_keys(df.columns)
    pairs = _flag_pairs(df, keys, flag).where("_low = 0 and _high = 1 and _sum = 1")
    return rows_without_key(df, pairs.select(*keys), keys,
                            extra=~lenient_number(F.col(flag)).eqNullSafe(F.lit(1.0)))


def resolve_11(df: DataFrame, keys: Sequence[str] | None = None, flag: str = "update_flag",
               day: str = "ann_date") -> DataFrame:
    """Of two rows flagged 1 the later announced stays, both on a tie, none without a day."""
    keys = keys or statement_keys(df.columns)
    pairs = _flag_pairs(df, keys, flag, F.max(day_order(df, day)).alias("_last"))
    pairs = pairs.where("_low = 1 and _high = 1 and _sum = 2").select(*keys, "_last")
    late = F.coalesce(day_order(df, day) == F.col("_last"), F.lit(False))
    return rows_without_key(df, pairs, keys, extra=~late)


def resolve_flags(df: DataFrame, keys: Sequence[str] | None = None, flag: str = "update_flag",
                  day: str = "ann_date") -> DataFrame:
    """D1 then D2 in one pass: their groups never overlap, so one statistic serves both."""
    keys = keys or statement_keys(df.columns)
    pairs = _flag_pairs(df, keys, flag, F.max(day_order(df, day)).alias("_last"))
    pairs = pairs.where("(_low = 0 and _high = 1 and _sum = 1) or "
                        "(_low = 1 and _high = 1 and _sum = 2)").select(*keys, "_low", "_last")
    late = F.coalesce(day_order(df, day) == F.col("_last"), F.lit(False))
    flagged = lenient_number(F.col(flag)).eqNullSafe(F.lit(1.0))
    losing = F.when(F.col("_low") == 0, ~flagged).otherwise(~late)
    return rows_without_key(df, pairs, keys, extra=losing)


def resolve_dividends(df: DataFrame, keys: Sequence[str] = ("ts_code", "end_date", "ann_date"),
                      amount: str = "cash_div_tax", day: str = "imp_ann_date",
                      tie_break: Sequence[str] = (), max_spread: float = DIVIDEND_MAX_SPREAD
                      ) -> DataFrame:
    """D3: one row per key, the latest implemented, unless the amounts differ by too much.

    Groups whose spread is above ``max_spread`` stay whole for the uniqueness check; so do rows
    with a null key part. Ties go to the smallest ``tie_break`` value, then the smallest row.
    """
    keys = list(keys)
    if any(c not in df.columns for c in [*keys, amount, day]):
        return df
    newest_first = descending(day_order(df, day))
    rest = [c for c in df.columns if c not in keys]
    candidate = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(newest_first)],
                         *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tie_break)],
                         *[F.col(c) for c in rest])
    best = per_key(df.where(keys_present(keys)), keys, F.min(candidate).alias("_best"),
                   relative_spread(F.max(amount), F.min(amount), F.count(amount)).alias("_spread"))
    narrow = best.where(F.col("_spread").isNull() | (F.col("_spread") <= max_spread))
    single = narrow.select(*[F.col(c) if c in keys else F.col(f"_best.`{c}`").alias(c)
                             for c in df.columns])
    # Asking for the candidate too keeps the aggregate the same in both places, so its shuffle is read twice.
    wide = best.where((F.col("_spread") > max_spread) & F.col("_best").isNotNull()).select(*keys, "_spread")
    marked = df.join(tagged(wide, keys, df), key_matches(keys), "left")
    whole = marked.where(F.col("_spread").isNotNull() | ~keys_present(keys)).select(*df.columns)
    return single.unionByName(whole)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct."""
    return df.dropDuplicates()


def distinct_on(df: DataFrame, subset: Sequence[str] | None, order_by: Sequence[str]) -> DataFrame:
    """The first row per key in the given order; keys that do not exist are left out.

    No existing key changes nothing; no key at all means whole rows.
    """
    if not subset:
        return distinct_rows(df)
    keys = [c for c in subset if c in df.columns]
    return first_per_key(df, keys, [F.col(c) for c in order_by]) if keys else df


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return per_key(df, keys, F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def repeated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of a key that occurs more than once."""
    return rows_with_key(df, repeated_keys(df, keys).select(*keys), keys, null_safe=True)


def group_extreme(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The rows that hold the group's largest value."""
    top = per_key(df.where(keys_present(keys)), keys, F.max(column).alias(column))
    return rows_with_key(df, top, [*keys, column])


def dedupe_by_strategy(df: DataFrame, keys: Sequence[str], strategy: str, update: str = "update_flag",
                       announced: str = "ann_date", report: str = "report_type") -> DataFrame:
    """One row per key.

    ``keep_latest_update`` takes the highest flag, then the latest announcement;
    ``keep_earliest_ann`` the earliest announcement; ``keep_official_report`` the lowest report
    type, then flag and date. What is still tied goes to the smallest row.
    """
    flag = lenient_number(F.col(update))
    moment = day_order(df, announced)
    latest = [*descending(flag), *descending(moment)]
    if strategy == "keep_latest_update":
        order = latest
    elif strategy == "keep_earliest_ann":
        order = [moment.isNull().cast("int"), moment]
    elif strategy == "keep_official_report":
        order = [F.col(report).isNull().cast("int"), F.col(report), *latest]
    else:
        raise ValueError(f"unknown strategy: {strategy}")
    return first_per_key(df, list(keys), order)
