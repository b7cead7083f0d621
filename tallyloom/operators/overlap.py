"""Pairs of rows whose closed date intervals overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: tuple[str, str],
                 right_span: tuple[str, str]) -> DataFrame:
    """Rows of equal keys whose (first, last) days overlap, each pair once.

    Both sides are dealt to the months they touch and joined on key and month, an equality that Spark hashes
    and splits; a pair that shares several months is kept in the first of them. A side's rows grow with
    the months of its intervals, never with the other side. Rows with a null key, a null bound or bounds
    in the wrong order have no partner.
    """
    clash = [c for c in right.columns if c in left.columns and c not in keys]
    if clash:
        raise ValueError(f"columns {clash} are on both sides")

    def dealt(df: DataFrame, span: tuple[str, str], own: str) -> DataFrame:
        first, last = F.col(f"`{span[0]}`"), F.col(f"`{span[1]}`")
        return df.where(first <= last).select(
            "*", month_number(first).alias(own), F.explode(F.sequence(month_number(first), month_number(last))).alias("_month"))

    both = dealt(left, left_span, "_from_left").join(dealt(right, right_span, "_from_right"), [*keys, "_month"])
    once = F.col("_month") == F.greatest("_from_left", "_from_right")
    meet = (F.col(f"`{left_span[0]}`") <= F.col(f"`{right_span[1]}`")) & (F.col(f"`{right_span[0]}`") <= F.col(f"`{left_span[1]}`"))
    kept = [*left.columns, *[c for c in right.columns if c not in keys]]
    return both.where(once & meet).select(*[f"`{c}`" for c in kept])
