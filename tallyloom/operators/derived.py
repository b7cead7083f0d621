"""Derived statement metrics.

Each row is sent to the periods it takes part in and the periods are grouped, so a symbol's
history is never gathered: the grouping key is (symbol, period), not the symbol.
A period is numbered ``year * 4 + quarter - 1``. (symbol, period) must be unique; a period that is
there twice stops the job and is named, as either value could be the right one. Choose with one of
the strategies in ``operators/resolve.py`` first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.contracts import MAX_NEGATIVE_QUARTER_RATIO, MIN_TTM_COVERAGE


def period_number(year: Column, quarter: Column) -> Column:
    return year * 4 + quarter - 1


def _once(merged: DataFrame, key: str) -> DataFrame:
    """Periods that are there, each once; ``rows`` counts a period's own rows."""
    named = F.concat_ws(" ", F.lit("repeated period:"), F.col(key).cast("string"),
                        F.floor(F.col("p") / 4).cast("string"), (F.col("p") % 4 + 1).cast("string"))
    single = F.when(F.col("rows") > 1, F.raise_error(named).cast("boolean")).otherwise(F.col("rows") == 1)
    return merged.where(single)


def _with_shifted(df: DataFrame, key: str, year: str, quarter: str, value: str,
                  shift: int) -> DataFrame:
    """Each period with its own value and that of ``shift`` periods before."""
    number = period_number(F.col(year), F.col(quarter)).cast("int")
    own = F.struct(number.alias("p"), F.lit(True).alias("own"), F.col(value).alias("now"),
                   F.lit(None).cast("double").alias("then"))
    later = F.struct((number + shift).alias("p"), F.lit(False).alias("own"),
                     F.lit(None).cast("double").alias("now"), F.col(value).alias("then"))
    sent = df.withColumn(value, F.col(value).cast("double")).select(
        key, F.inline(F.array(own, later)))
    merged = sent.groupBy(key, "p").agg(F.count_if("own").alias("rows"), F.max("now").alias("now"),
                                        F.max("then").alias("then"))
    return _once(merged, key).select(
        key, F.floor(F.col("p") / 4).cast("int").alias(year),
        (F.col("p") % 4 + 1).cast("int").alias(quarter), "now", "then")


def single_quarter(df: DataFrame, key: str, year: str, quarter: str, cumulative: str,
                   target: str) -> DataFrame:
    """Cumulative value minus the previous quarter's of the same year.

    The first quarter is its own value; a gap in the year gives null.
    """
    both = _with_shifted(df, key, year, quarter, cumulative, 1)
    value = F.when(F.col(quarter) == 1, F.col("now")).otherwise(F.col("now") - F.col("then"))
    return both.select(key, year, quarter, F.col("now").alias(cumulative), value.alias(target))


def growth(df: DataFrame, key: str, year: str, quarter: str, value: str, target: str,
           periods: int) -> DataFrame:
    """Change against 4 (year on year) or 1 (quarter on quarter) periods before.

    Relative to the absolute base; null without a base or with a base of 0.
    """
    both = _with_shifted(df, key, year, quarter, value, periods)
    rate = F.try_divide(F.col("now") - F.col("then"), F.abs("then"))
    return both.select(key, year, quarter, F.col("now").alias(value), rate.alias(target))


def trailing_year(df: DataFrame, key: str, year: str, quarter: str, value: str,
                  target: str) -> DataFrame:
    """Sum of a quarter and the three before it, null unless all four have a value."""
    number = period_number(F.col(year), F.col(quarter)).cast("int")
    sent = df.select(key, number.alias("_from"), F.col(value).cast("double").alias("_v"),
                     F.explode(F.sequence(number, number + 3)).alias("p"))
    own = F.col("_from") == F.col("p")
    merged = sent.groupBy(key, "p").agg(
        F.count_if(own).alias("rows"), F.max(F.when(own, F.col("_v"))).alias("now"),
        F.count("_v").alias("n"), F.sum("_v").alias("total"))
    return _once(merged, key).select(
        key, F.floor(F.col("p") / 4).cast("int").alias(year),
        (F.col("p") % 4 + 1).cast("int").alias(quarter), F.col("now").alias(value),
        F.when(F.col("n") == 4, F.col("total")).alias(target))


def negative_share(df: DataFrame, target: str,
                   most: float = MAX_NEGATIVE_QUARTER_RATIO) -> DataFrame:
    """Share of single quarters below zero, and whether it is small enough."""
    negative = F.count_if(F.col(target) < 0)
    share = F.coalesce(F.try_divide(negative, F.count(target)), F.lit(0.0))
    return df.agg(F.count(target).alias("n_values"), negative.alias("n_negative"),
                  (share <= most).alias("plausible"))


def trailing_coverage(df: DataFrame, target: str, least: float = MIN_TTM_COVERAGE) -> DataFrame:
    """Share of rows that have a trailing-year value, and whether it is enough."""
    share = F.try_divide(F.count(target), F.count("*"))
    return df.agg(F.count("*").alias("n_rows"), F.count(target).alias("n_covered"),
                  (share >= least).alias("enough"))
