"""Audit rules over one table.

A whole audit reads the table three times, whatever the number of rules and columns: once for means
and deviations, once for every count that needs no grouping, once for duplicates of the key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.contracts import (
    MAX_DUPLICATE_RATIO, MAX_NULL_RATIO, OUTLIER_STD, OUTLIER_WARNING_RATIO, TYPE_FAMILIES)
from tallyloom.functions.dates import as_day
from tallyloom.operators.columns import missing_fields
from tallyloom.operators.measures import duplicate_count, null_profile

RESULT_SCHEMA = ("rule_id string, name string, category string, level string, status string, "
                 "message string, details map<string,string>")

# The rules with their category and level.
RULES = {
    "DQ001": ("null ratio", "data_quality", "WARNING"),
    "DQ002": ("duplicate ratio", "data_quality", "ERROR"),
    "DQ003": ("outliers", "data_quality", "INFO"),
    "DQ004": ("column types", "data_quality", "ERROR"),
    "SC001": ("required columns", "schema_compliance", "CRITICAL"),
    "SC002": ("key uniqueness", "schema_compliance", "CRITICAL"),
    "PIT001": ("announcement after period end", "pit_compliance", "ERROR"),
}


@dataclass(frozen=True)
class CustomRule:
    """A rule of the caller: ``check`` maps the table to (status, message) columns of one row."""
    rule_id: str
    name: str
    category: str
    level: str
    check: Callable[[DataFrame], DataFrame]


def result(rule_id: str, status: Column, message: Column, details: Column | None = None) -> Column:
    name, category, level = RULES[rule_id]
    return _entry(rule_id, name, category, level, status, message, details)


def _entry(rule_id, name, category, level, status, message, details=None) -> Column:
    return F.struct(
        F.lit(rule_id).alias("rule_id"), F.lit(name).alias("name"),
        F.lit(category).alias("category"), F.lit(level).alias("level"),
        status.alias("status"), message.alias("message"),
        (details if details is not None else F.create_map().cast("map<string,string>"))
        .alias("details"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def over_null_limit(df: DataFrame, max_ratio: float = MAX_NULL_RATIO) -> DataFrame:
    """Q1: columns with too many nulls."""
    return null_profile(df).where(F.col("null_ratio") > max_ratio)


def duplicate_ratio(df: DataFrame, keys: Sequence[str],
                    max_ratio: float = MAX_DUPLICATE_RATIO) -> DataFrame:
    """Q2: share of rows beyond the first per key; without any key column SKIP."""
    present = [k for k in keys if k in df.columns]
    if not present:
        return df.limit(0).agg(F.lit(0).cast("bigint").alias("n_rows"),
                               F.lit(0).cast("bigint").alias("n_duplicates"),
                               F.lit(None).cast("double").alias("duplicate_ratio"),
                               F.lit("SKIP").alias("status"))
    ratio = F.coalesce(F.try_divide(F.col("n_duplicates"), F.col("n_rows")), F.lit(0.0))
    return duplicate_count(df, present).select(
        "n_rows", "n_duplicates", ratio.alias("duplicate_ratio"),
        F.when(ratio <= max_ratio, "PASS").otherwise("FAIL").alias("status"))


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q6: no row may repeat the key; without keys SKIP, without their columns FAIL."""
    present = [k for k in keys if k in df.columns]
    if not present:
        return df.limit(0).agg(F.lit(0).cast("bigint").alias("n_duplicates"),
                               F.lit("FAIL" if keys else "SKIP").alias("status"))
    return duplicate_count(df, present).select(
        "n_duplicates", F.when(F.col("n_duplicates") == 0, "PASS").otherwise("FAIL").alias("status"))


def _moments(df: DataFrame, names: Sequence[str]) -> Column:
    """Means ``_m<i>`` and deviations ``_s<i>`` as one scalar subquery."""
    moments = df.agg(*[f(F.col(f"`{c}`").cast("double")).alias(f"{p}{i}")
                       for i, c in enumerate(names)
                       for p, f in (("_m", F.avg), ("_s", F.stddev_samp))])
    return moments.select(F.struct("*").alias("_stats")).scalar()


def _far_counts(names: Sequence[str], stats: Column, threshold: float) -> list[Column]:
    """Values beyond the threshold, ``_far<i>``; a column without spread has none."""
    return [F.count_if((stats[f"_s{i}"] > 0)
                       & (F.abs(F.col(f"`{c}`").cast("double") - stats[f"_m{i}"])
                          > threshold * stats[f"_s{i}"])).alias(f"_far{i}")
            for i, c in enumerate(names)]


def outlier_profile(df: DataFrame, columns: Sequence[str] | None = None,
                    threshold: float = OUTLIER_STD) -> DataFrame:
    """Mean, deviation and count of far values per numeric column with spread."""
    names = [c for c in (columns or numeric_columns(df)) if c in df.columns]
    stats = _moments(df, names)
    counts = df.agg(F.count("*").alias("_rows"), *_far_counts(names, stats, threshold))
    entries = [F.struct(F.lit(c).alias("column_name"), stats[f"_m{i}"].alias("mean"),
                        stats[f"_s{i}"].alias("std"), F.col(f"_far{i}").alias("n_outliers"))
               for i, c in enumerate(names)]
    rows = counts.select("_rows", F.inline(F.array(*entries))).where(F.col("std") > 0)
    return rows.select("column_name", "mean", "std", "n_outliers",
                       F.try_divide(F.col("n_outliers"), F.col("_rows")).alias("outlier_ratio"))


def type_issues(df: DataFrame, expected: Mapping[str, str]) -> dict[str, tuple[str, str]]:
    """Q4: columns whose type is not of the expected family; no job runs."""
    issues = {}
    for name, family in expected.items():
        if name not in df.columns:
            continue
        dtype = df.schema[name].dataType
        known = next((f for f in TYPE_FAMILIES if family.startswith(f)), None)
        if not (known and isinstance(dtype, TYPE_FAMILIES[known])
                or dtype.simpleString() == family):
            issues[name] = (family, dtype.simpleString())
    return issues


def _order_counts(df: DataFrame, announced: str, period_end: str) -> list[Column]:
    first, second = as_day(df, announced), as_day(df, period_end)
    unreadable = ((F.col(announced).isNotNull() & first.isNull())
                  | (F.col(period_end).isNotNull() & second.isNull()))
    return [F.count_if(first <= second).alias("n_invalid"),
            F.count_if(unreadable).alias("n_unreadable")]


def _order_status() -> Column:
    return (F.when(F.col("n_unreadable") > 0, "ERROR").when(F.col("n_invalid") == 0, "PASS")
            .otherwise("FAIL"))


def announcement_order(df: DataFrame, announced: str = "ann_date",
                       period_end: str = "period_end") -> DataFrame:
    """Q7: announcements on or before the period end; text that is no date is counted apart."""
    counts = df.agg(F.count("*").alias("n_rows"), *_order_counts(df, announced, period_end))
    return counts.withColumn("status", _order_status())


def _details(**values) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(k) for k in values]),
                             F.array(*[v.cast("string") for v in values.values()]))


def audit(df: DataFrame, keys: Sequence[str], expected_types: Mapping[str, str] | None = None,
          required: Sequence[str] | None = None, announced: str = "ann_date",
          period_end: str = "period_end", disabled: Sequence[str] = (),
          custom: Sequence[CustomRule] = ()) -> DataFrame:
    """Q8: one result row per enabled rule."""
    numbers = numeric_columns(df)
    dated = announced in df.columns and period_end in df.columns
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null{i}")
          for i, c in enumerate(df.columns)],
        *(_far_counts(numbers, _moments(df, numbers), OUTLIER_STD) if numbers else ()),
        *(_order_counts(df, announced, period_end) if dated else ()))

    def ratios(prefix, n):
        return F.array(*[F.coalesce(F.try_divide(F.col(f"{prefix}{i}"), F.col("_rows")),
                                    F.lit(0.0)) for i in range(n)])

    nulls = ratios("_null", len(df.columns))
    over = F.size(F.filter(nulls, lambda r: r > MAX_NULL_RATIO))
    entries = [result("DQ001", F.when(over == 0, "PASS").otherwise("FAIL"),
                      F.format_string("%d columns over the null limit", over),
                      _details(worst_ratio=F.array_max(nulls), threshold=F.lit(MAX_NULL_RATIO)))]
    if numbers:
        worst = F.array_max(ratios("_far", len(numbers)))
        entries.append(result(
            "DQ003", F.when(worst < OUTLIER_WARNING_RATIO, "PASS").otherwise("WARNING"),
            F.lit(f"{len(numbers)} numeric columns checked"),
            _details(worst_ratio=worst, threshold=F.lit(OUTLIER_STD))))
    if dated:
        entries.append(result(
            "PIT001", _order_status(),
            F.format_string("%d announcements not after the period end", "n_invalid"),
            _details(invalid=F.col("n_invalid"), unreadable=F.col("n_unreadable"))))
    parts = [counts.select(F.explode(F.array(*entries)).alias("r"))]

    present = [k for k in keys if k in df.columns]
    if present:
        both = duplicate_ratio(df, present)
        parts.append(both.select(F.explode(F.array(
            result("DQ002", F.col("status"), F.format_string("%d duplicate rows", "n_duplicates"),
                   _details(ratio=F.col("duplicate_ratio"), total=F.col("n_rows"))),
            result("SC002", F.when(F.col("n_duplicates") == 0, "PASS").otherwise("FAIL"),
                   F.format_string("%d duplicate rows", "n_duplicates"),
                   _details(duplicates=F.col("n_duplicates"),
                            keys=F.lit(",".join(present)))))).alias("r")))

    parts.append(_static_results(df, keys, present, expected_types or {},
                                 list(required if required is not None else keys),
                                 bool(numbers), dated))
    for rule in custom:
        parts.append(_custom_result(df, rule))
    rows = reduce(DataFrame.unionByName, parts).select("r.*")
    return rows.where(~F.col("rule_id").isin(*disabled)) if disabled else rows


def _static_results(df, keys, present, expected_types, required, has_numbers,
                    dated) -> DataFrame:
    """The results that follow from the schema alone."""
    def fixed(rule_id, status, message, **details):
        return result(rule_id, F.lit(status), F.lit(message),
                      _details(**{k: F.lit(v) for k, v in details.items()}) if details else None)

    issues, missing = type_issues(df, expected_types), missing_fields(df, required)
    entries = [
        fixed("DQ004", "FAIL" if issues else "PASS", f"{len(issues)} columns of another type",
              issues=";".join(f"{n}:{want}:{got}" for n, (want, got) in issues.items())),
        fixed("SC001", "FAIL" if missing else "PASS", f"{len(missing)} columns missing",
              missing=",".join(missing)),
    ]
    if not present:
        entries.append(fixed("DQ002", "SKIP", "no key columns"))
        entries.append(fixed("SC002", "FAIL" if keys else "SKIP", "no key columns"))
    if not has_numbers:
        entries.append(fixed("DQ003", "PASS", "0 numeric columns checked"))
    if not dated:
        entries.append(fixed("PIT001", "SKIP", "date columns missing"))
    one = df.sparkSession.range(1)
    return one.select(F.explode(F.array(*entries)).alias("r"))


def _custom_result(df: DataFrame, rule: CustomRule) -> DataFrame:
    """A custom rule that cannot be planned becomes an ERROR row."""
    known = {category for _, category, _ in RULES.values()}
    try:
        if rule.category not in known:
            raise ValueError(f"no checker for category {rule.category}")
        checked = rule.check(df)
        checked.schema  # analysis happens here, before the union
        return checked.select(_entry(rule.rule_id, rule.name, rule.category, rule.level,
                                     F.col("status"), F.col("message")).alias("r"))
    except (AnalysisException, ValueError) as error:
        text = str(error).splitlines()[0]
        return df.sparkSession.range(1).select(
            _entry(rule.rule_id, rule.name, rule.category, rule.level, F.lit("ERROR"),
                   F.lit(text)).alias("r"))


def rollup(results: DataFrame) -> DataFrame:
    """Results counted by status, level and category in one pass."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value"))
                      for d in ("status", "level", "category")])
    return (results.select(F.inline(pairs)).groupBy("dimension", "value")
            .agg(F.count("*").alias("n_results")))


def verdict(results: DataFrame) -> DataFrame:
    """Flags for critical and error failures, and the pass rate."""
    failed = F.col("status") == "FAIL"
    return results.agg(
        F.coalesce(F.bool_or(failed & (F.col("level") == "CRITICAL")), F.lit(False))
        .alias("has_critical_issues"),
        F.coalesce(F.bool_or(failed & (F.col("level") == "ERROR")), F.lit(False))
        .alias("has_errors"),
        F.coalesce(F.try_divide(F.count_if(F.col("status") == "PASS"), F.count("*")), F.lit(0.0))
        .alias("pass_rate"))


def quality_report(df: DataFrame) -> DataFrame:
    """Q10: rows, columns, duplicate rows and the null count of each column that has nulls."""
    whole = duplicate_count(df, df.columns)
    general = whole.select(F.inline(F.array(
        F.struct(F.lit("rows").alias("measure"), F.col("n_rows").alias("value")),
        F.struct(F.lit("columns").alias("measure"),
                 F.lit(len(df.columns)).cast("bigint").alias("value")),
        F.struct(F.lit("duplicate_rows").alias("measure"), F.col("n_duplicates").alias("value")))))
    nulls = null_profile(df).where(F.col("n_null") > 0).select(
        F.concat(F.lit("nulls:"), F.col("column_name")).alias("measure"),
        F.col("n_null").alias("value"))
    return general.unionByName(nulls)


def field_presence(feed: DataFrame, expected: Sequence[str], key: str = "symbol") -> DataFrame:
    """Q11: per entity of a point-in-time feed, how many of the expected fields it has."""
    found = feed.where(F.col("field").isin(*expected)).groupBy(key, "field").agg(
        F.count("*").alias("n_values"))
    return found.groupBy(key).agg(F.count("*").alias("n_fields"),
                                  F.sum("n_values").alias("n_values"),
                                  (F.count("*") == len(expected)).alias("complete"))


def feed_check(feed: DataFrame, key: str = "symbol") -> DataFrame:
    """Q11: rows and null counts per entity of a written feed."""
    fields = [c for c in feed.columns if c != key]
    return feed.groupBy(key).agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in fields])
