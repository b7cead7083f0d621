"""Date text, periods and calendar arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def compact_date_text(c: Column) -> Column:
    """ISO, dashed or timed date text to ``yyyyMMdd``; other text is trimmed only."""
    text = F.trim(c)
    timed = text.contains(" ") & text.contains(":")
    day = (
        F.when(text.contains("T"), F.split_part(text, F.lit("T"), F.lit(1)))
        .when(timed, F.split_part(text, F.lit(" "), F.lit(1)))
        .otherwise(text)
    )
    return F.replace(day, F.lit("-"), F.lit(""))


def normalise_date(df: DataFrame, source: str, target: str | None = None) -> DataFrame:
    """F1 on a column of any type; dates and timestamps are formatted."""
    target = target or source
    dtype = df.schema[source].dataType
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return df.withColumn(target, F.date_format(source, "yyyyMMdd"))
    return df.withColumn(target, compact_date_text(F.col(source).cast("string")))


def _whole(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b)).cast("int")


def parse_compact(c: Column) -> Column:
    """F8: ``yyyyMMdd`` (text or number) to a date; what is no date gives null.

    Plain arithmetic, which costs a tenth of matching a date pattern.
    """
    number = c.try_cast("int")
    year, month, day = _whole(number, 10000), _whole(number % 10000, 100), number % 100
    first = F.make_date(year, month, F.lit(1))
    return F.when(
        year.between(1, 9999) & month.between(1, 12),
        F.when(day.between(1, F.dayofmonth(F.last_day(first))), F.date_add(first, day - 1)))


def as_day(df: DataFrame, name: str) -> Column:
    """A column of any type as a date; text and numbers are read as ``yyyyMMdd``, ISO, or ISO with slashes."""
    dtype, c = df.schema[name].dataType, F.col(name)
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    if isinstance(dtype, T.NumericType):
        return parse_compact(c)
    return F.coalesce(parse_compact(c), F.replace(c, F.lit("/"), F.lit("-")).try_cast("date"))


def day_order(df: DataFrame, name: str) -> Column:
    """A number that orders the days of a column; ``yyyyMMdd`` numbers are in order already."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("bigint")
    return F.unix_date(as_day(df, name)).cast("bigint")


def compact_int(c: Column) -> Column:
    """A date as the number ``yyyyMMdd``."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def compact_text(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def fiscal_period(end_date: Column, interval: str = "quarterly") -> Column:
    """``yyyyMMdd`` to ``yyyyqq`` (quarterly) or ``yyyy`` (annual)."""
    number = end_date.cast("int")
    year = _whole(number, 10000)
    if interval == "annual":
        return year
    return year * 100 + _whole(_whole(number % 10000, 100) - 1, 3) + 1


def _first_match(text: Column, pattern: str) -> Column:
    """First group of the first match, null without one; the pattern runs once per row."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0))


def quarter_end_from_path(path: Column) -> Column:
    """the first ``yyyyQn`` in a path as the last day of that quarter."""
    label = _first_match(path, r"(\d{4}Q\d)")
    ends = F.create_map(*[F.lit(x) for x in ("1", "0331", "2", "0630", "3", "0930")])
    tail = F.coalesce(F.try_element_at(ends, F.substring(label, 6, 1)), F.lit("1231"))
    return F.concat(F.substring(label, 1, 4), tail)


# Period notations in a landing path, tried in this order.
PATH_PERIODS = (
    r"(\d{6}/\d{2})",                 # day
    r"(\d{6})(?:/|$)",                # month
    r"(\d{4}[Qq][1-4])(?:/|$)",       # quarter
    r"(\d{4})(?:/|$)",                # year
)


def path_period(path: Column) -> Column:
    """the period label in a path (``yyyyMMdd``, ``yyyyMM``, ``yyyyQn``, ``yyyy``) or null."""
    found = F.coalesce(*[_first_match(path, pattern) for pattern in PATH_PERIODS])
    return F.replace(found, F.lit("/"), F.lit(""))


def period_grain(label: Column) -> Column:
    """The grain a period label has by its form."""
    return (F.when(F.upper(label).contains("Q"), "quarterly").when(F.length(label) == 8, "daily")
            .when(F.length(label) == 6, "monthly").when(F.length(label) == 4, "yearly"))


def period_start(label: Column) -> Column:
    """First day a period label covers; null when the label is no real period."""
    quarter = F.upper(label).contains("Q")
    month = F.lpad((F.substring(label, 6, 1).try_cast("int") * 3 - 2).cast("string"), 2, "0")
    tail = (F.when(quarter, F.concat(month, F.lit("01"))).when(F.length(label) == 4, "0101")
            .when(F.length(label) == 6, "01").otherwise(""))
    head = F.when(quarter, F.substring(label, 1, 4)).otherwise(label)
    return parse_compact(F.concat(head, tail))


def period_end(label: Column, start: Column) -> Column:
    """Last day a period label covers, from its first."""
    months = F.when(F.upper(label).contains("Q"), 3).when(F.length(label) == 4, 12).otherwise(1)
    return F.when(F.length(label) == 8, start).otherwise(
        F.last_day(F.add_months(start, months - 1)))


def bound_start(text: Column) -> Column:
    """``yyyyMM`` or ``yyyyMMdd`` to the first day it names; null stays, other text raises."""
    return _bound(text, F.to_date(F.concat(text, F.lit("01")), "yyyyMMdd"))


def bound_end(text: Column) -> Column:
    """``yyyyMM`` or ``yyyyMMdd`` to the last day it names; null stays, other text raises."""
    return _bound(text, F.last_day(F.to_date(F.concat(text, F.lit("01")), "yyyyMMdd")))


def _bound(text: Column, month_value: Column) -> Column:
    return (
        F.when(text.isNull(), F.lit(None).cast("date"))
        .when(F.length(text) == 6, month_value)
        .when(F.length(text) == 8, F.to_date(text, "yyyyMMdd"))
        .otherwise(F.raise_error(F.concat(F.lit("date must be yyyyMM or yyyyMMdd: "), text))
                   .cast("date"))
    )


# Request parameters that can carry the storage date, in order of preference.
DATE_PARAMETERS = ("daily_date", "monthly_date", "quarterly_date", "trade_date", "month",
                   "quarter", "date", "period", "end_date", "ann_date")


def storage_date(columns: list[str], grain: Column) -> Column:
    """F16: first date parameter present, else derived from ``start_date`` by grain."""
    direct = [F.col(n) for n in DATE_PARAMETERS if n in columns]
    if "start_date" in columns:
        start = F.col("start_date")
        month = F.substring(start, 5, 2)
        quarter_end = F.concat(
            F.substring(start, 1, 4),
            F.when(month <= "03", "0331").when(month <= "06", "0630")
            .when(month <= "09", "0930").otherwise("1231"))
        long_enough = F.length(start) >= 6
        direct.append(
            F.when((F.upper(grain) == "MONTHLY") & long_enough, F.substring(start, 1, 6))
            .when(F.upper(grain) == "DAILY", start)
            .when((F.upper(grain) == "QUARTERLY") & long_enough, quarter_end))
    return F.coalesce(*direct) if direct else F.lit(None).cast("string")
