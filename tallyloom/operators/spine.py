"""Date spines for request rows.

A spine is built per request row from its own bounds, so many requests expand in parallel. Each
request has ``start_day`` and ``end_day`` (dates) and may limit itself to its newest
``max_periods`` entries; null means no limit. Entries count from 0, newest first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.codes import digits_only, exchange_first
from tallyloom.operators.filters import open_days
from tallyloom.session import as_table

MOST_DAYS = 146_097  # of a calendar, 400 years: bounds what is numbered in one task and broadcast


def max_periods(lookback: Column, multiplier: Column) -> Column:
    """O3: whole number of periods to keep, at least one."""
    return F.greatest(F.lit(1), F.floor(lookback * multiplier).cast("int"))


def _newest(entries: Column, limit: Column | None) -> Column:
    """O3: the newest entries first, cut to the limit where there is one."""
    newest_first = F.reverse(entries)
    if limit is None:
        return newest_first
    return F.slice(newest_first, F.lit(1), F.coalesce(limit, F.size(entries)))


def _valid_span(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("start_day") <= F.col("end_day"))


def day_list(limit: Column | None = None) -> Column:
    """T2 as an array of days, newest first."""
    return _newest(F.sequence("start_day", "end_day"), limit)


def month_list(limit: Column | None = None) -> Column:
    """T3 as an array of month starts, newest first."""
    return _newest(F.sequence(F.trunc("start_day", "MM"), "end_day", F.expr("interval 1 month")),
                   limit)


def month_end(start: Column) -> Column:
    """The end of a month, clipped to the last day asked for."""
    return F.least(F.last_day(start), F.col("end_day"))


def quarter_list(limit: Column | None = None, clip: bool = False) -> Column:
    """T4 as an array of quarter ends, newest first."""
    first = F.make_date(F.year("start_day") - 1, F.lit(3), F.lit(1))
    last = F.make_date(F.year("end_day"), F.lit(12), F.lit(1))
    ends = F.transform(F.sequence(first, last, F.expr("interval 3 months")), F.last_day)
    if clip:
        ends = F.filter(ends, lambda d: d.between(F.col("start_day"), F.col("end_day")))
    return _newest(ends, limit)


def natural_days(requests: DataFrame, limit: Column | None = None) -> DataFrame:
    """Every day of the closed range."""
    return _valid_span(requests).select("*", F.posexplode(day_list(limit)).alias("entry", "day"))


def month_ranges(requests: DataFrame, limit: Column | None = None) -> DataFrame:
    """Month start (never clipped) and month end (clipped to the last day asked for)."""
    rows = _valid_span(requests).select(
        "*", F.posexplode(month_list(limit)).alias("entry", "month_start"))
    return rows.withColumn("month_end", month_end(F.col("month_start")))


def quarter_ends(requests: DataFrame, limit: Column | None = None,
                 clip: bool = False) -> DataFrame:
    """T4: the four quarter ends of each year from the year before the start on.

    They are not cut at the bounds unless ``clip`` is set.
    """
    return _valid_span(requests).select(
        "*", F.posexplode(quarter_list(limit, clip)).alias("entry", "quarter_end"))


def calendar_index(calendar: DataFrame) -> DataFrame:
    """Every natural day a calendar spans with the open days around it.

    Columns: ``day``, ``prior_open`` (number of the last open day on or before it), ``next_open``
    (number of the first open day on or after it), both from 1, and ``is_open``; 0 and n + 1 stand
    for none. The table has one row per day: a century is 36,525 rows, whatever the data. That
    bound is what allows numbering it in one task and broadcasting it; a calendar that spans more than
    ``MOST_DAYS``, for a day such as 9999-12-31 in it, is refused. It is written once, as it is
    looked up several times and the calendar may itself be a query.
    """
    dated = calendar.select(F.to_date("cal_date", "yyyyMMdd").alias("day"), "is_open")
    days = open_days(dated).select(F.col("day").alias("open_day")).distinct()
    span = dated.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    too_long = F.raise_error(F.concat_ws(" ", F.lit("calendar spans too many days:"), "a", "b"))
    last = F.when(F.date_diff("b", "a") >= MOST_DAYS, too_long).otherwise(F.col("b"))
    every = span.select(F.explode(F.sequence(F.col("a"), last)).alias("day"))
    marked = every.join(days, every.day == days.open_day, "left")
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = marked.withColumn("prior_open", F.count("open_day").over(running))
    closed = F.col("open_day").isNull().cast("int")
    return as_table(counted.select(
        "day", "prior_open", (F.col("prior_open") + closed).alias("next_open"),
        F.col("open_day").isNotNull().alias("is_open")), "calendar-index")


def _open_by_number(index: DataFrame) -> DataFrame:
    return index.where("is_open").select(F.col("prior_open").alias("_number"),
                                         F.col("day").alias("_open_day"))


def trade_days(requests: DataFrame, calendar: DataFrame, limit: Column | None = None) -> DataFrame:
    """The open days of the range, newest first.

    The bounds are looked up as numbers of open days, so the newest N are a sequence of numbers
    and no ranking over the expanded rows is needed.
    """
    index = calendar_index(calendar)
    span = index.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    first, last = span.select("a").scalar(), span.select("b").scalar()
    clipped = (_valid_span(requests)
               .withColumn("_from", F.greatest(F.col("start_day"), first))
               .withColumn("_to", F.least(F.col("end_day"), last))
               .where(F.col("_from") <= F.col("_to")))
    lower = index.select(F.col("day").alias("_from"), F.col("next_open").alias("_low"))
    upper = index.select(F.col("day").alias("_to"), F.col("prior_open").alias("_high"))
    bounded = (clipped.join(F.broadcast(lower), "_from").join(F.broadcast(upper), "_to")
               .where(F.col("_low") <= F.col("_high")))
    numbers = _newest(F.sequence("_low", "_high"), limit)
    numbered = bounded.select(*requests.columns, F.posexplode(numbers).alias("entry", "_number"))
    return (numbered.join(F.broadcast(_open_by_number(index)), "_number")
            .select(*requests.columns, "entry", F.col("_open_day").alias("trade_day")))


def available_from(df: DataFrame, calendar: DataFrame, announced: str,
                   target: str = "available_date", after_close: bool = True) -> DataFrame:
    """First open day after the announcement, or on it when known before the close.

    Days before the calendar map to its first open day; later ones to null.
    """
    index = calendar_index(calendar)
    first = index.agg(F.min("day").alias("a")).scalar()
    rows = df.withColumn("_asked", F.greatest(F.col(announced),
                                              F.date_sub(first, 1) if after_close else first))
    rows = rows.withColumn("_day", F.date_add("_asked", 1) if after_close else F.col("_asked"))
    rows = rows.withColumn("_day", F.when(F.col(announced).isNotNull(), F.col("_day")))
    lookup = index.select(F.col("day").alias("_day"), F.col("next_open").alias("_number"))
    days = _open_by_number(index).withColumnRenamed("_open_day", target)
    around = lookup.join(days, "_number", "left").drop("_number")
    return rows.join(F.broadcast(around), "_day", "left").drop("_day", "_asked")


def entity_spine(master: DataFrame, form: str, status: str | None = None) -> DataFrame:
    """Distinct codes in one format, optionally of one listing status.

    ``exchange_first`` and ``digits`` skip codes without an exchange; ``vendor`` keeps all.
    """
    rows = master if status is None else master.where(F.col("list_status") == status)
    code = F.col("ts_code")
    if form == "vendor":
        return rows.select(code.alias("code")).distinct()
    shapes = {"exchange_first": exchange_first, "digits": digits_only}
    return rows.where(code.contains(".")).select(shapes[form](code).alias("code")).distinct()
