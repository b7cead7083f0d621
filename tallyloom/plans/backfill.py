"""What to fetch: requests expanded to blocks, landed blocks removed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.contracts import DELISTED, LISTED
from tallyloom.functions.dates import bound_end, bound_start, compact_text
from tallyloom.operators import spine
from tallyloom.operators.keyed import rows_without_key

# Placeholders of date lists.
TRADE, NATURAL, MONTHS, QUARTERS, TODAY = (
    "<TRADE_DATE>", "<NATURAL_DATE>", "<MONTHLY_DATE_RANGE>", "<QUARTERLY_DATE>", "<TODAY>")
DATE_PLACEHOLDERS = (TRADE, NATURAL, MONTHS, QUARTERS, TODAY)

# Placeholders of code lists: the form of the codes and the listing status they are limited to.
CODE_PLACEHOLDERS = {
    "<LISTED_SYMBOL>": ("exchange_first", LISTED),
    "<DELISTED_SYMBOL>": ("exchange_first", DELISTED),
    "<VENDOR_SYMBOL>": ("vendor", None),
    "<DIGIT_SYMBOL>": ("digits", None),
}
# The words existing request files use for the four lists above, in the same order.
CODE_WORDS = ("<AK_LISTED_SYMBOL>", "<AK_DELISTED_SYMBOL>", "<AK_SYMBOL_EASTMONEY>", "<AK_SYMBOL_A_STOCK>")
CODE_PLACEHOLDERS |= dict(zip(CODE_WORDS, tuple(CODE_PLACEHOLDERS.values())))


def with_bounds(requests: DataFrame) -> DataFrame:
    """T6 on the text bounds ``start_date`` and ``end_date`` of each request."""
    return requests.withColumns({"start_day": bound_start(F.col("start_date")),
                                 "end_day": bound_end(F.col("end_date"))})


def expand(requests: DataFrame, calendar: DataFrame, clip_quarters: bool = False,
           master: DataFrame | None = None) -> DataFrame:
    """One row per request and period, newest first.

    Requests carry ``dataset, grain, placeholder, start_date, end_date, lookback, multiplier,
    truncate``; only those that truncate are cut to their newest ``lookback * multiplier``
    periods, at least one. The result has ``block_index``, ``param_start``, ``param_end``
    (equal, except for month ranges). With a security master, code placeholders give one row per
    code, unnumbered. What is no placeholder stays as the one value it is.
    """
    bounded = with_bounds(requests)
    limit = F.when(F.col("truncate"), spine.max_periods(F.col("lookback"), F.col("multiplier")))
    kept = [c for c in requests.columns if c not in ("start_date", "end_date")]
    name = F.col("placeholder")
    apart = [TRADE, *(CODE_PLACEHOLDERS if master is not None else ())]

    # What a request's own row determines is one list of days per row, so the requests are read
    # once. A plain value has a list of one null.
    span = F.col("start_day") <= F.col("end_day")
    plain = name.isNull() | ~name.isin(*DATE_PLACEHOLDERS)
    days = (
        F.when((name == NATURAL) & span, spine.day_list(limit))
        .when((name == MONTHS) & span, spine.month_list(limit))
        .when((name == QUARTERS) & span, spine.quarter_list(limit, clip_quarters))
        .when(name == TODAY, F.array(F.current_date()))
        .when(plain, F.array(F.lit(None).cast("date"))))
    own = bounded.where(name.isNull() | ~name.isin(*apart)).select(
        *kept, "end_day", F.posexplode(days).alias("block_index", "_day"))
    day = F.col("_day")
    last = F.when(name == MONTHS, spine.month_end(day)).otherwise(day)
    parts = [own.select(*kept, "block_index",
                        F.when(plain, name).otherwise(compact_text(day)).alias("param_start"),
                        F.when(plain, name).otherwise(compact_text(last)).alias("param_end"))]

    traded = spine.trade_days(bounded.where(name == TRADE), calendar, limit)
    day = compact_text(F.col("trade_day"))
    parts.append(traded.select(*kept, F.col("entry").alias("block_index"),
                               day.alias("param_start"), day.alias("param_end")))
    if master is not None:
        parts.append(_codes(requests.select(*kept), master))
    return reduce(DataFrame.unionByName, parts)


def _codes(requests: DataFrame, master: DataFrame) -> DataFrame:
    """Requests for code lists, one row per code."""
    lists = reduce(DataFrame.unionByName, [
        spine.entity_spine(master, form, status).withColumn("placeholder", F.lit(name))
        for name, (form, status) in CODE_PLACEHOLDERS.items()])
    return requests.join(lists, "placeholder").select(
        *requests.columns, F.lit(None).cast("int").alias("block_index"),
        F.col("code").alias("param_start"), F.col("code").alias("param_end"))


def block_period(blocks: DataFrame) -> DataFrame:
    """The period label under which a block's extract lands."""
    start = F.col("param_start")
    quarter = F.ceil(F.substring(start, 5, 2).cast("int") / 3).cast("string")
    return blocks.withColumn("period", F.when(F.col("grain") == "MONTHLY", F.substring(start, 1, 6))
                             .when(F.col("grain") == "QUARTERLY",
                                   F.concat(F.substring(start, 1, 4), F.lit("Q"), quarter))
                             .when(F.col("grain") == "SNAPSHOT", F.lit("snapshot"))
                             .otherwise(start))


def missing_blocks(blocks: DataFrame, landed: DataFrame, force: bool = False) -> DataFrame:
    """Blocks whose (dataset, period) has not landed; ``force`` keeps all."""
    if force:
        return blocks
    return rows_without_key(blocks, landed.select("dataset", "period"), ["dataset", "period"])


def backfill_plan(requests: DataFrame, calendar: DataFrame, landed: DataFrame,
                  force: bool = False, clip_quarters: bool = False,
                  master: DataFrame | None = None) -> DataFrame:
    """Requests to spines to blocks, only what is missing."""
    blocks = block_period(expand(requests, calendar, clip_quarters, master))
    return missing_blocks(blocks, landed, force)
