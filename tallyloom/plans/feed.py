"""From cleaned tables to the feed."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.codes import to_feed_code
from tallyloom.functions.dates import parse_compact
from tallyloom.operators.asof import asof_join
from tallyloom.operators.columns import ordered
from tallyloom.operators.filters import first_entities
from tallyloom.operators.keyed import rows_with_key
from tallyloom.operators.lookup import left_fold
from tallyloom.operators.measures import calendar_days, instruments
from tallyloom.operators.reshape import statements_to_point_in_time
from tallyloom.operators.spine import available_from
from tallyloom.sinks.layout import write_partitions
from tallyloom.sinks.writers import in_ranges, write_feed_lists, write_per_entity


def daily_feed(sources: Mapping[str, DataFrame], required: Sequence[str],
               optional: Sequence[str] = (), factor: str = "factor", basic: Sequence[str] = (),
               clash: str = "drop", limit_symbols: int | None = None,
               on_invalid: str = "raise") -> DataFrame:
    """The first source with the others joined on, one row per code and day."""
    (_, base), *others = sources.items()
    others = dict(others)
    if limit_symbols:
        base = first_entities(base, "ts_code", limit_symbols)
        chosen = base.select("ts_code").distinct()
        others = {n: rows_with_key(o, chosen, ["ts_code"]) for n, o in others.items()}
    joined = left_fold(base, others, clash=clash)
    dated = joined.withColumns({"symbol": to_feed_code(F.col("ts_code"), on_invalid=on_invalid),
                                "date": parse_compact(F.col("trade_date"))})
    return ordered(dated, ["symbol", "date", *required, *optional, factor, *basic])


def sort_day(columns: Sequence[str]) -> str:
    """O2: the first date column there is."""
    return next(c for c in ("date", "trade_date", "datetime") if c in columns)


def write_daily(feed: DataFrame, path: str) -> int:
    """K4, K5: per-entity files plus calendar and instrument list."""
    day = sort_day(feed.columns)
    count = write_per_entity(feed, f"{path}/features", "symbol", day, upper=True)
    write_feed_lists(calendar_days(feed, day), instruments(feed, day=day), f"{path}/metadata")
    return count


def point_in_time_feed(sources: Mapping[str, DataFrame], interval: str = "quarterly",
                       field_names: Mapping[str, Mapping[str, str]] | None = None) -> DataFrame:
    """R4."""
    return statements_to_point_in_time(sources, interval, field_names)


def point_in_time_panel(days: DataFrame, statements: DataFrame, calendar: DataFrame, values: Sequence[str],
                        per_field: bool = False) -> DataFrame:
    """Every (symbol, date) with the statement values known by then.

    ``statements`` carry ``symbol`` and the day ``ann_date``; a value is known from the first open day after
    its announcement. Of values known from one day the latest announced counts, then the largest.
    """
    known = available_from(statements, calendar, "ann_date", "available")
    tied = ["ann_date", *[c for c in values if c != "ann_date"]]
    panel = asof_join(days, known, ["symbol"], "date", "available", tied, per_field=per_field)
    return panel if per_field else panel.drop(*[c for c in ("ann_date", "available") if c not in values])


def write_point_in_time(feed: DataFrame, path: str, replace: str = "partitions") -> None:
    """All statement tables in one write, a directory per table and symbol.

    Other tables and symbols keep their files; ``replace="all"`` drops them.
    """
    keys = ("data_type", "symbol", "datetime", "field")
    write_partitions(in_ranges(feed, *keys), path, ("data_type", "symbol"), "csv", replace, many=True, header=True)


def run_converters(converters: Mapping[str, Callable[[], int]]) -> list[dict]:
    """Runs each converter; one that fails does not stop the others."""
    runs = []
    for name, convert in converters.items():
        began = time.monotonic()
        run = {"task_id": name, "data_type": "feed", "execution_status": "SUCCESS"}
        try:
            run["data_rows"] = convert()
        except Exception as error:  # a converter may fail in any way; the log says how
            run |= {"execution_status": "FAILED", "error_message": str(error).splitlines()[0]}
        run["duration_ms"] = int((time.monotonic() - began) * 1000)
        runs.append(run)
    return runs
