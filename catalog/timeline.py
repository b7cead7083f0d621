"""Queries on what was known when."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from tallyloom.functions.dates import compact_text, parse_compact
from tallyloom.operators import spine
from tallyloom.operators.asof import asof_join
from tallyloom.plans.feed import point_in_time_panel

STATEMENTS = "(select substr(ts_code, 1, 6) as symbol, end_date, ann_date, revenue, profit from v_stmt_clean) s"


def statements(t):
    return t.view("v_stmt_clean").withColumn("symbol", F.substring("ts_code", 1, 6)).drop("ts_code")


@query("pit_asof", f"""
    select d.symbol, d.trade_date, d.low, s.ann_date, s.end_date, s.revenue, s.profit
    from v_daily_raw d asof left join {STATEMENTS} on d.symbol = s.symbol and d.trade_date >= s.ann_date""")
def _(t):
    """Every trade day with the statement announced last by then."""
    days = t.view("v_daily_raw").select("symbol", "trade_date", "low")
    return asof_join(days, statements(t), ["symbol"], "trade_date", "ann_date", ["end_date", "revenue", "profit"])


@query("pit_asof_strict", f"""
    select d.symbol, d.trade_date, s.ann_date, s.revenue
    from v_daily_raw d asof left join {STATEMENTS} on d.symbol = s.symbol and d.trade_date > s.ann_date""")
def _(t):
    days = t.view("v_daily_raw").select("symbol", "trade_date")
    return asof_join(days, statements(t), ["symbol"], "trade_date", "ann_date", ["revenue"], strict=True)


@query("pit_asof_fields", f"""
    select d.symbol, d.trade_date, r.ann_date as revenue_known, r.revenue, p.ann_date as profit_known, p.profit
    from v_daily_raw d
    asof left join (select * from {STATEMENTS} where revenue is not null) r
      on d.symbol = r.symbol and d.trade_date >= r.ann_date
    asof left join (select * from {STATEMENTS} where profit is not null) p
      on d.symbol = p.symbol and d.trade_date >= p.ann_date""")
def _(t):
    """Every trade day with the last known value of each field, which need not be of one statement."""
    days = t.view("v_daily_raw").select("symbol", "trade_date")
    return asof_join(days, statements(t), ["symbol"], "trade_date", "ann_date", ["revenue", "profit"], per_field=True)


@query("pit_panel", f"""
    with open_days as (select cal_date from v_calendar where is_open = 1),
    known as (select s.symbol, s.end_date, s.revenue, s.ann_date,
                     (select min(cast(cal_date as int)) from open_days where cast(cal_date as int) > s.ann_date) as available
              from {STATEMENTS}),
    last as (select * from (select *, row_number() over (partition by symbol, available
                                    order by ann_date desc, end_date desc, revenue desc) as rn from known
                            where available is not null) x where rn = 1)
    select d.symbol, strftime(strptime(cast(d.trade_date as varchar), '%Y%m%d'), '%Y-%m-%d') as date, d.low,
           k.end_date, k.revenue
    from v_daily_raw d asof left join last k on d.symbol = k.symbol and d.trade_date >= k.available""")
def _(t):
    """As above, a statement being known from the first open day after its announcement."""
    days = t.view("v_daily_raw").select(
        "symbol", parse_compact(F.col("trade_date").cast("string")).alias("date"), "low")
    told = statements(t).withColumn("ann_date", parse_compact(F.col("ann_date").cast("string")))
    panel = point_in_time_panel(days, told, t.view("v_calendar"), ["end_date", "revenue"])
    return panel.select("symbol", F.col("date").cast("string").alias("date"), "low", "end_date", "revenue")
