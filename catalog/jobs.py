"""Queries that run whole jobs or read back what a sink wrote.

Every job works on the given tables; what it writes goes below the session's shared folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.groups import DIVIDEND_SQL, KEYS, RECON_SECTION, recon_sql
from catalog.registry import query
from catalog.rows import FEED_CODE_SQL, FLOOR, ISO_SQL, LISTED_SQL, SIGN_CHANGE, listed
from tallyloom.functions.dates import compact_text, parse_compact
from tallyloom.operators.filters import with_status
from tallyloom.operators.measures import calendar_days, instruments
from tallyloom.plans import processors
from tallyloom.plans.cleaning import clean_sources
from tallyloom.plans.collect import collect
from tallyloom.plans.feed import daily_feed, point_in_time_feed, run_converters, sort_day, write_point_in_time
from tallyloom.plans.steps import cleaning_registry
from tallyloom.quality.rules import feed_check, field_presence
from tallyloom.session import as_table, scratch_path
from tallyloom.sinks import layout, runlog, writers
from tallyloom.sinks.snapshot import ShrinkError, SnapshotStore, fingerprint
from tallyloom.sources.landing import (
    available_periods, first_files, landed_files, method_folder, period_patterns, read_layout)
from tallyloom.sources.scan import file_digests, landing_scan, read_calendar, read_csv, read_table
from tallyloom.streaming.landing import append_new, landed_stream

ORDERS_SQL = """
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y%m%d') as order_day, o_orderpriority from {orders}"""


def orders(t) -> DataFrame:
    return t.table("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        compact_text(F.col("o_orderdate")).alias("order_day"), "o_orderpriority")


# --- processors ----------------------------------------------------------------------------

STMT_SECTION = {"total": {"renamed_field": "total_amount"}, "order_key": {}}
NONEMPTY = "ts_code is not null and ts_code not in ('', ' ')"
PAIRS_SQL = f"""
    select *, count(*) over w as n, min(cast(update_flag as int)) over w as lo,
           max(cast(update_flag as int)) over w as hi, max(ann_date) over w as last_day
    from (select distinct * from v_stmt) d where {NONEMPTY}
    window w as (partition by ts_code, end_date, {{day}})"""
PAIRS, ANN_PAIRS = PAIRS_SQL.format(day="f_ann_date"), PAIRS_SQL.format(day="ann_date")
ZERO_ONE = "(n = 2 and lo = 0 and hi = 1 and update_flag <> '1')"
ONE_ONE = "(n = 2 and lo = 1 and hi = 1 and (ann_date is null or ann_date <> last_day))"
STMT_OUT = ("ts_code, f_ann_date, end_date, comp_type, ann_date, update_flag, "
            "total as total_amount, order_key")


@query("balance_job", f"""
    select {STMT_OUT} from ({PAIRS}) x
    where not {ZERO_ONE} and not coalesce({ONE_ONE}, false)""")
def _(t):
    return processors.plan(t.view("v_stmt"), "balance_sheet", STMT_SECTION)


@query("cashflow_job", f"select {STMT_OUT} from ({PAIRS}) x where not {ZERO_ONE}")
def _(t):
    rows = t.view("v_stmt").withColumn("free_cashflow", F.col("total") / 7)
    return processors.plan(rows, "cash_flow", STMT_SECTION)


@query("indicator_job", f"""
    select ts_code, ann_date, end_date, update_flag, total as total_amount, order_key
    from ({ANN_PAIRS}) x where ann_date is not null and not {ZERO_ONE}""")
def _(t):
    rows = t.view("v_stmt").drop("f_ann_date").withColumn("fcff", F.lit(1.0))
    return processors.plan(rows, "indicator", STMT_SECTION)


INCOME_FIXED = f"""
    select order_key, end_date, total_cogs,
      case when end_date >= {SIGN_CHANGE} then credit_impa_loss else -credit_impa_loss end as credit,
      case when end_date >= {SIGN_CHANGE} then assets_impair_loss else -assets_impair_loss end
        as assets, total_opcost
    from v_income"""


@query("income_job", f"""
    select s.ts_code, s.f_ann_date, s.end_date, s.comp_type, s.ann_date, s.update_flag,
      coalesce(i.total_opcost, i.total_cogs
        + case when s.end_date >= {SIGN_CHANGE} then i.credit_impa_loss
               else -i.credit_impa_loss end
        + case when s.end_date >= {SIGN_CHANGE} then i.assets_impair_loss
               else -i.assets_impair_loss end) as operating_cost,
      case when s.end_date >= {SIGN_CHANGE} then i.credit_impa_loss
           else -i.credit_impa_loss end as credit_impa_loss
    from ({PAIRS}) s join v_income i on i.order_key = s.order_key where not {ZERO_ONE}""")
def _(t):
    amounts = t.view("v_income").drop("end_date")
    rows = t.view("v_stmt").join(amounts, "order_key").withColumns(
        {"ebit": F.lit(1.0), "ebitda": F.lit(2.0)})
    section = {"total_opcost": {"renamed_field": "operating_cost"}, "credit_impa_loss": {}}
    return processors.plan(rows, "income", section,
                           overrides={"fix_losses": {"change": SIGN_CHANGE}})


@query("dividend_job", f"select order_key, ts_code, end_date, cash_div_tax as dps "
                       f"from ({DIVIDEND_SQL}) y")
def _(t):
    done = processors.plan(
        t.view("v_div"), "dividend", {"cash_div_tax": {"renamed_field": "dps"}},
        overrides={"filter_implementation_only": {"status": "F"},
                   "handle_duplicate_records": {"tie_break": ["order_key"]}})
    return done.select("order_key", "ts_code", "end_date", "dps")


@query("quotes_job", f"""
    select ts_code, trade_date, high, low, volume from v_daily where {LISTED_SQL}""")
def _(t):
    return processors.plan(t.view("v_daily"), "daily",
                           overrides={"filter_listing_dates": {"floor": FLOOR}})


@query("adj_factor_job", f"""
    select a.ts_code, a.trade_date, a.factor from v_adj a
    join (select ts_code, trade_date from v_daily where {LISTED_SQL}) d
      on d.ts_code = a.ts_code and d.trade_date = a.trade_date""")
def _(t):
    days = t.view("v_daily").select("ts_code", "trade_date", "list_date", "delist_date")
    rows = t.view("v_adj").join(days, ["ts_code", "trade_date"])
    return processors.plan(rows, "adj_factor",
                           overrides={"filter_listing_dates": {"floor": FLOOR}})


@query("daily_basic_job", f"""
    select b.ts_code, b.trade_date, b.pe from v_basic b
    join (select ts_code, trade_date from v_daily where {LISTED_SQL}) d
      on d.ts_code = b.ts_code and d.trade_date = b.trade_date""")
def _(t):
    days = t.view("v_daily").select("ts_code", "trade_date", "list_date", "delist_date")
    rows = t.view("v_basic").join(days, ["ts_code", "trade_date"])
    return processors.plan(rows, "daily_basic",
                           overrides={"filter_listing_dates": {"floor": FLOOR}})


@query("publish_job", f"""
    select 'new' as method, count(*) as n_rows, 'daily' as info from v_daily where {LISTED_SQL}""")
def _(t):
    store = SnapshotStore(t.spark, scratch_path(t.spark, "publish"))
    done = processors.run(t.view("v_daily"), "daily", store, "daily",
                          overrides={"filter_listing_dates": {"floor": FLOOR}})
    return store.manifest().select(F.lit(done.method).alias("method"),
                                   F.col("rows").alias("n_rows"), "info")


@query("stage_metrics", f"""
    select '00_remove_empty_ts_code' as step, count(*) as n_rows from v_daily
    union all select '01_filter_listing_dates', count(*) from v_daily where {LISTED_SQL}""")
def _(t):
    watch = {}
    plan = processors.plan(t.view("v_daily"), "daily", watch=watch,
                           overrides={"filter_listing_dates": {"floor": FLOOR}})
    writers.write_table(plan, scratch_path(t.spark, "stages"))
    return t.spark.createDataFrame([(n, o.get["rows"]) for n, o in watch.items()],
                                   "step string, n_rows bigint")


@query("reconciled_job", "select group_id, valid_records, large_diff_count, passed from ("
       + recon_sql("1", "total", "total_ok") + " union all "
       + recon_sql("2", "total and component", "total_bad") + ") x")
def _(t):
    return processors.reconciliation(t.view("v_recon"), "balance_sheet", RECON_SECTION).select(
        "group_id", "valid_records", "large_diff_count", "passed")


# --- cleaning ------------------------------------------------------------------------------

@query("cleaning_job", """
    select r.code, s.ts_code, s.list_status, r.trade_date as day, 'quotes' as origin
    from v_daily_raw r left join v_security s
      on s.symbol = (case when strpos(r.code, '.') > 0 then split_part(r.code, '.', 1)
                          when substr(r.code, 1, 2) in ('SZ', 'SH') then substr(r.code, 3)
                          else r.code end)
    where r.volume >= 1
    union all
    select null, null, null, cast(case
             when strpos(date_text, 'T') > 0 then replace(split_part(date_text, 'T', 1), '-', '')
             when strpos(date_text, ' ') > 0 then replace(split_part(date_text, ' ', 1), '-', '')
             else replace(date_text, '-', '') end as int), 'dates'
    from (select distinct date_text from v_dates where date_text is not null) x""")
def _(t):
    registry = cleaning_registry(t.view("v_security"), t.view("v_codemap"), ["order_key"])
    settings = {
        "quotes": {"steps": [
            {"function": "filter_data", "field_name": "volume", "condition": ">=1"},
            {"function": "add_ts_code", "source_field": "code", "field_name": "ts_code"},
            {"function": "rename_column", "old_name": "trade_date", "new_name": "day"},
            {"function": "no_such_step"}]},
        "dates": {"steps": [
            {"function": "filter_data", "field_name": "date_text", "condition": "notna"},
            {"function": "drop_duplicates", "subset": ["date_text"]},
            {"function": "convert_date_format", "source_field": "date_text",
             "field_name": "day"}]},
        "off": {"enabled": False},
    }
    sources = {
        "quotes": t.view("v_daily_raw").select("code", "trade_date", "volume",
                                               F.lit("quotes").alias("origin")),
        "dates": t.view("v_dates").withColumn("origin", F.lit("dates")),
        "off": t.view("v_dates"),
    }
    cleaned = clean_sources(sources, settings, registry)
    return cleaned.select("code", "ts_code", "list_status", F.col("day").cast("int").alias("day"),
                          "origin")


# --- landing -------------------------------------------------------------------------------

def landed_orders(t) -> str:
    """Orders landed by month."""
    root = scratch_path(t.spark, "landing")
    by_month = orders(t).withColumn("month", F.substring("order_day", 1, 6))
    by_month.hint("rebalance", "month").write.partitionBy("month").parquet(f"{root}/vendor/orders")
    return root


@query("landing_scan", ORDERS_SQL.replace("select", "select true as has_digest,", 1))
def _(t):
    root = landed_orders(t)
    rows = landing_scan(t.spark, [method_folder(root, "orders")], file_digests(t.spark, f"{root}/vendor/orders"))
    checked = F.col("file_md5").isNotNull() & F.col("file_path").contains("month=")
    return rows.select(*orders(t).columns, checked.alias("has_digest"))


@query("landing_range", ORDERS_SQL + """
    where strftime(o_orderdate, '%Y%m') between '199702' and '199805'""")
def _(t):
    patterns = period_patterns(landed_orders(t), "orders", "19970210", "19980515")
    return landing_scan(t.spark, patterns).select(*orders(t).columns)


@query("stream_landing", ORDERS_SQL + " where o_orderstatus = 'F'")
def _(t):
    root = landed_orders(t)
    stream = landed_stream(t.spark, f"{root}/vendor/orders", orders(t).schema)
    append_new(stream, lambda df: with_status(df, "o_orderstatus", "F"), f"{root}-norm",
               f"{root}-progress").awaitTermination()
    return t.spark.read.parquet(f"{root}-norm").select(*orders(t).columns)


@query("available_periods", "select distinct strftime(o_orderdate, '%Y%m') as period from {orders}")
def _(t):
    return available_periods(landed_files(t.spark, landed_orders(t), "orders",
                                          with_sidecar=False))


@query("file_cap", """
    select distinct strftime(o_orderdate, '%Y%m') as period from {orders} order by 1 limit 3""")
def _(t):
    root = scratch_path(t.spark, "landing")
    months = orders(t).select(F.substring("order_day", 1, 6).alias("month")).distinct()
    # One row per month, so one file per month.
    months.withColumn("label", F.col("month")).write.partitionBy("month").parquet(
        f"{root}/vendor/months")
    files = landed_files(t.spark, root, "months", with_sidecar=False)
    return first_files(files, 3).select("period")


@query("missing_input", "select cast(count(*) as bigint) as n_rows from {orders}")
def _(t):
    absent = read_table(t.spark, scratch_path(t.spark, "absent"), orders(t).schema, strict=False)
    return absent.unionByName(orders(t)).agg(F.count("*").alias("n_rows"))


# --- sinks ---------------------------------------------------------------------------------

@query("parquet_roundtrip", ORDERS_SQL)
def _(t):
    path = scratch_path(t.spark, "orders")
    writers.write_table(orders(t), path, [*orders(t).columns, "absent"])
    return read_table(t.spark, path, orders(t).schema)


@query("csv_roundtrip", ORDERS_SQL)
def _(t):
    root = scratch_path(t.spark, "norm")
    path = writers.write_norm_csv(orders(t), root, "orders", ["o_orderkey"], partition="all",
                                  source="vendor")
    return read_csv(t.spark, path, orders(t).schema)


@query("cleaned_csv", ORDERS_SQL)
def _(t):
    path = scratch_path(t.spark, "cleaned")
    writers.write_cleaned(orders(t), path, "csv")
    return read_csv(t.spark, path, orders(t).schema)


@query("raw_manifest", """
    select count(*) as n_rows, 'vendor' as source, 'o_orderkey' as key from {orders}""")
def _(t):
    root = scratch_path(t.spark, "raw")
    writers.write_raw(orders(t), root, "vendor", "orders", "landing", "2024-01-01", ["o_orderkey"])
    facts = t.spark.read.schema("rows bigint, source string, primary_keys array<string>").json(
        f"{root}/raw/vendor/orders/_meta")
    return facts.select(F.col("rows").alias("n_rows"), "source",
                        F.col("primary_keys")[0].alias("key"))


@query("layout_write", """
    select case q % 2 when 0 then 'MONTHLY' else 'QUARTERLY' end as grain,
           case q % 2 when 0 then strftime(o_orderdate, '%Y%m')
                else strftime(o_orderdate, '%Y') || 'Q' || cast(q as string) end as period,
           count(*) as n_rows
    from (select *, quarter(o_orderdate) as q from {orders}) x group by 1, 2""")
def _(t):
    """Requests of a quarter carry its last day."""
    path = scratch_path(t.spark, "layout")
    day = parse_compact(F.col("order_day"))
    monthly = F.quarter(day) % 2 == 0
    quarter_end = compact_text(F.last_day(F.add_months(F.trunc(day, "quarter"), 2)))
    layout.write_partitioned(orders(t), path, F.when(monthly, "monthly").otherwise("quarterly"),
                             F.when(monthly, F.col("order_day")).otherwise(quarter_end))
    return t.spark.read.parquet(path).groupBy("grain", "period").agg(F.count("*").alias("n_rows"))


@query("layout_range", ORDERS_SQL + """
    where strftime(o_orderdate, '%Y%m') between '199702' and '199805'""")
def _(t):
    path = scratch_path(t.spark, "layout")
    layout.write_partitioned(orders(t), path, F.lit("MONTHLY"), F.col("order_day"))
    return read_layout(t.spark, path, "19970210", "19980515").select(*orders(t).columns)


FEED_SQL = f"""
    select {FEED_CODE_SQL.format(c='d.ts_code')} as symbol,
           {ISO_SQL.format(c='d.trade_date')} as date, d.low, d.volume, a.factor
    from (select * from v_daily where {LISTED_SQL}) d
    left join v_adj a on a.ts_code = d.ts_code and a.trade_date = d.trade_date"""


def _feed(t):
    return daily_feed({"daily": listed(t), "adj": t.view("v_adj")}, ["low", "volume"])


@query("layout_append", """
    select strftime(o_orderdate, '%Y%m') as period, count(*) as n_rows, min(o_orderkey) as low,
           max(o_orderkey) as high from {orders} group by 1""")
def _(t):
    """Saved in two halves by month: the second save leaves the first one's months alone."""
    path = scratch_path(t.spark, "layout")
    half = F.substring("order_day", 5, 2).cast("int") <= 6
    for part in (half, ~half):
        layout.write_partitioned(orders(t).where(part), path, F.lit("MONTHLY"), F.col("order_day"))
    return read_layout(t.spark, path).groupBy("period").agg(
        F.count("*").alias("n_rows"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))


@query("layout_replace", ORDERS_SQL + """
    where strftime(o_orderdate, '%Y') <> '1997' or o_orderpriority <> '5-LOW'""")
def _(t):
    """The months of a year written again with fewer rows, nothing else touched."""
    path = scratch_path(t.spark, "layout")
    layout.write_partitioned(orders(t), path, F.lit("MONTHLY"), F.col("order_day"))
    fewer = orders(t).where((F.substring("order_day", 1, 4) == "1997") & (F.col("o_orderpriority") != "5-LOW"))
    layout.write_partitioned(fewer, path, F.lit("MONTHLY"), F.col("order_day"))
    return read_layout(t.spark, path).select(*orders(t).columns)


@query("layout_symbols", """
    select lpad(cast(o_custkey as varchar), 6, '0') as period, count(*) as n_rows
    from {orders} group by 1""")
def _(t):
    """Symbols of digits keep their zeros."""
    path = scratch_path(t.spark, "layout")
    symbol = F.lpad(F.col("o_custkey").cast("string"), 6, "0")
    rows = orders(t).withColumn("symbol", symbol)
    layout.write_partitioned(rows, path, F.lit("SYMBOL"), F.lit(None).cast("string"), F.col("symbol"))
    return read_layout(t.spark, path, many=True).groupBy("period").agg(F.count("*").alias("n_rows"))


@query("layout_rejects", """
    select o_orderkey, case when o_orderstatus = 'P' then 'unknown_grain' else 'date_not_yyyymmdd' end as error
    from {orders} where o_orderstatus in ('P', 'O')
    union all select count(*), 'stored' from {orders} where o_orderstatus = 'F'""")
def _(t):
    """Requests that cannot be stored are set apart, each with its reason; the rest is stored."""
    path, run = scratch_path(t.spark, "layout"), scratch_path(t.spark, "run")
    grain = F.when(F.col("o_orderstatus") == "P", "HOURLY").otherwise("DAILY")
    day = F.when(F.col("o_orderstatus") == "O", F.lit("2020-01-05")).otherwise(F.col("order_day"))
    layout.write_partitioned(orders(t), path, grain, day,
                             rejects=lambda rows: writers.write_rejects(rows, run, "r1"))
    rejected = t.spark.read.parquet(f"{run}/rejects/r1").select(
        "o_orderkey", F.array_join("errors", ",").alias("error"))
    return rejected.union(read_layout(t.spark, path).agg(F.count("*"), F.lit("stored")))


@query("entity_append", f"""
    select upper(symbol) as symbol, date, low from ({FEED_SQL}) x""")
def _(t):
    """Per-entity files saved for two sets of entities, one after the other, and read back."""
    path, feed = scratch_path(t.spark, "feed"), _feed(t)
    even = F.pmod(F.crc32("symbol"), F.lit(2)) == 0
    for part in (even, ~even):
        writers.write_per_entity(feed.where(part), path, "symbol", "date", ["date", "low"], upper=True)
    return writers.read_per_entity(t.spark, path, "date date, low double, symbol string").select(
        "symbol", F.col("date").cast("string").alias("date"), "low")


@query("read_back", "select count(*) as n_rows, 6 as n_columns, true as same_schema from {orders}")
def _(t):
    path = scratch_path(t.spark, "orders")
    writers.write_table(orders(t), path)
    return writers.read_back(t.spark, path, orders(t))


@query("rejected_rows", """
    select count(*) as n_rows from (select count(*) over (
      partition by ts_code, end_date, f_ann_date) as n from v_stmt) x where n > 1""")
def _(t):
    from tallyloom.operators.resolve import repeated_rows
    path = writers.write_rejects(repeated_rows(t.view("v_stmt"), KEYS),
                                 scratch_path(t.spark, "run"), "r1")
    return t.spark.read.parquet(path).agg(F.count("*").alias("n_rows"))


@query("per_entity_feed", f"""
    select upper(symbol) as symbol, count(*) as n_rows, count(*) - count(date) as null_date,
           count(*) - count(low) as null_low, count(*) - count(volume) as null_volume,
           count(*) - count(factor) as null_factor from ({FEED_SQL}) x group by 1""")
def _(t):
    path = scratch_path(t.spark, "feed")
    writers.write_per_entity(_feed(t), path, "symbol", "date", upper=True)
    schema = "date date, low double, volume bigint, factor double, symbol string"
    return feed_check(writers.read_per_entity(t.spark, path, schema))


@query("feed_lists", f"""
    select 'day' as kind, date as first, null as last from (select distinct date from ({FEED_SQL}) x)
    union all
    select upper(symbol), min(date), max(date) from ({FEED_SQL}) y group by 1""")
def _(t):
    path, feed = scratch_path(t.spark, "lists"), _feed(t)
    writers.write_feed_lists(calendar_days(feed), instruments(feed), path)
    days = t.spark.read.schema("first string").csv(f"{path}/day").select(
        F.lit("day").alias("kind"), "first", F.lit(None).cast("string").alias("last"))
    listed_codes = t.spark.read.schema("kind string, first string, last string").option(
        "sep", "\t").csv(f"{path}/all")
    return days.unionByName(listed_codes)


@query("feed_job", f"""
    select 'daily' as task_id, 'SUCCESS' as execution_status, count(*) as data_rows
    from ({FEED_SQL}) x
    union all select 'broken', 'FAILED', null
    union all select 'pit', 'SUCCESS', count(revenue) + count(profit) from v_stmt_clean""")
def _(t):
    root = scratch_path(t.spark, "converters")

    def daily():
        return writers.write_table(_feed(t), f"{root}/daily")

    def broken():
        return daily_feed({"daily": listed(t).drop("trade_date")}, ["low"]).count()

    def pit():
        feed = point_in_time_feed({"income": t.view("v_stmt_clean")})
        return writers.write_table(feed, f"{root}/pit")

    runs = run_converters({"daily": daily, "broken": broken, "pit": pit})
    return runlog.run_rows(t.spark, runs).select("task_id", "execution_status", "data_rows")


@query("pit_feed_job", """
    select 'income' as data_type, lower(substr(ts_code, 8, 2)) || substr(ts_code, 1, 6) as symbol,
           count(revenue) + count(profit) as n_rows
    from v_stmt_clean group by 2""")
def _(t):
    path = scratch_path(t.spark, "pit")
    write_point_in_time(point_in_time_feed({"income": t.view("v_stmt_clean")}), path)
    schema = ("period int, datetime date, field string, value double, data_type string, "
              "symbol string")
    return writers.read_per_entity(t.spark, path, schema, ("data_type", "symbol")).groupBy("data_type", "symbol").agg(
        F.count("*").alias("n_rows"))


@query("pit_fields", """
    select lower(substr(ts_code, 8, 2)) || substr(ts_code, 1, 6) as symbol,
           cast((count(revenue) > 0)::int + (count(profit) > 0)::int as bigint) as n_fields,
           count(revenue) + count(profit) as n_values,
           count(revenue) > 0 and count(profit) > 0 as complete
    from v_stmt_clean group by 1""")
def _(t):
    feed = point_in_time_feed({"income": t.view("v_stmt_clean")})
    return field_presence(feed, ["revenue_q", "profit_q"])


# --- snapshots and logs --------------------------------------------------------------------

def _store(t, name):
    return SnapshotStore(t.spark, scratch_path(t.spark, name))


def _changed(df: DataFrame) -> DataFrame:
    return df.withColumn("o_totalprice", F.col("o_totalprice") + 1)


@query("snapshot_new", "select 'new' as method, count(*) as n_rows, cast(1 as bigint) as n_versions from {orders}")
def _(t):
    return _history(t, "snapshot-new", [orders(t)])


@query("snapshot_skip", "select 'skip' as method, count(*) as n_rows, cast(1 as bigint) as n_versions from {orders}")
def _(t):
    shuffled = orders(t).repartition(7, "o_custkey").sortWithinPartitions("o_totalprice")
    return _history(t, "snapshot-skip", [orders(t), shuffled])


@query("snapshot_update",
       "select 'update' as method, count(*) as n_rows, cast(2 as bigint) as n_versions from {orders}")
def _(t):
    return _history(t, "snapshot-update", [orders(t), _changed(orders(t))])


@query("snapshot_shrink", """
    select 'refused' as method, count(*) as n_rows, cast(1 as bigint) as n_versions from {orders}""")
def _(t):
    return _history(t, "snapshot-shrink", [orders(t), orders(t).where("o_orderstatus = 'F'")])


def _history(t, name, extracts) -> DataFrame:
    """The outcome of the last save, the rows of the current version and the version count."""
    store = _store(t, name)
    for extract in extracts:
        try:
            method = store.save(extract, "orders").method
        except ShrinkError:
            method = "refused"
    versions = store.manifest().groupBy("dataset").agg(F.count("*").alias("n_versions"))
    now = store.current().select("dataset", F.col("rows").alias("n_rows"))
    return now.join(versions, "dataset").select(F.lit(method).alias("method"), "n_rows",
                                                "n_versions")


@query("snapshot_content", ORDERS_SQL.replace("o_totalprice,", "o_totalprice + 1 as o_totalprice,"))
def _(t):
    """What readers get after an update: the rows of the new version, and nothing unpublished around."""
    store = _store(t, "content")
    store.save(orders(t), "orders")
    store.save_computed(orders(t), "orders")  # unchanged: leaves nothing behind
    store.save(orders(t).withColumn("o_totalprice", F.col("o_totalprice") + 1), "orders")
    return store.read("orders")


@query("fingerprint_change", """
    select o_orderkey, true as differs from (select min(o_orderkey) as o_orderkey from {orders}) x""")
def _(t):
    """One changed cell gives another fingerprint."""
    first = orders(t).agg(F.min("o_orderkey")).scalar()
    changed = orders(t).withColumn("o_totalprice", F.when(
        F.col("o_orderkey") == first, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice")))
    both = fingerprint(orders(t)).unionByName(fingerprint(changed)).agg(
        F.count_distinct("hash_sum", "hash_xor").alias("n"))
    return both.select(orders(t).agg(F.min("o_orderkey").alias("k")).scalar().alias("o_orderkey"),
                       (F.col("n") == 2).alias("differs"))


@query("fingerprint", "select count(*) as n_rows, cast(1 as bigint) as n_fingerprints from {orders}")
def _(t):
    moved = orders(t).repartition(5, "o_orderstatus").sortWithinPartitions(F.desc("o_orderkey"))
    both = fingerprint(orders(t)).unionByName(fingerprint(moved))
    return both.agg(F.max("rows").alias("n_rows"),
                    F.count_distinct("rows", "hash_sum", "hash_xor").alias("n_fingerprints"))


@query("incremental_read", """
    select 'suppliers' as dataset, count(*) as n_rows from {supplier}""")
def _(t):
    store = _store(t, "incremental")
    store.save(t.table("customer"), "customers")
    seen = store.current().agg(F.max("updated_at").alias("m")).first()["m"]
    store.save(t.table("customer"), "customers")
    store.save(t.table("supplier"), "suppliers")
    fresh = store.changed_since(seen)
    paths = [r.path for r in fresh.select("path").collect()]
    return t.spark.read.parquet(*paths).agg(F.count("*").alias("n_rows")).select(
        F.lit("suppliers").alias("dataset"), "n_rows")


@query("retention", """
    select 'customers' as dataset, count(*) as n_rows, true as superseded from {customer}""")
def _(t):
    store = _store(t, "retention")
    store.save(t.table("customer"), "customers")
    store.save(t.table("customer").withColumn("c_acctbal", F.col("c_acctbal") + 1), "customers")
    old = store.superseded_before(dt.datetime.now() + dt.timedelta(days=2))
    return old.select("dataset", F.col("rows").alias("n_rows"), F.lit(True).alias("superseded"))


@query("collect_job", """
    select 'vendor.orders' as task_id, 'SKIPPED' as execution_status, count(*) as data_rows
    from {orders}
    union all select 'vendor.customers', 'SUCCESS', count(*) from {customer}
    union all select 'vendor.nothing', 'FAILED', null""")
def _(t):
    store = _store(t, "collect")
    log = f"{store.root}-runs"
    collect({"orders": orders(t)}, store, "vendor", log)
    collect({"orders": orders(t), "customers": t.table("customer"),
             "nothing": t.table("customer").limit(0)}, store, "vendor", log)
    return runlog.latest_runs(t.spark.read.parquet(log)).select(
        "task_id", "execution_status", "data_rows")


@query("run_log_latest", """
    select task_id, execution_status, data_rows, strftime(updated_at, '%Y%m%d') as day from (
      select *, row_number() over (partition by task_id order by updated_at desc,
        execution_status desc, data_rows desc) as rn from v_runs) x where rn = 1""")
def _(t):
    return runlog.latest_runs(t.view("v_runs")).select(
        "task_id", "execution_status", "data_rows", compact_text(F.col("updated_at")).alias("day"))


# --- published tables, one per processor ----------------------------------------------------

STATEMENT_ROWS = """select ts_code, ann_date as f_ann_date, end_date, ann_date, revenue
    from v_stmt_clean where ts_code is not null"""


def _statement_rows(t) -> DataFrame:
    return t.view("v_stmt_clean").select(
        "ts_code", F.col("ann_date").alias("f_ann_date"), "end_date", F.lit("1").alias("comp_type"), "ann_date",
        F.lit("0").alias("update_flag"), "revenue", F.lit(1.0).alias("ebit"), F.lit(1.0).alias("free_cashflow"),
        F.lit(1.0).alias("fcff"), F.lit("F").alias("div_proc"), F.col("ann_date").alias("imp_ann_date"))


def _published(t, name: str, rows: DataFrame, section, overrides=None) -> DataFrame:
    store = SnapshotStore(t.spark, scratch_path(t.spark, f"publish-{name}"))
    processors.run(rows, name, store, name, section, overrides)
    return store.read(name)


def _publish_statement(name: str, columns: str, section, overrides=None, prepare=lambda rows: rows) -> None:
    @query(f"publish_{name}", f"select {columns} from ({STATEMENT_ROWS}) x")
    def _(t):
        done = _published(t, name, prepare(_statement_rows(t)), section, overrides)
        return done.select(*[c.split(" as ")[-1] for c in columns.split(", ")])


TOTAL = {"revenue": {"renamed_field": "total", "relationship": "1", "report_item": "total"}}
for _name in ("balance_sheet", "cash_flow"):
    _publish_statement(_name, "ts_code, f_ann_date, end_date, revenue as total", TOTAL)
_publish_statement("income", "ts_code, f_ann_date, end_date, revenue as total_opcost", {"total_opcost": {}},
                   prepare=lambda rows: rows.withColumns({
                       "total_opcost": F.col("revenue"), "total_cogs": F.col("revenue"),
                       "credit_impa_loss": F.lit(0.0), "assets_impair_loss": F.lit(0.0)}))
_publish_statement("indicator", "ts_code, ann_date, end_date, revenue as total", TOTAL)
_publish_statement("dividend", "ts_code, end_date, ann_date, revenue as cash_div_tax", {},
                   {"filter_implementation_only": {"status": "F"}, "handle_duplicate_records": {"tie_break": ["ts_code"]}},
                   lambda rows: rows.withColumn("cash_div_tax", F.col("revenue")))


def _publish_quotes(name: str, view: str, value: str) -> None:
    @query(f"publish_{name}", f"""
        select q.ts_code, q.trade_date, q.{value} from {view} q
        join (select ts_code, trade_date from v_daily where {LISTED_SQL}) d
          on d.ts_code = q.ts_code and d.trade_date = q.trade_date""")
    def _(t):
        days = t.view("v_daily").select("ts_code", "trade_date", "list_date", "delist_date")
        rows = t.view(view).drop("list_date", "delist_date").join(days, ["ts_code", "trade_date"])
        done = _published(t, name, rows, {}, {"filter_listing_dates": {"floor": FLOOR}})
        return done.select("ts_code", "trade_date", value)


for _name, _view, _value in (("daily", "v_daily", "volume"), ("adj_factor", "v_adj", "factor"), ("daily_basic", "v_basic", "pe")):
    _publish_quotes(_name, _view, _value)


@query("calendar_load", "select cal_date, is_open from v_calendar")
def _(t):
    """A calendar whose days are numbers in the file."""
    path = scratch_path(t.spark, "calendar")
    t.view("v_calendar").withColumn("cal_date", F.col("cal_date").cast("int")).write.parquet(path)
    return read_calendar(t.spark, path)


@query("feed_order", f"""
    select upper(symbol) as symbol, count(*) as n_rows, cast(0 as bigint) as n_out_of_order from ({FEED_SQL}) x group by 1""")
def _(t):
    """The files of each entity in the order of their names and lines: no day comes before the one above it."""
    path, feed = scratch_path(t.spark, "feed"), _feed(t)
    day = sort_day(feed.columns)
    writers.write_per_entity(feed, path, "symbol", day, [day, "low"], upper=True)
    # The files are read once; what follows compares lines of that one reading.
    rows = as_table(writers.read_per_entity(t.spark, path, "date date, low double, symbol string", places=True).select(
        "symbol", "file", "date", "line"), "feed-lines")
    above = rows.select("symbol", "file", (F.col("line") + 1).alias("line"), F.col("date").alias("before"))
    both = rows.join(above, ["symbol", "file", "line"], "left")
    lines = both.groupBy("symbol").agg(F.count("*").alias("n_rows"), F.count_if(F.col("date") < F.col("before")).alias("bad"))
    # Files of an entity, by name: the last day of one against the first of the next.
    spans = rows.groupBy("symbol", "file").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    turns = spans.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("file", "a", "b"))).alias("f"))
    wrong = F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.size("f") - 1, F.lit(1))),
                            lambda i: F.coalesce(F.get("f", i)["a"] < F.get("f", i - 1)["b"], F.lit(False))))
    return lines.join(turns, "symbol").select("symbol", "n_rows", (F.col("bad") + wrong).cast("long").alias("n_out_of_order"))
