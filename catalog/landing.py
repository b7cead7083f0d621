"""Queries on landed files: the catalogue, scans with sidecars, drifting and broken files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.jobs import ORDERS_SQL, landed_orders, orders
from catalog.registry import query
from tallyloom.operators.overlap import overlap_join
from tallyloom.plans.backfill import backfill_plan
from tallyloom.plans.cleaning import clean_and_save, landed_source
from tallyloom.plans.steps import cleaning_registry
from tallyloom.session import scratch_path
from tallyloom.sinks import commits
from tallyloom.sources.catalogue import FileCatalogue
from tallyloom.sources.landing import available_periods, landed_files, method_folder
from tallyloom.sources.scan import file_digests, file_listing, landing_scan, read_csv


def catalogue_of(t, root: str, grains=None) -> FileCatalogue:
    return FileCatalogue(t.spark, scratch_path(t.spark, "catalogue"), root, grains)


def with_sidecars(t, folder: str, wanted: str = "true") -> None:
    """Notes beside landed files; a file system call per file, as a collector makes it."""
    for r in file_digests(t.spark, folder).where(wanted).collect():
        commits._write(t.spark, f"{r['stem']}.json", f'{{"data_md5": "{r["file_md5"]}"}}')


def _month_files(t, root: str, month: str) -> list[str]:
    return [r["file_path"] for r in file_listing(t.spark, [f"{root}/vendor/orders/month={month}"]).collect()]


@query("catalogue_refresh", """
    select distinct strftime(o_orderdate, '%Y%m') as period,
           case strftime(o_orderdate, '%Y%m') when '199701' then 'gone' when '199702' then 'new' else 'changed' end as state
    from {orders} where strftime(o_orderdate, '%Y%m') in ('199701', '199702', '199703')""")
def _(t):
    """One month's files go, one month gets another file, one month's files are touched."""
    root = landed_orders(t)
    kept = catalogue_of(t, root)
    kept.refresh()
    commits.delete(t.spark, f"{root}/vendor/orders/month=199701")
    orders(t).where("order_day like '199702%'").coalesce(1).write.mode("append").parquet(f"{root}/vendor/orders/month=199702")
    for path in _month_files(t, root, "199703"):
        _, target, system = commits._hadoop(t.spark, path)
        system.setTimes(target, 1_000_000_000_000, -1)
    changes = kept.refresh()
    return changes.select(F.regexp_extract("path", r"month=(\d{6})", 1).alias("period"), "state").distinct()


@query("landed_state", """
    select distinct 'orders' as dataset, strftime(o_orderdate, '%Y%m') as period from {orders}
    where strftime(o_orderdate, '%Y') <> '1996'""")
def _(t):
    """What has landed with a sidecar: a year without is not there yet."""
    root = landed_orders(t)
    with_sidecars(t, f"{root}/vendor/orders", "stem not like '%month=1996%'")
    kept = catalogue_of(t, root, {"orders": "MONTHLY"})
    kept.refresh()
    return kept.landed()


@query("backfill_landed", """
    select 'orders' as dataset, strftime(m, '%Y%m') as period
    from (select unnest(generate_series(date '1995-01-01', date '1998-12-01', interval 1 month)) as m) s
    where strftime(m, '%Y%m') not in (select strftime(o_orderdate, '%Y%m') from {orders}
                                      where o_orderpriority = '1-URGENT' and o_totalprice > 430000)""")
def _(t):
    """A request for four years of months, less those that the catalogue has."""
    root = scratch_path(t.spark, "landing")
    some = orders(t).where("o_orderpriority = '1-URGENT' and o_totalprice > 430000")
    by_month = some.withColumn("month", F.substring("order_day", 1, 6))
    by_month.hint("rebalance", "month").write.partitionBy("month").parquet(f"{root}/vendor/orders")
    # The area is never empty, also where no order is that large.
    orders(t).limit(1).write.parquet(f"{root}/vendor/other/199001")
    with_sidecars(t, f"{root}/vendor")
    kept = catalogue_of(t, root, {"orders": "MONTHLY"})
    kept.refresh()
    request = t.spark.createDataFrame(
        [("orders", "MONTHLY", "<MONTHLY_DATE_RANGE>", "199501", "199812", 0, 1.0, False)],
        "dataset string, grain string, placeholder string, start_date string, end_date string, lookback int, "
        "multiplier double, truncate boolean")
    return backfill_plan(request, t.view("v_calendar"), kept.landed()).select("dataset", "period")


@query("available_periods_symbols", "select cast(null as varchar) as period where false")
def _(t):
    """Folders named like months that are symbols: with the stored grain there is no period."""
    root = scratch_path(t.spark, "landing")
    named = t.table("nation").withColumn("symbol", F.concat(F.lit("2000"), F.lpad((F.col("n_nationkey") % 12 + 1).cast("string"), 2, "0")))
    named.write.partitionBy("symbol").parquet(f"{root}/vendor/prices")
    kept = catalogue_of(t, root, {"prices": "SYMBOL"})
    kept.refresh()
    files = landed_files(t.spark, root, "prices", with_sidecar=False, grain="SYMBOL")
    return kept.periods().select("period").union(available_periods(files))


@query("overlap_join", """
    with months as (
      select distinct lpad(cast(o_custkey % 1000000 as varchar), 6, '0') as symbol,
             cast(date_trunc('month', o_orderdate) as date) as period_start, cast(last_day(o_orderdate) as date) as period_end
      from {orders} where o_orderstatus = 'F')
    select r.request_id, cast(m.period_start as varchar) as period_start, cast(m.period_end as varchar) as period_end
    from v_ranges r join months m on r.symbol = m.symbol and m.period_start <= r.end_day + 20 and m.period_end >= r.start_day - 45""")
def _(t):
    """Requests widened by some weeks, each with the months of its symbol that have finished orders."""
    requests = t.view("v_ranges").select("request_id", "symbol", F.date_sub("start_day", 45).alias("first"),
                                         F.date_add("end_day", 20).alias("last"))
    day = F.col("o_orderdate").cast("date")
    months = t.table("orders").where("o_orderstatus = 'F'").select(
        F.lpad((F.col("o_custkey") % 1_000_000).cast("string"), 6, "0").alias("symbol"),
        F.trunc(day, "month").alias("period_start"), F.last_day(day).alias("period_end")).distinct()
    met = overlap_join(requests, months, ["symbol"], ("first", "last"), ("period_start", "period_end"))
    return met.select("request_id", *[F.col(c).cast("string").alias(c) for c in ("period_start", "period_end")])


@query("landing_sidecar", ORDERS_SQL.replace(
    "select", "select strftime(o_orderdate, '%Y') <> '1996' as has_digest,", 1))
def _(t):
    """Every row with the digest that its file's sidecar states."""
    root = landed_orders(t)
    with_sidecars(t, f"{root}/vendor/orders", "stem not like '%month=1996%'")
    from tallyloom.sources.scan import sidecar_digests
    where = [method_folder(root, "orders")]
    rows = landing_scan(t.spark, where, sidecar_digests(t.spark, where))
    own = file_digests(t.spark, f"{root}/vendor/orders").select("stem", F.col("file_md5").alias("own"))
    stem = F.regexp_replace("file_path", r"\.[A-Za-z]+$", "")
    both = rows.join(own, stem == own["stem"])
    return both.select(F.coalesce(F.col("file_md5") == F.col("own"), F.lit(False)).alias("has_digest"), *orders(t).columns)


@query("landing_drift", "select o_orderkey, cast(o_totalprice as varchar) as price from {orders}")
def _(t):
    """A column that is text in some files and a number in others comes as text."""
    root = scratch_path(t.spark, "landing")
    rows = orders(t).select("o_orderkey", F.col("o_totalprice").alias("price"), "order_day")
    late = F.substring("order_day", 1, 4) >= "1996"
    rows.where(~late).select("o_orderkey", "price").write.parquet(f"{root}/vendor/prices/1995")
    rows.where(late).select("o_orderkey", F.col("price").cast("string")).write.parquet(f"{root}/vendor/prices/1996")
    return landing_scan(t.spark, [method_folder(root, "prices")]).select("o_orderkey", "price")


def _landed_with_faults(t) -> str:
    """Sidecars for all months but one, and one month whose files are no Parquet files."""
    root = landed_orders(t)
    with_sidecars(t, f"{root}/vendor/orders", "stem not like '%month=199703%'")
    for path in _month_files(t, root, "199704"):
        commits._write(t.spark, path, "not what it should be")
    return root


CLEANED_SQL = """
    select o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y%m%d') as order_day from {orders}
    where o_orderstatus <> 'P' and strftime(o_orderdate, '%Y%m') between '199702' and '199712'
      and strftime(o_orderdate, '%Y%m') not in ('199703', '199704')"""


@query("clean_period_job", CLEANED_SQL)
def _(t):
    """Files of a period with sidecars through cleaning steps to a CSV table; a broken file is left out whole."""
    root, saved = _landed_with_faults(t), scratch_path(t.spark, "cleaned")
    steps = [{"function": "filter_data", "field_name": "o_orderstatus", "condition": "!=P"},
             {"function": "filter_data", "field_name": "file_md5", "condition": "notna"}]
    clean_and_save(t.spark, root, "orders", steps, cleaning_registry(), saved, "csv", "19970210", "19971215")
    return read_csv(t.spark, saved, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                    "order_day string, o_orderpriority string, file_path string, file_md5 string").select(
        "o_orderkey", "o_custkey", "o_totalprice", "order_day")


@query("unreadable_files", """
    select distinct strftime(o_orderdate, '%Y%m') as period, 'no rows: empty or no Parquet file' as error from {orders}
    where strftime(o_orderdate, '%Y%m') = '199704'""")
def _(t):
    """What the job above reports of the files it left out."""
    listed: list[DataFrame] = []
    landed_source(t.spark, _landed_with_faults(t), "orders", "19970101", "19971231", report=listed.append)
    return listed[0].select(F.regexp_extract("path", r"month=(\d{6})", 1).alias("period"), "error").distinct()
