"""Queries on versioned tables: partition saves, commits, changes, versions as of a commit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import query
from tallyloom.functions.dates import compact_text
from tallyloom.session import scratch_path
from tallyloom.sinks.changes import as_of, change_feed, digest_diff, validity
from tallyloom.sinks.cluster import read_clustered, write_clustered
from tallyloom.sinks.partitions import PartitionStore
from tallyloom.sinks.retention import compact, hold, stored, vacuum, vacuum_plan
from tallyloom.streaming.resolved import keep_resolved

COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, period"
FIRST = """select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
      strftime(o_orderdate, '%Y%m') as period from {orders}"""
# The second version corrects prices, loses orders, has new ones, and moves some to another month.
SECOND = f"""select o_orderkey, o_custkey, o_orderstatus,
      case when o_orderkey % 97 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
      case when o_orderkey % 101 = 0 then '199601' else period end as period
    from ({FIRST}) a where o_orderkey % 89 <> 0
    union all select o_orderkey + 1000000000, o_custkey, 'N', o_totalprice, period
    from ({FIRST}) b where o_orderkey % 83 = 0"""
# The third brings the lost orders back and keeps half of the corrections.
THIRD = f"""select o_orderkey, o_custkey, o_orderstatus,
      case when o_orderkey % 97 = 0 and o_custkey % 2 = 0 then o_totalprice + 1 else o_totalprice end
        as o_totalprice, period from ({FIRST}) a"""


def first(t) -> DataFrame:
    return t.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                    F.substring(compact_text(F.col("o_orderdate")), 1, 6).alias("period"))


def second(t) -> DataFrame:
    key = F.col("o_orderkey")
    fixed = first(t).where(key % 89 != 0).withColumns({
        "o_totalprice": F.when(key % 97 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        "period": F.when(key % 101 == 0, "199601").otherwise(F.col("period"))})
    added = first(t).where(key % 83 == 0).withColumns(
        {"o_orderkey": key + 1_000_000_000, "o_orderstatus": F.lit("N")})
    return fixed.unionByName(added)


def third(t) -> DataFrame:
    kept = (F.col("o_orderkey") % 97 == 0) & (F.col("o_custkey") % 2 == 0)
    return first(t).withColumn("o_totalprice", F.when(kept, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))


def store(t, name: str, **options) -> PartitionStore:
    return PartitionStore(t.spark, scratch_path(t.spark, name), "period", ["o_orderkey"], **options)


def three_versions(t, name: str) -> PartitionStore:
    kept = store(t, name, every=2)
    for number, rows in enumerate((first(t), second(t), third(t))):
        kept.save(rows, info=f"extract {number}", shrink="allow", whole=True)
    return kept


@query("partition_save", f"""
    select period as label, case period when '199603' then 'update' when '199001' then 'new' else 'skip' end as method,
           count(*) as rows, case when period <> '199001' then count(*) end as previous_rows
    from ({FIRST} union all select 1, 1, 'F', 0.5, '199001') a
    where substr(period, 1, 4) <> '1998' group by period""")
def _(t):
    """One month changed, one new, a year not in the extract: what the second save did with each month."""
    kept = store(t, "partition-save")
    kept.save(first(t))
    march = F.col("period") == "199603"
    extract = first(t).where("substr(period, 1, 4) <> '1998'").withColumn(
        "o_totalprice", F.when(march, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    added = t.spark.createDataFrame([(1, 1, "F", 0.5, "199001")], extract.schema)
    return kept.save(extract.unionByName(added)).partitions


@query("partition_read", f"""
    select o_orderkey, o_custkey, o_orderstatus,
           case when period = '199603' then o_totalprice + 1 else o_totalprice end as o_totalprice, period
    from ({FIRST}) a""")
def _(t):
    """After a save of one month readers see its new rows and all other months as they were."""
    kept = store(t, "partition-read")
    kept.save(first(t))
    kept.save(first(t).where("period = '199603'").withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return kept.read()


def _refuse(spark, path, text):
    raise OSError("the store cannot be reached")


@query("broken_save", FIRST)
def _(t):
    """A save that breaks after its files were written and before its commit leaves the table as it was."""
    kept = store(t, "broken-save")
    kept.save(first(t))
    broken = PartitionStore(t.spark, kept.root, "period", ["o_orderkey"], put=_refuse)
    try:
        broken.save(first(t).withColumn("o_totalprice", F.col("o_totalprice") + 1))
    except OSError:
        return kept.read()
    raise AssertionError("the save should have failed")


@query("digest_diff", f"""
    with a as ({FIRST}), b as ({SECOND}),
    gone as (select * from a except all select * from b), came as (select * from b except all select * from a)
    select coalesce(g.o_orderkey, c.o_orderkey) as o_orderkey,
           case when g.o_orderkey is null then 'insert' when c.o_orderkey is null then 'delete' else 'update' end as change
    from gone g full join came c on g.o_orderkey = c.o_orderkey""")
def _(t):
    return digest_diff(three_versions(t, "digest-diff"), 0, 1)


@query("commit_history", f"""
    select cast(0 as bigint) as number, 'save' as operation, 'extract 0' as info,
           count(distinct period) as n_partitions, count(*) as n_rows, count(*) as rows from ({FIRST}) a
    union all
    select 1, 'save', 'extract 1', count(distinct c.period) as n_partitions,
           count(case when c.period is not null then 1 end), count(*)
    from ({SECOND}) b left join
      (select distinct period from (({FIRST}) except all ({SECOND})) x union
       select distinct period from (({SECOND}) except all ({FIRST})) y) c on b.period = c.period
    union all
    select 2, 'save', 'extract 2', count(distinct c.period) as n_partitions,
           count(case when c.period is not null then 1 end), count(*)
    from ({THIRD}) b left join
      (select distinct period from (({THIRD}) except all ({SECOND})) x union
       select distinct period from (({SECOND}) except all ({THIRD})) y) c on b.period = c.period""")
def _(t):
    return three_versions(t, "commit-history").history().select(
        "number", "operation", "info", "n_partitions", "n_rows", "rows")


def _feed_sql(number: int, before: str, after: str) -> str:
    changed = "a.o_custkey <> b.o_custkey or a.o_orderstatus <> b.o_orderstatus or a.o_totalprice <> b.o_totalprice or a.period <> b.period"
    names = COLUMNS.split(", ")
    old, new = (", ".join(f"{side}.{c} as {c}" for c in names) for side in "ab")
    return f"""
      select {old}, cast({number} as bigint) as version,
             case when b.o_orderkey is null then 'delete' else 'update_before' end as change
      from ({before}) a left join ({after}) b on a.o_orderkey = b.o_orderkey where b.o_orderkey is null or {changed}
      union all
      select {new}, {number}, case when a.o_orderkey is null then 'insert' else 'update_after' end
      from ({after}) b left join ({before}) a on a.o_orderkey = b.o_orderkey where a.o_orderkey is null or {changed}"""


FEED_SQL = f"{_feed_sql(1, FIRST, SECOND)} union all {_feed_sql(2, SECOND, THIRD)}"


@query("change_feed", FEED_SQL)
def _(t):
    return change_feed(three_versions(t, "change-feed"), 0, 2)


@query("version_as_of", f"""
    select *, 'read' as way from ({SECOND}) a union all select *, 'history' from ({SECOND}) b""")
def _(t):
    """The second of three versions, read as it was stored and put together from the rows' validity."""
    kept = three_versions(t, "version-as-of")
    stored = kept.read(1).withColumn("way", F.lit("read"))
    return stored.unionByName(as_of(validity(kept), 1).withColumn("way", F.lit("history")))


@query("validity", f"""
    select * from (
      select {COLUMNS}, cast(0 as bigint) as valid_from, cast(1 as bigint) as valid_to
      from (select {COLUMNS} from ({FIRST}) a except select {COLUMNS} from ({SECOND}) b) x
      union all
      select {COLUMNS}, 0, 2 from (
        (select {COLUMNS} from ({FIRST}) a intersect select {COLUMNS} from ({SECOND}) b)
        except select {COLUMNS} from ({THIRD}) c) x
      union all
      select {COLUMNS}, 0, null from (
        (select {COLUMNS} from ({FIRST}) a intersect select {COLUMNS} from ({SECOND}) b)
        intersect select {COLUMNS} from ({THIRD}) c) x
      union all
      select {COLUMNS}, 1, 2 from (
        (select {COLUMNS} from ({SECOND}) a except select {COLUMNS} from ({FIRST}) b)
        except select {COLUMNS} from ({THIRD}) c) x
      union all
      select {COLUMNS}, 1, null from (
        (select {COLUMNS} from ({SECOND}) a except select {COLUMNS} from ({FIRST}) b)
        intersect select {COLUMNS} from ({THIRD}) c) x
      union all
      select {COLUMNS}, 2, null from (
        select {COLUMNS} from ({THIRD}) a except select {COLUMNS} from ({SECOND}) b) x) y""")
def _(t):
    return validity(three_versions(t, "validity"))


@query("vacuum_plan", f"""
    with gone as (select distinct period from (({FIRST}) except all ({SECOND})) x union
                  select distinct period from (({SECOND}) except all ({FIRST})) y)
    select period as label, 'superseded' as reason from gone""")
def _(t):
    """Of three versions the first may go, the second is held by a reader: what only the first needs."""
    kept = three_versions(t, "vacuum-plan")
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=1)
    hold(kept, "report", 1, later)
    return vacuum_plan(kept, later, now=later - dt.timedelta(minutes=1)).select("label", "reason")


@query("vacuum_keeps", f"select *, 'held' as version from ({SECOND}) a union all select *, 'current' from ({THIRD}) b")
def _(t):
    """After the deletion the held and the current version read as before."""
    kept = three_versions(t, "vacuum-keeps")
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=1)
    hold(kept, "report", 1, later)
    vacuum(kept, later, now=later - dt.timedelta(minutes=1))
    return kept.read(1).withColumn("version", F.lit("held")).unionByName(kept.read().withColumn("version", F.lit("current")))


@query("compaction_plan", f"""
    select period as label, count(*) as n_rows, cast(1 as bigint) as n_files from ({FIRST}) a group by period""")
def _(t):
    """A table saved in small pieces: after the compaction each partition is one file, its rows as they were."""
    kept, size = store(t, "compaction"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = t.spark.conf.get(size, None)
    t.spark.conf.set(size, "1k")
    try:
        kept.save(first(t))
    finally:
        t.spark.conf.unset(size) if before is None else t.spark.conf.set(size, before)
    compact(kept, 128 << 20)
    folders = kept.state().select("label", "folder")
    files = stored(kept).join(folders, ["label", "folder"]).select("label", "n_files")
    return kept.read().groupBy(F.col("period").alias("label")).agg(F.count("*").alias("n_rows")).join(files, "label")


@query("clustered_read", """
    select 'customer' as way, o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m%d') as day, o_totalprice from {orders}
    where o_custkey between 20 and 40
    union all
    select 'day', o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m%d'), o_totalprice from {orders}
    where strftime(o_orderdate, '%Y%m%d') between '19960301' and '19960410'
    union all
    select 'both', o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m%d'), o_totalprice from {orders}
    where o_custkey between 20 and 400 and strftime(o_orderdate, '%Y%m%d') between '19960301' and '19961010'""")
def _(t):
    """A table clustered by customer and day, read by either and by both."""
    path = scratch_path(t.spark, "clustered")
    rows = t.table("orders").select("o_orderkey", "o_custkey", compact_text(F.col("o_orderdate")).alias("day"), "o_totalprice")
    write_clustered(rows, path, ("o_custkey", "day"), 16)
    days = {"day": ("19960301", "19960410")}
    parts = [read_clustered(t.spark, path, w).select(F.lit(way).alias("way"), "*") for way, w in (
        ("customer", {"o_custkey": (20, 40)}), ("day", days), ("both", {"o_custkey": (20, 400), "day": ("19960301", "19961010")}))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("stream_resolved", """
    select symbol, period_end, update_flag, ann_date, report_type, amount, order_key from (
      select *, row_number() over (partition by symbol, period_end order by cast(update_flag as int) desc, ann_date desc,
        update_flag, ann_date, report_type, amount, order_key) as rn from v_revisions) x where rn = 1""")
def _(t):
    """Revisions landed in four drops, the oldest last, each taken up by a stream of its own batches."""
    root = scratch_path(t.spark, "revisions")
    rows = t.view("v_revisions").withColumn("label", F.col("period_end").cast("string"))
    kept = PartitionStore(t.spark, f"{root}/table", "label", ["symbol", "period_end", "label"])
    for drop in (3, 1, 2, 0):
        rows.where(F.pmod("order_key", F.lit(4)) == drop).write.mode("append").parquet(f"{root}/drop")
        stream = t.spark.readStream.schema(rows.schema).parquet(f"{root}/drop")
        keep_resolved(stream, kept, "keep_latest_update", f"{root}/progress").awaitTermination()
    return kept.read().drop("label")
