"""Queries on record resolution, aggregates, audit, reshape, spines and derived metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from tallyloom.functions.codes import to_feed_code
from tallyloom.operators import derived, fill, measures, reshape, resolve, spine
from tallyloom.operators.lookup import mapped_name
from tallyloom.plans.backfill import backfill_plan
from tallyloom.quality import reconcile as rec
from tallyloom.quality import rules
from tallyloom.session import scratch_path
from tallyloom.sinks.writers import write_audit_report
from tallyloom.sources.scan import merge_pages, union_sources

KEYS = ["ts_code", "end_date", "f_ann_date"]
STAMPED_SQL = """
    select *, case when ts_code is not null
                   then count(*) over (partition by ts_code, end_date, f_ann_date) end as n,
           min(cast(update_flag as int)) over (partition by ts_code, end_date, f_ann_date) as lo,
           max(cast(update_flag as int)) over (partition by ts_code, end_date, f_ann_date) as hi,
           max(ann_date) over (partition by ts_code, end_date, f_ann_date) as last_day
    from v_stmt"""
STMT = "ts_code, end_date, f_ann_date, ann_date, update_flag, comp_type, total, order_key"
LOSES_01 = "(n = 2 and lo = 0 and hi = 1 and update_flag <> '1')"
LOSES_11 = "(n = 2 and lo = 1 and hi = 1 and (ann_date is null or ann_date <> last_day))"


@query("flag_01", f"""
    select {STMT} from ({STAMPED_SQL}) x where not coalesce({LOSES_01}, false)""")
def _(t):
    return resolve.resolve_01(t.view("v_stmt"))


@query("flag_11", f"""
    select {STMT} from ({STAMPED_SQL}) x where not coalesce({LOSES_11}, false)""")
def _(t):
    return resolve.resolve_11(t.view("v_stmt"))


@query("flag_11_slashes", f"""
    select {STMT} from ({STAMPED_SQL}) x where not coalesce({LOSES_11}, false)""")
def _(t):
    """Announcement days written with slashes: the later of two rows stays, as with any other form."""
    day = F.col("ann_date").cast("string")
    slashes = F.concat_ws("/", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2))
    rows = t.view("v_stmt").withColumn("ann_date", F.when(F.col("ann_date").isNotNull(), slashes))
    return resolve.resolve_11(rows).withColumn("ann_date", F.replace("ann_date", F.lit("/"), F.lit("")).cast("int"))


@query("flag_01_11", f"""
    select {STMT} from ({STAMPED_SQL}) x
    where not coalesce({LOSES_01}, false) and not coalesce({LOSES_11}, false)""")
def _(t):
    return resolve.resolve_flags(t.view("v_stmt"))


DIVIDEND_SQL = """
    select * from (
      select *, row_number() over (partition by ts_code, end_date, ann_date
                                   order by imp_ann_date desc, order_key) as rn,
             case when count(cash_div_tax) over w >= 2 and max(cash_div_tax) over w > 0
                  then (max(cash_div_tax) over w - min(cash_div_tax) over w)
                       / max(cash_div_tax) over w end as spread
      from v_div where div_proc = 'F'
      window w as (partition by ts_code, end_date, ann_date)) x
    where rn = 1 or spread > 0.1"""


@query("dividend_dedupe", f"select order_key, ts_code, end_date, cash_div_tax "
                          f"from ({DIVIDEND_SQL}) y")
def _(t):
    implemented = t.view("v_div").where("div_proc = 'F'")
    return resolve.resolve_dividends(implemented, tie_break=["order_key"]).select(
        "order_key", "ts_code", "end_date", "cash_div_tax")


@query("distinct_full", """
    select distinct ts_code, end_date, update_flag, comp_type from v_stmt""")
def _(t):
    return resolve.distinct_rows(t.view("v_stmt").select(
        "ts_code", "end_date", "update_flag", "comp_type"))


@query("distinct_subset", f"""
    select {STMT} from (select *, row_number() over (
      partition by ts_code, end_date order by order_key) as rn from v_stmt) x where rn = 1""")
def _(t):
    return resolve.distinct_on(t.view("v_stmt"), ["ts_code", "end_date", "absent"], ["order_key"])


@query("repeated_keys", """
    select ts_code, end_date, f_ann_date, count(*) as n_rows from v_stmt
    group by ts_code, end_date, f_ann_date having count(*) > 1""")
def _(t):
    return resolve.repeated_keys(t.view("v_stmt"), KEYS)


@query("unique_violations", f"""
    select {STMT} from (select *, count(*) over (
      partition by ts_code, end_date, f_ann_date) as n from v_stmt) x where n > 1""")
def _(t):
    return resolve.repeated_rows(t.view("v_stmt"), KEYS)


@query("group_extreme", """
    select ts_code, end_date, order_key, ann_date from (
      select *, max(ann_date) over (partition by ts_code, end_date) as top from v_stmt
      where ts_code is not null) x where ann_date = top""")
def _(t):
    return resolve.group_extreme(t.view("v_stmt"), ["ts_code", "end_date"], "ann_date").select(
        "ts_code", "end_date", "order_key", "ann_date")


@query("group_sizes", """
    select ts_code, end_date, count(*) as n_rows from v_stmt where ts_code is not null
    group by ts_code, end_date""")
def _(t):
    return measures.group_sizes(t.view("v_stmt"), ["ts_code", "end_date"])


def _strategy(name, order):
    @query(f"dedupe_{name}", f"""
        select symbol, period_end, update_flag, ann_date, report_type, amount, order_key from (
          select *, row_number() over (partition by symbol, period_end order by {order},
            update_flag, ann_date, report_type, amount, order_key) as rn from v_revisions) x
        where rn = 1""")
    def _(t):
        return resolve.dedupe_by_strategy(t.view("v_revisions"), ["symbol", "period_end"], name)


_strategy("keep_latest_update", "cast(update_flag as int) desc, ann_date desc")
_strategy("keep_earliest_ann", "ann_date")
_strategy("keep_official_report", "report_type, cast(update_flag as int) desc, ann_date desc")


@query("fill_const", """
    select order_key, coalesce(total_opcost, 0) as total_opcost,
           coalesce(assets_impair_loss, 0) as assets_impair_loss from v_income""")
def _(t):
    rows = t.view("v_income").select("order_key", "total_opcost", "assets_impair_loss")
    return fill.fill_constant(rows, 0.0)


FILL_SQL = """
    select order_key, {f}(total_opcost ignore nulls) over w as total_opcost,
           {f}(assets_impair_loss ignore nulls) over w as assets_impair_loss
    from v_income window w as (order by order_key rows between {frame})"""


@query("fill_forward", FILL_SQL.format(f="last_value",
                                       frame="unbounded preceding and current row"))
def _(t):
    rows = t.view("v_income").select("order_key", "total_opcost", "assets_impair_loss")
    return fill.fill_from_neighbours(rows, ["total_opcost", "assets_impair_loss"], ["order_key"])


@query("fill_back", FILL_SQL.format(f="first_value",
                                    frame="current row and unbounded following"))
def _(t):
    rows = t.view("v_income").select("order_key", "total_opcost", "assets_impair_loss")
    return fill.fill_from_neighbours(rows, ["total_opcost", "assets_impair_loss"], ["order_key"],
                                     forward=False)


@query("fill_per_code", """
    select d.ts_code, d.trade_date,
           last_value(a.factor ignore nulls) over (partition by d.ts_code order by d.trade_date
             rows between unbounded preceding and current row) as factor
    from v_daily d left join v_adj a on a.ts_code = d.ts_code and a.trade_date = d.trade_date""")
def _(t):
    rows = t.view("v_daily").select("ts_code", "trade_date").join(
        t.view("v_adj"), ["ts_code", "trade_date"], "left")
    return fill.fill_from_neighbours(rows, ["factor"], ["trade_date"], ["ts_code"])


# --- audit ---------------------------------------------------------------------------------

STMT_COLUMNS = ["ts_code", "end_date", "f_ann_date", "ann_date", "update_flag", "comp_type",
                "total", "order_key"]


@query("null_profile", " union all ".join(f"""
    select '{c}' as column_name, count(*) - count({c}) as n_null,
           round((count(*) - count({c})) * 1.0 / count(*), 6) as null_ratio from v_stmt"""
                                          for c in STMT_COLUMNS))
def _(t):
    return measures.null_profile(t.view("v_stmt")).withColumn(
        "null_ratio", F.round("null_ratio", 6))


@query("null_over_limit", " union all ".join(f"""
    select * from (select '{c}' as column_name, count(*) - count({c}) as n_null,
      round((count(*) - count({c})) * 1.0 / count(*), 6) as null_ratio from v_stmt) x
    where null_ratio > 0.02""" for c in STMT_COLUMNS))
def _(t):
    return rules.over_null_limit(t.view("v_stmt"), 0.02).withColumn(
        "null_ratio", F.round("null_ratio", 6))


DUP_SQL = """
    select sum(n) as n_rows, sum(n - 1) as n_duplicates from (
      select count(*) as n from v_stmt group by ts_code, end_date, f_ann_date) x"""


@query("dup_ratio", f"""
    select cast(n_rows as bigint) as n_rows, cast(n_duplicates as bigint) as n_duplicates,
           round(n_duplicates * 1.0 / n_rows, 6) as duplicate_ratio,
           case when n_duplicates * 1.0 / n_rows <= 0.01 then 'PASS' else 'FAIL' end as status
    from ({DUP_SQL}) y""")
def _(t):
    return rules.duplicate_ratio(t.view("v_stmt"), KEYS).withColumn(
        "duplicate_ratio", F.round("duplicate_ratio", 6))


@query("pk_check", f"""
    select cast(n_duplicates as bigint) as n_duplicates,
           case when n_duplicates = 0 then 'PASS' else 'FAIL' end as status from ({DUP_SQL}) y""")
def _(t):
    return rules.key_uniqueness(t.view("v_stmt"), KEYS)


@query("outliers", """
    with m as (select avg(value) as mean, stddev_samp(value) as std from {events})
    select 'value' as column_name, round(any_value(mean), 4) as mean, round(any_value(std), 4) as std,
           count(case when abs(value - mean) > 5 * std then 1 end) as n_outliers,
           round(count(case when abs(value - mean) > 5 * std then 1 end) * 1.0 / count(*), 6)
             as outlier_ratio
    from {events}, m""")
def _(t):
    return rules.outlier_profile(t.table("events"), ["value"]).withColumns({
        "mean": F.round("mean", 4), "std": F.round("std", 4),
        "outlier_ratio": F.round("outlier_ratio", 6)})


@query("ann_order", """
    select count(*) as n_rows, count(case when ann_date <= period_end then 1 end) as n_invalid,
           cast(0 as bigint) as n_unreadable, case when count(case when ann_date <= period_end then 1 end) = 0
             then 'PASS' else 'FAIL' end as status from v_pitdates""")
def _(t):
    return rules.announcement_order(t.view("v_pitdates"))


def _audited(t):
    stmt = t.view("v_stmt").withColumn("period_end", F.col("end_date"))
    return rules.audit(stmt, KEYS, {"total": "float", "order_key": "int", "ts_code": "str",
                                    "ann_date": "str"})


AUDIT_SQL = f"""
    select 'DQ001' as rule_id, 'data_quality' as category, 'WARNING' as level,
      case when max(r) > 0.95 then 'FAIL' else 'PASS' end as status from (
        select (count(*) - count(ts_code)) * 1.0 / count(*) as r from v_stmt
        union all select (count(*) - count(ann_date)) * 1.0 / count(*) from v_stmt) x
    union all select 'DQ002', 'data_quality', 'ERROR',
      case when n_duplicates * 1.0 / n_rows <= 0.01 then 'PASS' else 'FAIL' end from ({DUP_SQL}) y
    union all select 'DQ003', 'data_quality', 'INFO',
      case when max(r) < 0.05 then 'PASS' else 'WARNING' end from (
        select count(case when abs(total - (select avg(total) from v_stmt))
            > 5 * (select stddev_samp(total) from v_stmt) then 1 end) * 1.0 / count(*) as r
        from v_stmt) z
    union all select 'DQ004', 'data_quality', 'ERROR', 'FAIL'
    union all select 'SC001', 'schema_compliance', 'CRITICAL', 'PASS'
    union all select 'SC002', 'schema_compliance', 'CRITICAL',
      case when n_duplicates = 0 then 'PASS' else 'FAIL' end from ({DUP_SQL}) y
    union all select 'PIT001', 'pit_compliance', 'ERROR',
      case when count(case when ann_date <= end_date then 1 end) = 0 then 'PASS' else 'FAIL' end
      from v_stmt"""


@query("audit_report", AUDIT_SQL)
def _(t):
    return _audited(t).select("rule_id", "category", "level", "status")


@query("audit_sink", AUDIT_SQL)
def _(t):
    """The report as it was written and is read back."""
    path, results = scratch_path(t.spark, "audit"), _audited(t)
    write_audit_report(results, rules.verdict(results), path)
    return t.spark.read.schema("rule_id string, category string, level string, status string").json(f"{path}/results")


@query("audit_rollup", f"""
    with a as ({AUDIT_SQL})
    select 'status' as dimension, status as value, count(*) as n_results from a group by 2
    union all select 'level', level, count(*) from a group by 2
    union all select 'category', category, count(*) from a group by 2""")
def _(t):
    return rules.rollup(_audited(t))


@query("audit_verdict", f"""
    with a as ({AUDIT_SQL})
    select bool_or(status = 'FAIL' and level = 'CRITICAL') as has_critical_issues,
           bool_or(status = 'FAIL' and level = 'ERROR') as has_errors,
           round(count(case when status = 'PASS' then 1 end) * 1.0 / count(*), 6) as pass_rate
    from a""")
def _(t):
    return rules.verdict(_audited(t)).withColumn("pass_rate", F.round("pass_rate", 6))


@query("quality_report", """
    select 'rows' as measure, count(*) as value from v_stmt
    union all select 'columns', 6
    union all select 'duplicate_rows', (select count(*) from v_stmt) - (select count(*) from (
      select distinct ts_code, end_date, f_ann_date, ann_date, update_flag, comp_type
      from v_stmt) x)
    union all select 'nulls:ts_code', count(*) from v_stmt where ts_code is null
    union all select 'nulls:ann_date', count(*) from v_stmt where ann_date is null""")
def _(t):
    return rules.quality_report(t.view("v_stmt").drop("total", "order_key"))


@query("relationship_groups", """
    with parts as (
      select section, position, field, report_item,
             trim(unnest(string_split(relationship, ';'))) as part from v_relcfg),
    marked as (
      select section, position, field, report_item,
             regexp_extract(part, '^(-?)([0-9]+)', 2) as group_id,
             (strpos(part, '_') = 0 or part like '%\\_' escape '\\') as is_total,
             regexp_matches(part, '^-?[0-9]+_1$') as is_component,
             part like '-%' as negative
      from parts where regexp_matches(part, '^-?[0-9]+(_.*)?$')),
    totals as (select section, group_id, min(position) as position from marked
               where is_total group by 1, 2),
    comps as (select distinct section, group_id, field, negative from marked where is_component)
    select t.section, t.group_id, m.report_item as group_name, m.field as total,
           count(*) as n_components, count(case when c.negative then 1 end) as n_negative
    from totals t
    join marked m on m.section = t.section and m.group_id = t.group_id
                 and m.position = t.position and m.is_total
    join comps c on c.section = t.section and c.group_id = t.group_id
    group by 1, 2, 3, 4""")
def _(t):
    items = rec.relationship_items(t.view("v_relcfg"), ["section"])
    return rec.complete_groups(items, ["section"])


RECON_SECTION = {
    "total_ok": {"relationship": "1", "report_item": "total"},
    "part_o": {"relationship": "1_1;2_1", "report_item": "open part"},
    "part_f": {"relationship": "1_1;2_1", "report_item": "final part"},
    "disc": {"relationship": "-1_1;-2_1", "report_item": "less: discount"},
    "total_bad": {"relationship": "2_;3_1", "report_item": "total and component"},
    "lonely": {"relationship": "4", "report_item": "no components"},
    "ignored": {"relationship": "1_2", "report_item": "second level"},
}


def recon_sql(group_id, name, total):
    gap = (f"case when part_o is null and part_f is null and disc is null then null else abs("
           f"coalesce(part_o, 0) + coalesce(part_f, 0) - coalesce(disc, 0) - {total}) end")
    return f"""
        select '{group_id}' as group_id, '{name}' as group_name, count(gap) as valid_records,
               count(case when gap > 50000 then 1 end) as large_diff_count,
               round(count(case when gap > 50000 then 1 end) * 100.0 / count(gap), 4)
                 as large_diff_percentage,
               count(case when gap > 50000 then 1 end) * 100.0 / count(gap) <= 3 as passed
        from (select {gap} as gap from v_recon where comp_type = '1') x"""


@query("reconciliation", recon_sql("1", "total", "total_ok") + " union all "
       + recon_sql("2", "total and component", "total_bad"))
def _(t):
    groups = rec.groups_from_section(RECON_SECTION, t.spark)
    results = rec.reconcile(t.view("v_recon").where("comp_type = '1'"), groups)
    return results.select("group_id", "group_name", "valid_records", "large_diff_count",
                          F.round("large_diff_percentage", 4).alias("large_diff_percentage"),
                          "passed")


# --- reshape -------------------------------------------------------------------------------

PIT_SQL = """
    select lower(substr(ts_code, 8, 2)) || substr(ts_code, 1, 6) as symbol,
           cast(floor(end_date / 10000) * 100 + floor((floor(end_date % 10000 / 100) - 1) / 3) + 1
                as int) as period,
           substr(cast(ann_date as string), 1, 4) || '-' || substr(cast(ann_date as string), 5, 2)
             || '-' || substr(cast(ann_date as string), 7, 2) as datetime,
           '{field}_q' as field, {column} as value
    from v_stmt_clean where {column} is not null"""


@query("pit_long", PIT_SQL.format(field="sales", column="revenue") + " union all "
       + PIT_SQL.format(field="profit", column="profit"))
def _(t):
    long = reshape.to_point_in_time(t.view("v_stmt_clean"),
                                    field_names={"revenue": "sales", "profit": "profit"})
    return long.withColumn("datetime", F.col("datetime").cast("string"))


@query("pit_sources", "select 'a' as data_type, * from (" + PIT_SQL.format(
    field="revenue", column="revenue") + " union all " + PIT_SQL.format(
        field="profit", column="profit") + ") x union all select 'b', * from ("
       + PIT_SQL.format(field="profit", column="profit") + ") y")
def _(t):
    clean = t.view("v_stmt_clean")
    long = reshape.statements_to_point_in_time({"a": clean, "b": clean.drop("revenue")})
    return long.withColumn("datetime", F.col("datetime").cast("string"))


@query("field_map", """
    select order_key, case update_flag when '0' then 'first' else update_flag end as flag
    from v_stmt""")
def _(t):
    return t.view("v_stmt").select("order_key", mapped_name(
        F.col("update_flag"), {"0": "first", "7": "never"}).alias("flag"))


@query("explode_blocks", """
    select request_id, cast(datediff('day', start_day, d) as int) as block_index,
           cast(datediff('day', start_day, end_day) + 1 as int) as total_blocks,
           strftime(d, '%Y%m%d') as first_day, strftime(d + interval 7 day, '%Y%m%d') as last_day
    from (select request_id, start_day, end_day, cast(unnest(generate_series(
            cast(start_day as timestamp), cast(end_day as timestamp), interval 1 day)) as date) as d
          from v_ranges) x""")
def _(t):
    days = F.sequence("start_day", "end_day")
    lists = t.view("v_ranges").select(
        "request_id", F.transform(days, lambda d: F.date_format(d, "yyyyMMdd")).alias("first_day"),
        F.transform(days, lambda d: F.date_format(F.date_add(d, 7), "yyyyMMdd"))
        .alias("last_day"))
    return reshape.explode_blocks(lists, ["first_day", "last_day"])


# --- spines --------------------------------------------------------------------------------

DAYS_SQL = """select request_id, symbol, yq, start_day, end_day, cast(unnest(generate_series(
      cast(start_day as timestamp), cast(end_day as timestamp), interval 1 day)) as date) as d
    from v_ranges"""
COMPACT_SQL = "strftime({c}, '%Y%m%d')"


@query("natural_spine", f"select request_id, {COMPACT_SQL.format(c='d')} as day from "
                        f"({DAYS_SQL}) x")
def _(t):
    return spine.natural_days(t.view("v_ranges")).select(
        "request_id", F.date_format("day", "yyyyMMdd").alias("day"))


TRADE_SQL = f"""
    select x.request_id, {COMPACT_SQL.format(c='x.d')} as day,
           cast(row_number() over (partition by x.request_id order by x.d desc) - 1 as int)
             as entry
    from ({DAYS_SQL}) x join v_calendar c
      on c.cal_date = {COMPACT_SQL.format(c='x.d')} and c.is_open = 1"""


@query("trade_spine", TRADE_SQL)
def _(t):
    return spine.trade_days(t.view("v_ranges"), t.view("v_calendar")).select(
        "request_id", F.date_format("trade_day", "yyyyMMdd").alias("day"), "entry")


@query("recent_periods", f"select * from ({TRADE_SQL}) y where entry < 3")
def _(t):
    asked = spine.max_periods(F.lit(2), F.lit(1.5))
    return spine.trade_days(t.view("v_ranges"), t.view("v_calendar"), asked).select(
        "request_id", F.date_format("trade_day", "yyyyMMdd").alias("day"), "entry")


@query("month_spine", f"""
    select request_id, {COMPACT_SQL.format(c='m')} as month_start,
           {COMPACT_SQL.format(c="least(cast(m + interval 1 month - interval 1 day as date), end_day)")}
             as month_end
    from (select request_id, end_day, unnest(generate_series(
            date_trunc('month', cast(start_day as timestamp)), cast(end_day as timestamp),
            interval 1 month)) as m from v_ranges) x""")
def _(t):
    return spine.month_ranges(t.view("v_ranges")).select(
        "request_id", F.date_format("month_start", "yyyyMMdd").alias("month_start"),
        F.date_format("month_end", "yyyyMMdd").alias("month_end"))


QUARTERS_SQL = """
    select r.request_id, r.start_day, r.end_day, y.y * 10000 + q.q as quarter_end
    from v_ranges r
    join (select unnest(generate_series(1980, 2030)) as y) y
      on y.y between year(r.start_day) - 1 and year(r.end_day)
    cross join (select unnest([331, 630, 930, 1231]) as q) q"""


@query("quarter_spine", f"select request_id, cast(quarter_end as int) as quarter_end "
                        f"from ({QUARTERS_SQL}) x")
def _(t):
    rows = spine.quarter_ends(t.view("v_ranges"))
    return rows.select("request_id", F.date_format("quarter_end", "yyyyMMdd").cast("int")
                       .alias("quarter_end"))


@query("quarter_spine_clipped", f"""
    select request_id, cast(quarter_end as int) as quarter_end from ({QUARTERS_SQL}) x
    where quarter_end between cast({COMPACT_SQL.format(c='start_day')} as int)
                          and cast({COMPACT_SQL.format(c='end_day')} as int)""")
def _(t):
    rows = spine.quarter_ends(t.view("v_ranges"), clip=True)
    return rows.select("request_id", F.date_format("quarter_end", "yyyyMMdd").cast("int")
                       .alias("quarter_end"))


BLOCKS_SQL = """
    with r as (
      select dataset, placeholder, yq, truncate,
             cast(strptime(start_date || '01', '%Y%m%d') as timestamp) as a,
             cast(strptime(end_date, '%Y%m%d') as timestamp) as b
      from v_plan_requests),
    blocks as (
      select dataset, placeholder, yq, truncate, strftime(d, '%Y%m%d') as param_start,
             strftime(d, '%Y%m%d') as param_end, strftime(d, '%Y%m%d') as period
      from (select *, unnest(generate_series(a, b, interval 1 day)) as d from r
            where placeholder = '<NATURAL_DATE>') x
      union all
      select dataset, placeholder, yq, truncate, strftime(d, '%Y%m%d'), strftime(d, '%Y%m%d'),
             strftime(d, '%Y%m%d')
      from (select *, unnest(generate_series(a, b, interval 1 day)) as d from r
            where placeholder = '<TRADE_DATE>') x
      join v_calendar c on c.cal_date = strftime(d, '%Y%m%d') and c.is_open = 1
      union all
      select dataset, placeholder, yq, truncate, strftime(m, '%Y%m%d'),
             strftime(least(m + interval 1 month - interval 1 day, b), '%Y%m%d'),
             strftime(m, '%Y%m')
      from (select *, unnest(generate_series(a, b, interval 1 month)) as m from r
            where placeholder = '<MONTHLY_DATE_RANGE>') x
      union all
      select dataset, placeholder, yq, truncate, cast(y * 10000 + q as string),
             cast(y * 10000 + q as string), cast(y as string) || 'Q' || cast(q // 300 as string)
      from r join (select unnest(generate_series(1980, 2030)) as y) y
          on y.y between year(a) - 1 and year(b)
        cross join (select unnest([331, 630, 930, 1231]) as q) q
      where placeholder = '<QUARTERLY_DATE>'),
    numbered as (
      select *, cast(row_number() over (partition by dataset, yq order by param_start desc) - 1
                     as int) as block_index from blocks)
    select n.dataset, n.yq, n.block_index, n.param_start, n.param_end, n.period
    from numbered n left join v_landed l on l.dataset = n.dataset and l.period = n.period
    where l.dataset is null and (not n.truncate or n.block_index < 3)"""


@query("backfill_plan", BLOCKS_SQL)
def _(t):
    plan = backfill_plan(t.view("v_plan_requests"), t.view("v_calendar"), t.view("v_landed"))
    return plan.select("dataset", "yq", "block_index", "param_start", "param_end", "period")


# --- unions --------------------------------------------------------------------------------

@query("union_sources", """
    select c_custkey as key, c_name as name, c_acctbal as balance, c_mktsegment as segment
    from {customer} union all select s_suppkey, s_name, s_acctbal, null from {supplier}""")
def _(t):
    customers = t.table("customer").selectExpr("c_custkey as key", "c_name as name",
                                               "c_acctbal as balance", "c_mktsegment as segment")
    suppliers = t.table("supplier").selectExpr("s_acctbal as balance", "s_suppkey as key",
                                               "s_name as name")
    return union_sources([customers, suppliers])


@query("page_merge", """
    select distinct o_custkey, o_orderstatus, cast(o_orderdate as string) as day from {orders}""")
def _(t):
    page = t.table("orders").select("o_custkey", "o_orderstatus",
                                    F.col("o_orderdate").cast("string").alias("day"))
    return merge_pages([page, page.select("day", "o_custkey", "o_orderstatus")])


# --- derived metrics -----------------------------------------------------------------------

@query("single_quarter", """
    select c.ts_code, c.fy, c.q, c.revenue_sc,
           round(case when c.q = 1 then c.revenue_sc else c.revenue_sc - p.revenue_sc end, 2)
             as revenue_sq
    from v_cum c left join v_cum p on p.ts_code = c.ts_code and p.fy = c.fy and p.q = c.q - 1""")
def _(t):
    return derived.single_quarter(t.view("v_cum"), "ts_code", "fy", "q", "revenue_sc",
                                  "revenue_sq").withColumn("revenue_sq", F.round("revenue_sq", 2))


@query("negative_quarters", """
    select count(sq) as n_values, count(case when sq < 0 then 1 end) as n_negative,
           count(case when sq < 0 then 1 end) * 1.0 / count(sq) <= 0.1 as plausible
    from (select case when c.q = 1 then c.revenue else c.revenue - p.revenue end as sq
          from v_quarterly c left join v_quarterly p
            on p.ts_code = c.ts_code and p.fy = c.fy and p.q = c.q - 1) x""")
def _(t):
    # Plain quarterly amounts read as if they were cumulative: many differences are negative.
    single = derived.single_quarter(t.view("v_quarterly"), "ts_code", "fy", "q", "revenue", "sq")
    return derived.negative_share(single, "sq")


TTM_SQL = """
    select c.ts_code, c.fy, c.q, c.revenue,
           case when count(p.revenue) = 4 then round(sum(p.revenue), 2) end as revenue_ttm
    from v_quarterly c join v_quarterly p on p.ts_code = c.ts_code
      and p.fy * 4 + p.q between c.fy * 4 + c.q - 3 and c.fy * 4 + c.q
    group by 1, 2, 3, 4"""


@query("ttm", TTM_SQL)
def _(t):
    return derived.trailing_year(t.view("v_quarterly"), "ts_code", "fy", "q", "revenue",
                                 "revenue_ttm").withColumn("revenue_ttm",
                                                           F.round("revenue_ttm", 2))


@query("ttm_coverage", f"""
    select count(*) as n_rows, count(revenue_ttm) as n_covered,
           count(revenue_ttm) * 1.0 / count(*) >= 0.8 as enough from ({TTM_SQL}) x""")
def _(t):
    rows = derived.trailing_year(t.view("v_quarterly"), "ts_code", "fy", "q", "revenue", "ttm")
    return derived.trailing_coverage(rows, "ttm")


def _growth(name, back):
    @query(name, f"""
        select c.ts_code, c.fy, c.q, c.revenue,
               round((c.revenue - p.revenue) / nullif(abs(p.revenue), 0), 6) as revenue_{name}
        from v_quarterly c left join v_quarterly p on p.ts_code = c.ts_code
          and p.fy * 4 + p.q = c.fy * 4 + c.q - {back}""")
    def _(t):
        target = f"revenue_{name}"
        return derived.growth(t.view("v_quarterly"), "ts_code", "fy", "q", "revenue", target,
                              back).withColumn(target, F.round(target, 6))


_growth("yoy", 4)
_growth("qoq", 1)


@query("available_date", f"""
    select p.l_orderkey, p.l_linenumber, p.ann_date_text, min(c.cal_date) as available
    from (select l_orderkey, l_linenumber, {COMPACT_SQL.format(c='ann_date')} as ann_date_text,
                 row_number() over () as id from v_pitdates) p
    left join (select ann, min(cal_date) as cal_date from (
        select distinct {COMPACT_SQL.format(c='ann_date')} as ann from v_pitdates) a
      join (select cal_date from v_calendar where is_open = 1) k on k.cal_date > a.ann
      group by ann) c on c.ann = p.ann_date_text
    group by p.id, 1, 2, 3""")
def _(t):
    rows = t.view("v_pitdates").select("l_orderkey", "l_linenumber", "ann_date")
    known = spine.available_from(rows, t.view("v_calendar"), "ann_date", "available")
    return known.select("l_orderkey", "l_linenumber",
                        F.date_format("ann_date", "yyyyMMdd").alias("ann_date_text"),
                        F.date_format("available", "yyyyMMdd").alias("available"))


@query("available_date_open", f"""
    select p.l_orderkey, p.l_linenumber, p.ann_date_text, min(c.cal_date) as available
    from (select l_orderkey, l_linenumber, {COMPACT_SQL.format(c='ann_date')} as ann_date_text,
                 row_number() over () as id from v_pitdates) p
    left join (select ann, min(cal_date) as cal_date from (
        select distinct {COMPACT_SQL.format(c='ann_date')} as ann from v_pitdates) a
      join (select cal_date from v_calendar where is_open = 1) k on k.cal_date >= a.ann
      group by ann) c on c.ann = p.ann_date_text
    group by p.id, 1, 2, 3""")
def _(t):
    rows = t.view("v_pitdates").select("l_orderkey", "l_linenumber", "ann_date")
    known = spine.available_from(rows, t.view("v_calendar"), "ann_date", "available",
                                 after_close=False)
    return known.select("l_orderkey", "l_linenumber",
                        F.date_format("ann_date", "yyyyMMdd").alias("ann_date_text"),
                        F.date_format("available", "yyyyMMdd").alias("available"))


@query("contract_codes", """
    select distinct substr(ts_code, 8, 2) || substr(ts_code, 1, 6) as code from v_security""")
def _(t):
    return t.view("v_security").select(to_feed_code(F.col("ts_code"), upper=True).alias("code")
                                       ).distinct()
