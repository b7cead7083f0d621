"""Queries on filters, projections, scalar functions and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from tallyloom import contracts as C
from tallyloom.functions import amounts, codes, dates
from tallyloom.operators import columns, filters, lookup, measures
from tallyloom.operators.keyed import rows_without_key
from tallyloom.operators.spine import entity_spine, natural_days
from tallyloom.plans.feed import daily_feed
from tallyloom.plans.processors import fix_losses, fix_total_cost, put_fixed
from tallyloom.sinks.layout import request_errors, with_layout
from tallyloom.sources.landing import in_range, with_period_bounds

# The data covers 1992-2001, so the dates at which rules change are set inside it.
FLOOR, SIGN_CHANGE = 19960101, 19980630

SECTION = {
    "total": {"renamed_field": "total_amount", "relationship": "1", "report_item": "total"},
    "order_key": {"renamed_field": "doc_no"},
    "comp_type": {},
}

LISTED_SQL = f"""
    trade_date >= case when ts_code like '%.BJ' then greatest(cast(list_date as int), {FLOOR})
                       else cast(list_date as int) end
    and (delist_date is null or trade_date <= cast(delist_date as int))"""
FEED_CODE_SQL = "lower(substr({c}, 8, 2)) || substr({c}, 1, 6)"
ISO_SQL = ("substr(cast({c} as string), 1, 4) || '-' || substr(cast({c} as string), 5, 2) || '-' "
           "|| substr(cast({c} as string), 7, 2)")
CODE_SQL = """case when strpos({c}, '.') > 0 then split_part({c}, '.', 1)
    when substr({c}, 1, 2) in ('SZ', 'SH') then substr({c}, 3) else {c} end"""


def listed(t):
    return filters.within_listing(filters.nonempty_key(t.view("v_daily")), floor=FLOOR)


@query("daily_feed", f"""
    select {FEED_CODE_SQL.format(c='d.ts_code')} as symbol,
           {ISO_SQL.format(c='d.trade_date')} as date, d.low, d.high, d.volume, a.factor, b.pe
    from (select * from v_daily where {LISTED_SQL}) d
    left join v_adj a on a.ts_code = d.ts_code and a.trade_date = d.trade_date
    left join v_basic b on b.ts_code = d.ts_code and b.trade_date = d.trade_date""")
def _(t):
    feed = daily_feed({"daily": listed(t), "adj": t.view("v_adj"), "basic": t.view("v_basic")},
                      required=["low", "high", "volume"], basic=["pe"])
    return feed.withColumn("date", F.col("date").cast("string"))


@query("daily_feed_prefixed", """
    select d.ts_code, d.trade_date, d.low, b.low as basic_low, b.pe
    from v_daily d left join v_basic b on b.ts_code = d.ts_code and b.trade_date = d.trade_date""")
def _(t):
    joined = lookup.left_fold(t.view("v_daily"), {"basic": t.view("v_basic")}, clash="prefix")
    return joined.select("ts_code", "trade_date", "low", "basic_low", "pe")


@query("key_not_empty", """
    select * from v_stmt where ts_code is not null and ts_code <> '' and ts_code <> ' '""")
def _(t):
    return filters.nonempty_key(t.view("v_stmt"))


@query("drop_null_ann", "select * from v_stmt where ann_date is not null")
def _(t):
    return filters.nonnull(t.view("v_stmt"), "ann_date")


CONDITIONS = {
    "eq": ("volume", "==2", "volume = 2"),
    "ne": ("delist_date", "!=19990630", "delist_date is distinct from '19990630'"),
    "ge": ("high", ">=200000", "high >= 200000"),
    "le": ("high", "<=200000", "high <= 200000"),
    "gt": ("trade_date", ">19980101", "trade_date > 19980101"),
    "lt": ("trade_date", "<19980101", "trade_date < 19980101"),
    "notna": ("delist_date", "notna", "delist_date is not null"),
    "isna": ("delist_date", "isna", "delist_date is null"),
}


def _condition_query(name, column, condition, where):
    @query(f"cond_filter_{name}", f"select * from v_daily where {where}")
    def _(t):
        return filters.matching(t.view("v_daily"), column, condition)


for _name, _parts in CONDITIONS.items():
    _condition_query(_name, *_parts)


@query("listing_window", f"select * from v_daily where {LISTED_SQL}")
def _(t):
    return filters.within_listing(t.view("v_daily"), floor=FLOOR)


@query("implemented_only", "select order_key, ts_code, cash_div_tax from v_div where div_proc = 'F'")
def _(t):
    return filters.with_status(t.view("v_div"), status="F").select(
        "order_key", "ts_code", "cash_div_tax")


@query("comp_type_filter", "select * from v_stmt where comp_type = '1'")
def _(t):
    return filters.company_type(t.view("v_stmt"))


@query("ordered_projection", """
    select ts_code, f_ann_date, end_date, comp_type, ann_date, update_flag, total as total_amount
    from v_stmt""")
def _(t):
    renamed = columns.rename_section(columns.drop_fields(t.view("v_stmt"), "order_key", "ebit"),
                                     SECTION)
    return columns.statement_projection(renamed, SECTION)


@query("indicator_projection",
       "select ts_code, ann_date, end_date, update_flag, total as total_amount from v_stmt")
def _(t):
    renamed = columns.rename_section(t.view("v_stmt"), {"total": SECTION["total"]})
    return columns.indicator_projection(renamed, {"total": SECTION["total"]})


@query("quote_projection", "select ts_code, trade_date, high, low, volume from v_daily")
def _(t):
    return columns.ordered(t.view("v_daily"), C.DAILY_FIELDS)


@query("section_rename", """
    select ts_code, end_date, f_ann_date, ann_date, update_flag, comp_type,
           total as total_amount, order_key as doc_no from v_stmt""")
def _(t):
    return columns.rename_section(t.view("v_stmt"), SECTION)


@query("rename_column", "select ts_code as code, trade_date, factor from v_adj")
def _(t):
    return columns.rename_one(columns.rename_one(t.view("v_adj"), "ts_code", "code"), "no", "x")


@query("dividend_rename", """
    select ts_code, end_date, ann_date, cast(imp_ann_date as string) as imp_ann_date, div_proc,
           cash_div_tax as dps, order_key from v_div""")
def _(t):
    renamed = columns.rename_section(t.view("v_div"), {"cash_div_tax": {"renamed_field": "dps"}})
    return renamed.withColumn("imp_ann_date", F.col("imp_ann_date").cast("string"))


@query("replace_fixed", f"""
    select order_key, end_date, total_cogs,
           coalesce(total_opcost, total_cogs
             + case when end_date >= {SIGN_CHANGE} then credit_impa_loss else -credit_impa_loss end
             + case when end_date >= {SIGN_CHANGE} then assets_impair_loss
                    else -assets_impair_loss end) as total_opcost,
           case when end_date >= {SIGN_CHANGE} then credit_impa_loss else -credit_impa_loss end
             as credit_impa_loss,
           case when end_date >= {SIGN_CHANGE} then assets_impair_loss
                else -assets_impair_loss end as assets_impair_loss
    from v_income""")
def _(t):
    return put_fixed(fix_total_cost(fix_losses(t.view("v_income"), SIGN_CHANGE)))


@query("sign_fix", f"""
    select order_key, case when end_date >= {SIGN_CHANGE} then assets_impair_loss
                           else -assets_impair_loss end as fixed from v_income""")
def _(t):
    return t.view("v_income").select("order_key", amounts.sign_by_date(
        F.col("assets_impair_loss"), F.col("end_date"), SIGN_CHANGE).alias("fixed"))


@query("fallback_total", """
    select order_key, coalesce(total_opcost, total_cogs + credit_impa_loss + assets_impair_loss)
                        as total from v_income""")
def _(t):
    return t.view("v_income").select("order_key", amounts.fallback_total(
        F.col("total_opcost"), F.col("total_cogs"), F.col("credit_impa_loss"),
        F.col("assets_impair_loss")).alias("total"))


@query("date_normalise", """
    select order_key, case when strpos(date_text, 'T') > 0
                             then replace(split_part(date_text, 'T', 1), '-', '')
                           when strpos(date_text, ' ') > 0
                             then replace(split_part(date_text, ' ', 1), '-', '')
                           else replace(date_text, '-', '') end as day from v_dates""")
def _(t):
    return dates.normalise_date(t.view("v_dates"), "date_text", "day").select("order_key", "day")


@query("compact_dates", f"""
    select order_key, {ISO_SQL.format(c='ann_date')} as day from v_stmt""")
def _(t):
    return t.view("v_stmt").select(
        "order_key", dates.parse_compact(F.col("ann_date")).cast("string").alias("day"))


@query("symbol_convert", f"""
    select ts_code, {FEED_CODE_SQL.format(c='ts_code')} as feed_code,
           upper({FEED_CODE_SQL.format(c='ts_code')}) as contract_code, trade_date from v_daily""")
def _(t):
    return t.view("v_daily").select(
        "ts_code", codes.to_feed_code(F.col("ts_code")).alias("feed_code"),
        codes.to_feed_code(F.col("ts_code"), upper=True).alias("contract_code"), "trade_date")


@query("symbol_reverse", "select ts_code, trade_date from v_daily")
def _(t):
    feed = t.view("v_daily").select(codes.to_feed_code(F.col("ts_code")).alias("s"), "trade_date")
    return feed.select(codes.from_feed_code(F.col("s")).alias("ts_code"), "trade_date")


@query("code_variants", f"""
    select code, trade_date, {CODE_SQL.format(c='code')} as digits,
           case when strpos(code, '.') > 0 then split_part(code, '.', 2) || split_part(code, '.', 1)
                end as exchange_first
    from v_daily_raw""")
def _(t):
    code = F.col("code")
    return t.view("v_daily_raw").select(
        "code", "trade_date", codes.code_digits(code).alias("digits"),
        F.when(code.contains("."), codes.exchange_first(code)).alias("exchange_first"))


@query("quarter_from_path", """
    select order_key, case when regexp_matches(file_path, '[0-9]{4}Q[0-9]')
      then regexp_extract(file_path, '([0-9]{4})Q([0-9])', 1)
        || (case regexp_extract(file_path, '([0-9]{4})Q([0-9])', 2) when '1' then '0331'
              when '2' then '0630' when '3' then '0930' else '1231' end) end as end_date
    from v_paths""")
def _(t):
    return t.view("v_paths").select(
        "order_key", dates.quarter_end_from_path(F.col("file_path")).alias("end_date"))


PERIOD_SQL = """
    select order_key,
      case when p like '______/__/%' then 'daily' when p like '______/%' then 'monthly'
           when p like '____Q_/%' then 'quarterly' when p like '____/%' then 'yearly' end as grain,
      case when p like '______/__/%' then substr(p, 1, 6) || substr(p, 8, 2)
           when p like 'snapshot/%' then null when p like '____Q_/%' then substr(p, 1, 6)
           when p like '______/%' then substr(p, 1, 6) when p like '____/%' then substr(p, 1, 4)
           end as period
    from (select order_key, substr(file_path, 14) as p from v_paths) x"""
PERIOD_SQL = PERIOD_SQL.replace(
    "case when p like '______/__/%' then 'daily' when p like '______/%' then 'monthly'",
    "case when p like 'snapshot/%' then null when p like '____Q_/%' then 'quarterly'\n"
    "           when p like '______/__/%' then 'daily' when p like '______/%' then 'monthly'")


@query("period_from_path", PERIOD_SQL)
def _(t):
    label = dates.path_period(F.substring_index("file_path", "/m/", -1))
    paths = t.view("v_paths").select("order_key", label.alias("period"))
    return paths.withColumn("grain", dates.period_grain(F.col("period")))


@query("periods_in_range", f"""
    with p as ({PERIOD_SQL}),
    b as (select order_key, period,
        case grain when 'daily' then strptime(period, '%Y%m%d')
          when 'monthly' then strptime(period || '01', '%Y%m%d')
          when 'quarterly' then make_date(cast(substr(period, 1, 4) as int),
                                          cast(substr(period, 6, 1) as int) * 3 - 2, 1)
          when 'yearly' then make_date(cast(period as int), 1, 1) end as a,
        case grain when 'daily' then interval 1 day when 'monthly' then interval 1 month
          when 'quarterly' then interval 3 month else interval 1 year end as w from p)
    select order_key, period from b
    where a <= date '1998-05-15' and a + w > date '1997-02-10'""")
def _(t):
    label = dates.path_period(F.substring_index("file_path", "/m/", -1))
    files = with_period_bounds(t.view("v_paths").select("order_key", label.alias("period")))
    return in_range(files, "19970210", "19980515").select("order_key", "period")


@query("fiscal_period", """
    select order_key,
           cast(floor(end_date / 10000) * 100 + floor((floor(end_date % 10000 / 100) - 1) / 3) + 1
                as int) as quarter_no,
           cast(floor(end_date / 10000) as int) as year_no from v_stmt""")
def _(t):
    return t.view("v_stmt").select(
        "order_key", dates.fiscal_period(F.col("end_date")).alias("quarter_no"),
        dates.fiscal_period(F.col("end_date"), "annual").alias("year_no"))


@query("lenient_cast", """
    select event_id, try_cast(props as double) as raw_number,
           try_cast(regexp_extract(props, '[0-9]+') as double) as number from {events}""")
def _(t):
    return t.table("events").select(
        "event_id", amounts.lenient_number(F.col("props")).alias("raw_number"),
        amounts.lenient_number(F.regexp_extract("props", "[0-9]+", 0)).alias("number"))


REQUEST_ERRORS_SQL = """
    case when upper(archive_type) not in ('DAILY', 'MONTHLY', 'QUARTERLY', 'SYMBOL', 'SNAPSHOT')
           then 'unknown_grain'
         when upper(archive_type) = 'DAILY' and length(date_value) <> 8 then 'date_not_yyyymmdd'
         when upper(archive_type) = 'QUARTERLY' and length(date_value) <> 8
           then 'date_not_yyyymmdd'
         when upper(archive_type) = 'QUARTERLY'
              and substr(date_value, 5) not in ('0331', '0630', '0930', '1231')
           then 'date_not_quarter_end'
         when upper(archive_type) = 'SYMBOL' and symbol_value is null then 'symbol_missing'
         when upper(archive_type) = 'SYMBOL' and symbol_value = 'X1' then 'symbol_format'
         else '' end"""


@query("validate_requests", f"select req_id, {REQUEST_ERRORS_SQL} as errors from v_requests")
def _(t):
    errors = request_errors(F.col("archive_type"), F.col("date_value"), F.col("symbol_value"))
    return t.view("v_requests").select("req_id", F.concat_ws(",", errors).alias("errors"))


@query("partition_layout", f"""
    select req_id, case when {REQUEST_ERRORS_SQL} = '' then upper(archive_type) end as grain,
           case when {REQUEST_ERRORS_SQL} <> '' then null
             when upper(archive_type) = 'DAILY' then date_value
             when upper(archive_type) = 'MONTHLY' then substr(date_value, 1, 6)
             when upper(archive_type) = 'QUARTERLY' then substr(date_value, 1, 4) || 'Q'
               || cast(cast(substr(date_value, 5, 2) as int) // 3 as string)
             when upper(archive_type) = 'SYMBOL' then symbol_value else 'snapshot' end as period
    from v_requests""")
def _(t):
    return with_layout(t.view("v_requests"), "archive_type", "date_value", "symbol_value").select(
        "req_id", "grain", "period")


@query("storage_dates", """
    select req_id, case when date_value < '1997' then date_value
      when upper(archive_type) = 'MONTHLY' then substr(start_date, 1, 6)
      when upper(archive_type) = 'DAILY' then start_date
      when upper(archive_type) = 'QUARTERLY' then substr(start_date, 1, 4)
        || (case when substr(start_date, 5, 2) <= '03' then '0331'
                 when substr(start_date, 5, 2) <= '06' then '0630'
                 when substr(start_date, 5, 2) <= '09' then '0930' else '1231' end)
      end as storage_date
    from (select *, date_value as start_date from v_requests) x""")
def _(t):
    asked = t.view("v_requests").withColumns({
        "trade_date": F.when(F.col("date_value") < "1997", F.col("date_value")),
        "start_date": F.col("date_value")})
    value = dates.storage_date(asked.columns, F.col("archive_type"))
    return asked.select("req_id", value.alias("storage_date"))


@query("signed_rowsum", """
    select order_key, round(case when part_o is null and part_f is null and disc is null then null
      else coalesce(part_o, 0) + coalesce(part_f, 0) - coalesce(disc, 0) end, 4) as total
    from v_recon""")
def _(t):
    parts = [(F.col("part_o"), False), (F.col("part_f"), False), (F.col("disc"), True)]
    return t.view("v_recon").select("order_key", F.round(amounts.signed_row_sum(parts), 4)
                                    .alias("total"))


@query("security_lookup", f"""
    select r.symbol, r.code, r.trade_date, s.ts_code, s.list_status, s.list_date, s.delist_date
    from v_daily_raw r left join v_security s on s.symbol = ({CODE_SQL.format(c='r.code')})""")
def _(t):
    rows = t.view("v_daily_raw").select("symbol", "code", "trade_date")
    return lookup.add_security(rows, t.view("v_security"), "code")


@query("code_remap", """
    select s.ts_code, s.list_status, case when m.new_code is null then s.ts_code
      else m.new_code || substr(s.ts_code, 7) end as new_ts_code
    from v_security s left join v_codemap m on m.old_code = s.symbol""")
def _(t):
    mapped = lookup.remap_code(t.view("v_security"), t.view("v_codemap"), "ts_code", "new_ts_code")
    return mapped.select("ts_code", "list_status", "new_ts_code")


@query("code_remap_repeated", """
    select s.ts_code, case when m.new_code is null then s.ts_code
      else greatest(m.new_code, reverse(m.new_code)) || substr(s.ts_code, 7) end as new_ts_code
    from v_security s left join v_codemap m on m.old_code = s.symbol""")
def _(t):
    """An old code with several new ones: one row per row, the largest new code."""
    twice = t.view("v_codemap").select("old_code", "new_code")
    twice = twice.union(twice.select("old_code", F.reverse("new_code")))
    return lookup.remap_code(t.view("v_security"), twice, "ts_code", "new_ts_code").select("ts_code", "new_ts_code")


@query("master_remapped", """
    select coalesce(m.new_code || substr(s.ts_code, 7), s.ts_code) as ts_code,
           coalesce(m.new_code, s.symbol) as symbol, s.list_status, s.list_date, s.delist_date
    from v_security s left join v_codemap m on m.old_code = s.symbol""")
def _(t):
    return lookup.remapped_master(t.view("v_security"), t.view("v_codemap"))


@query("semi_limit_symbols", """
    select ts_code, trade_date, high from v_daily where ts_code in (
      select ts_code from (select distinct ts_code from v_daily) x order by ts_code limit 25)""")
def _(t):
    return filters.first_entities(t.view("v_daily"), "ts_code", 25).select(
        "ts_code", "trade_date", "high")


@query("gap_detection", """
    select r.request_id, cast(g.d as string) as day
    from (select request_id, symbol,
                 unnest(generate_series(start_day, end_day, interval 1 day)) as ts
          from v_ranges) r0
    join v_ranges r on r.request_id = r0.request_id
    cross join lateral (select cast(r0.ts as date) as d) g
    left join (select distinct symbol, trade_date from v_daily_raw) q
      on q.symbol = r0.symbol
     and q.trade_date = year(g.d) * 10000 + month(g.d) * 100 + day(g.d)
    where q.symbol is null""")
def _(t):
    days = natural_days(t.view("v_ranges")).select(
        "request_id", "symbol", "day", dates.compact_int(F.col("day")).alias("trade_date"))
    landed = t.view("v_daily_raw").select("symbol", "trade_date")
    return rows_without_key(days, landed, ["symbol", "trade_date"]).select(
        "request_id", F.col("day").cast("string").alias("day"))


@query("sampled_entities", """
    select ts_code, trade_date, high from v_daily where ts_code in (
      select ts_code from (select distinct ts_code from v_daily) x
      order by md5(ts_code || ':7'), ts_code limit 5)""")
def _(t):
    sample = filters.sampled_entities(t.view("v_daily"), "ts_code", 5, seed=7)
    return sample.select("ts_code", "trade_date", "high")


@query("listed_codes", """
    select substr(ts_code, 8, 2) || substr(ts_code, 1, 6) as code, 'listed' as kind
    from v_security where list_status = 'L'
    union all select substr(ts_code, 8, 2) || substr(ts_code, 1, 6), 'delisted'
    from v_security where list_status = 'D'
    union all select ts_code, 'vendor' from v_security
    union all select substr(ts_code, 1, 6), 'digits' from v_security""")
def _(t):
    master = t.view("v_security")
    parts = [entity_spine(master, "exchange_first", C.LISTED).withColumn("kind", F.lit("listed")),
             entity_spine(master, "exchange_first", C.DELISTED).withColumn(
                 "kind", F.lit("delisted")),
             entity_spine(master, "vendor").withColumn("kind", F.lit("vendor")),
             entity_spine(master, "digits").withColumn("kind", F.lit("digits"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("preview_top", """
    select ts_code, trade_date, high from v_daily
    order by high desc, ts_code, trade_date limit 10""")
def _(t):
    return t.view("v_daily").orderBy(F.desc("high"), "ts_code", "trade_date").limit(10).select(
        "ts_code", "trade_date", "high")


@query("instruments", f"""
    select upper({FEED_CODE_SQL.format(c='ts_code')}) as symbol,
           {ISO_SQL.format(c='min(trade_date)')} as start_datetime,
           {ISO_SQL.format(c='max(trade_date)')} as end_datetime
    from v_daily group by ts_code""")
def _(t):
    return measures.instruments(_dated(t))


def _dated(t):
    return t.view("v_daily").select(codes.to_feed_code(F.col("ts_code")).alias("symbol"),
                                    dates.parse_compact(F.col("trade_date")).alias("date"))


@query("calendar", f"select distinct {ISO_SQL.format(c='trade_date')} as date from v_daily")
def _(t):
    return measures.calendar_days(_dated(t))


@query("entity_count", "select count(distinct ts_code) as n_entities from v_daily")
def _(t):
    return measures.entity_count(t.view("v_daily"), "ts_code")


@query("open_days", "select cal_date, is_open from v_calendar where is_open = 1 "
                    "and cal_date between '19970101' and '19981231'")
def _(t):
    return filters.open_days(t.view("v_calendar"), "19970101", "19981231")
