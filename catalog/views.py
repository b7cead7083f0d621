"""Market-data shaped inputs derived from the driver's tables, in SQL both engines read.

``{orders}`` and the like stand for base tables; ``v_*`` names are other views. A composed
statement carries the views it needs as common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# A six-digit code leaves room for a million securities; more customers share codes, so the
# master and the quotes are grouped by code and stay unique at any scale.
CODE = "lpad(cast({key} % 1000000 as string), 6, '0')"
C_CODE, O_CODE = CODE.replace("{key}", "c_custkey"), CODE.replace("{key}", "o_custkey")
DAY = "cast(year({d}) * 10000 + month({d}) * 100 + day({d}) as int)"
O_DAY = DAY.replace("{d}", "o_orderdate")
QUARTER_END = ("cast(year(o_orderdate) * 10000 + (case quarter(o_orderdate) when 1 then 331 "
               "when 2 then 630 when 3 then 930 else 1231 end) as int)")

VIEWS = {
    "v_security": f"""
        select symbol,
               symbol || '.' || (case nation % 3 when 0 then 'SH' when 1 then 'SZ' else 'BJ' end)
                 as ts_code,
               case when segment = 'MACHINERY' then 'D' else 'L' end as list_status,
               cast(19920101 + (nation % 10) * 10000 as string) as list_date,
               case when segment = 'MACHINERY' then '19990630' end as delist_date
        from (select {C_CODE} as symbol, min(c_nationkey) as nation, min(c_mktsegment) as segment
              from {{customer}} group by 1) x""",
    "v_codemap": """
        select symbol as old_code, '92' || substr(symbol, 3, 4) as new_code
        from v_security where ts_code like '%.BJ'""",
    "v_daily_raw": f"""
        select symbol,
               case cast(symbol as int) % 4 when 0 then 'SZ' || symbol when 1 then symbol || '.SH'
                 when 2 then symbol else 'BJ' || symbol end as code,
               trade_date, min(o_totalprice) as low, max(o_totalprice) as high,
               count(*) as volume, count(case when o_orderstatus = 'F' then 1 end) as n_final,
               count(case when o_orderstatus = 'O' then 1 end) as n_open
        from (select {O_CODE} as symbol, {O_DAY} as trade_date, o_totalprice, o_orderstatus
              from {{orders}}) x
        group by symbol, trade_date""",
    "v_daily": """
        select s.ts_code, d.trade_date, d.low, d.high, d.volume, s.list_date, s.delist_date,
               d.n_final, d.n_open
        from v_daily_raw d join v_security s on d.symbol = s.symbol""",
    "v_adj": """
        select ts_code, trade_date, cast(1 + n_final as double) / 10 as factor
        from v_daily where n_final > 0""",
    "v_basic": """
        select ts_code, trade_date, high / 1000 as pe, low as low
        from v_daily where n_open > 0""",
    "v_stmt": f"""
        select case o_orderkey % 50 when 0 then null when 1 then '' when 2 then ' '
                 else {O_CODE} || '.SH' end as ts_code,
               {QUARTER_END} as end_date,
               cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1 as int) as f_ann_date,
               cast(case when o_orderkey % 37 <> 0 then {O_DAY} end as int) as ann_date,
               cast(o_orderkey % 2 as string) as update_flag,
               cast(o_orderkey % 4 as string) as comp_type,
               o_totalprice as total, o_orderkey as order_key
        from {{orders}}""",
    "v_stmt_clean": """
        select ts_code, end_date, f_ann_date as ann_date, round(sum(total), 2) as revenue,
               max(case when comp_type = '1' then total end) as profit
        from v_stmt where ts_code is not null and ts_code not in ('', ' ')
        group by ts_code, end_date, f_ann_date""",
    "v_lines": """
        select l_orderkey,
               round(sum(case when l_linestatus = 'O' then l_extendedprice end), 2) as part_o,
               round(sum(case when l_linestatus = 'F' then l_extendedprice end), 2) as part_f,
               round(sum(l_extendedprice * l_discount), 4) as disc
        from {lineitem} group by l_orderkey""",
    "v_recon": """
        select o.o_orderkey as order_key, cast(o.o_orderkey % 4 as string) as comp_type,
               l.part_o, l.part_f, l.disc,
               coalesce(l.part_o, 0) + coalesce(l.part_f, 0) - coalesce(l.disc, 0)
                 + (case when o.o_orderkey % 160 = 1 then 60000 else 0 end) as total_ok,
               coalesce(l.part_o, 0) + coalesce(l.part_f, 0) - coalesce(l.disc, 0)
                 + (case when o.o_orderkey % 40 = 1 then 60000 else 0 end) as total_bad
        from {orders} o left join v_lines l on o.o_orderkey = l.l_orderkey""",
    "v_income": f"""
        select o.o_orderkey as order_key, {O_DAY} as end_date,
               l.part_o as assets_impair_loss, l.part_f as credit_impa_loss,
               o.o_totalprice as total_cogs,
               case when o.o_orderkey % 2 = 0 then o.o_totalprice end as total_opcost
        from {{orders}} o left join v_lines l on o.o_orderkey = l.l_orderkey""",
    # A relationship text per part: totals, components, subtracted components, second levels and
    # lists of two, in one section per brand.
    "v_relcfg": """
        select p_brand as section, cast(p_partkey as int) as position,
               'field_' || cast(p_partkey as string) as field, p_name as report_item,
               (case p_partkey % 6 when 0 then cast(p_size as string)
                  when 1 then cast(p_size as string) || '_1'
                  when 2 then cast(p_size as string) || '_;' || cast(p_size + 1 as string) || '_1'
                  when 3 then '-' || cast(p_size as string) || '_1'
                  when 4 then cast(p_size as string) || '_1_2'
                  else cast(p_size as string) || '_1; ' || cast(p_size + 2 as string) || '_1' end)
                 as relationship
        from {part}""",
    "v_div": """
        select cast(o_custkey as string) as ts_code, cast(year(o_orderdate) as int) as end_date,
               cast(year(o_orderdate) as int) as ann_date,
               cast(o_orderdate as date) as imp_ann_date, o_orderstatus as div_proc,
               1 + cast(o_orderkey % 20 as double) / 100 as cash_div_tax, o_orderkey as order_key
        from {orders}""",
    "v_dates": """
        select o_orderkey as order_key,
               case o_orderkey % 6 when 0 then null when 1 then replace(d, '-', '') when 2 then d
                 when 3 then d || 'T00:00:00.000Z' when 4 then d || ' 00:00:00'
                 else replace(d, '-', '') || ' 00:00:00' end as date_text
        from (select o_orderkey, cast(cast(o_orderdate as date) as string) as d from {orders}) x""",
    "v_paths": """
        select o_orderkey as order_key,
               '/landing/s/m/' || (case o_orderkey % 5
                 when 0 then substr(d, 1, 6) || '/' || substr(d, 7, 2)
                 when 1 then substr(d, 1, 6)
                 when 2 then substr(d, 1, 4) || 'Q' || cast(1 + o_orderkey % 4 as string)
                 when 3 then substr(d, 1, 4) else 'snapshot' end) || '/data.parquet' as file_path
        from (select o_orderkey, replace(cast(cast(o_orderdate as date) as string), '-', '') as d
              from {orders}) x""",
    "v_requests": f"""
        select o_orderkey as req_id,
               case o_orderkey % 6 when 0 then 'DAILY' when 1 then 'monthly' when 2 then 'QUARTERLY'
                 when 3 then 'SYMBOL' when 4 then 'SNAPSHOT' else 'HOURLY' end as archive_type,
               case o_orderstatus when 'F' then cast({O_DAY} as string)
                 when 'O' then cast({QUARTER_END} as string)
                 else substr(cast({O_DAY} as string), 1, 6) end as date_value,
               case substr(o_orderpriority, 1, 1) when '1' then 'SH' || {O_CODE}
                 when '2' then {O_CODE} || '.BJ' when '3' then {O_CODE} when '4' then 'X1' end
                 as symbol_value
        from {{orders}}""",
    # One request per code and quarter, asking for the days between its first and last order.
    "v_ranges": f"""
        select symbol || ':' || cast(yq as string) as request_id, symbol, yq,
               min(d) as start_day, max(d) as end_day, count(*) as n_orders
        from (select {O_CODE} as symbol, cast(o_orderdate as date) as d,
                     cast(year(o_orderdate) * 10 + quarter(o_orderdate) as int) as yq
              from {{orders}}) x
        group by symbol, yq""",
    # Open are the days on which an order was finished.
    "v_calendar": f"""
        select cast({O_DAY} as string) as cal_date,
               max(case when o_orderstatus = 'F' then 1 else 0 end) as is_open
        from {{orders}} group by 1""",
    "v_landed": f"""
        select distinct dataset, period from (
          select 'trade:' || {O_CODE} as dataset, cast({O_DAY} as string) as period
          from {{orders}} where o_orderstatus = 'O'
          union all
          select 'month:' || {O_CODE}, substr(cast({O_DAY} as string), 1, 6)
          from {{orders}} where o_orderstatus = 'O'
          union all
          select 'quarter:' || {O_CODE},
                 substr(cast({O_DAY} as string), 1, 4) || 'Q' || cast(quarter(o_orderdate) as string)
          from {{orders}} where o_orderstatus = 'O') x""",
    "v_plan_requests": """
        select case n_orders when 1 then 'trade:' when 2 then 'month:' when 3 then 'quarter:'
                 else 'natural:' end || symbol as dataset,
               case n_orders when 1 then 'DAILY' when 2 then 'MONTHLY' when 3 then 'QUARTERLY'
                 else 'DAILY' end as grain,
               case n_orders when 1 then '<TRADE_DATE>' when 2 then '<MONTHLY_DATE_RANGE>'
                 when 3 then '<QUARTERLY_DATE>' else '<NATURAL_DATE>' end as placeholder,
               yq, replace(substr(cast(start_day as string), 1, 7), '-', '') as start_date,
               replace(cast(end_day as string), '-', '') as end_date,
               cast(2 as int) as lookback, cast(1.5 as double) as multiplier,
               yq % 2 = 0 as truncate
        from v_ranges""",
    "v_pitdates": """
        select l_orderkey, l_linenumber, cast(l_shipdate as date) as ann_date,
               cast(o_orderdate as date) as period_end
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "v_quarterly": f"""
        select {O_CODE} as ts_code, cast(year(o_orderdate) as int) as fy,
               cast(quarter(o_orderdate) as int) as q, round(sum(o_totalprice), 2) as revenue
        from {{orders}} group by 1, 2, 3""",
    "v_cum": """
        select ts_code, fy, q,
               round(sum(revenue) over (partition by ts_code, fy order by q
                     rows between unbounded preceding and current row), 2) as revenue_sc
        from v_quarterly""",
    "v_revisions": f"""
        select {O_CODE} as symbol, cast(year(o_orderdate) as int) as period_end,
               cast(o_orderkey % 2 as string) as update_flag,
               cast({O_DAY} as string) as ann_date, o_orderpriority as report_type,
               o_totalprice as amount, o_orderkey as order_key
        from {{orders}}""",
    "v_runs": """
        select 'task_' || cast(o_custkey as string) as task_id, o_orderstatus as execution_status,
               o_orderkey as data_rows, cast(o_orderdate as timestamp) as updated_at
        from {orders}""",
}

_NAME = re.compile(r"\bv_[a-z_]+\b")


def needed(sql: str) -> list[str]:
    """Views a statement uses, each after those it uses itself."""
    found: list[str] = []

    def visit(text):
        for name in _NAME.findall(text):
            if name in VIEWS and name not in found:
                visit(VIEWS[name])
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def compose(sql: str, tables: dict[str, str]) -> str:
    names = needed(sql)
    ctes = ",\n".join(f"{n} as ({VIEWS[n]})" for n in names)
    text = sql
    if ctes:
        inner = sql.strip()
        text = (f"with {ctes},\n{inner[5:]}" if inner[:5].lower() == "with "
                else f"with {ctes}\n{inner}")
    for table, target in tables.items():
        text = text.replace("{" + table + "}", target)
    return text


def oracle(sql: str) -> str:
    return compose(sql, {t: t for t in TABLES})


class Inputs:
    """Tables and views of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        paths = {t: f"parquet.`{self.sf_dir}/{t}.parquet`" for t in TABLES}
        return self.spark.sql(compose(f"select * from {name}", paths))
