"""Queries on request templates and on collecting what they ask for."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.jobs import orders
from catalog.registry import query
from tallyloom.functions.dates import compact_text
from tallyloom.plans.backfill import CODE_WORDS, expand
from tallyloom.plans.board import Board
from tallyloom.plans.collect import collect_blocks
from tallyloom.plans.templates import blocks_of
from tallyloom.session import scratch_path
from tallyloom.sinks import runlog
from tallyloom.sinks.partitions import PartitionStore

TEMPLATE = {
    0: '{"code":"%s","range":{"day":"<NATURAL_DATE>","kind":"daily"},"limit":100}',
    1: '{"b":{"c":{"d":["x","%s"]},"e":[1,{"f":true}]},"a":null}',
    2: '{"codes":["%s"],"deep":{"er":["y","z"]}}',
    3: '{"code":"%s","other":"<NO_SUCH_WORD>","none":{}}',
}


@query("template_nested", """
    select request_id as req_id, cast(i as int) as block_index, n as n_blocks,
           '{"code":"' || symbol || '","limit":100,"range":{"day":"' || strftime(end_day - cast(i as int), '%Y%m%d') || '","kind":"daily"}}' as params,
           cast(null as varchar) as error
    from (select *, cast(end_day - start_day + 1 as int) as n, unnest(range(0, end_day - start_day + 1)) as i
          from v_ranges where yq % 4 = 0) a
    union all
    select request_id, 0, 2, '{"a":null,"b":{"c":{"d":"x"},"e":1}}', null from v_ranges where yq % 4 = 1
    union all
    select request_id, 1, 2, '{"a":null,"b":{"c":{"d":"' || symbol || '"},"e":{"f":true}}}', null from v_ranges where yq % 4 = 1
    union all
    select request_id, null, null, null, 'list_lengths_differ' from v_ranges where yq % 4 = 2
    union all
    select request_id, 0, 1, '{"code":"' || symbol || '","none":{},"other":"<NO_SUCH_WORD>"}', null from v_ranges where yq % 4 = 3""")
def _(t):
    """Templates with lists in maps, lists of different lengths, unknown words, and a block per day."""
    kind = F.col("yq") % 4
    params = F.coalesce(*[F.when(kind == k, F.format_string(text, "symbol")) for k, text in TEMPLATE.items()])
    requests = t.view("v_ranges").select(
        F.col("request_id").alias("req_id"), params.alias("params"), compact_text(F.col("start_day")).alias("start_date"),
        compact_text(F.col("end_day")).alias("end_date"), F.lit(0).alias("lookback"), F.lit(1.0).alias("multiplier"),
        F.lit(False).alias("truncate"))
    return blocks_of(requests, t.view("v_calendar"))


@query("backfill_codes", f"""
    select '{CODE_WORDS[0]}' as placeholder, substr(ts_code, 8, 2) || substr(ts_code, 1, 6) as code from v_security where list_status = 'L'
    union all
    select '{CODE_WORDS[1]}', substr(ts_code, 8, 2) || substr(ts_code, 1, 6) from v_security where list_status = 'D'
    union all select '{CODE_WORDS[2]}', ts_code from v_security
    union all select '{CODE_WORDS[3]}', substr(ts_code, 1, 6) from v_security""")
def _(t):
    """Code lists under the words that existing requests use."""
    requests = t.spark.createDataFrame(
        [(word, None, word, "19950101", "19981231", 1, 1.0, False) for word in CODE_WORDS],
        "dataset string, grain string, placeholder string, start_date string, end_date string, lookback int, "
        "multiplier double, truncate boolean")
    blocks = expand(requests, t.view("v_calendar"), master=t.view("v_security"))
    return blocks.select("placeholder", F.col("param_start").alias("code"))


@query("collect_plan", """
    select o_orderstatus as dataset, period, 'done' as what, count(*) as rows, cast(case o_orderstatus when 'O' then 2 else 1 end as bigint) as attempts,
           'SUCCESS' as execution_status
    from (select *, strftime(o_orderdate, '%Y') as period from {orders} where o_orderstatus in ('F', 'O')) a group by 1, 2
    union all
    select 'F', '1990', 'failed', 0, 2, 'FAILED'
    union all
    select 'open', cast(count(*) as varchar), null, null, null, null from {orders} where o_orderstatus = 'none'""")
def _(t):
    """Two datasets by year. In the first run one source is down; the second takes up what is open, and a third
    finds nothing but a year without rows, which was tried often enough."""
    root = scratch_path(t.spark, "collect")
    rows = orders(t).withColumn("period", F.substring("order_day", 1, 4))
    years = rows.where("o_orderstatus in ('F', 'O')").select(F.col("o_orderstatus").alias("dataset"), "period").distinct()
    plan = years.unionByName(t.spark.createDataFrame([("F", "1990")], "dataset string, period string"))
    down = ["O"]

    def fetch(dataset, periods):
        if dataset in down:
            raise OSError("the source is down")
        return rows.where((F.col("o_orderstatus") == dataset) & F.col("period").isin(list(periods)))

    def store_of(dataset):
        return PartitionStore(t.spark, f"{root}/{dataset}", "period", ["o_orderkey"])

    board, log = Board(t.spark, f"{root}/board", most_attempts=2), f"{root}/runs"
    collect_blocks(plan, fetch, store_of, board, log)
    down.clear()
    collect_blocks(plan, fetch, store_of, board, log)
    collect_blocks(plan, fetch, store_of, board, log)
    last = runlog.latest_runs(t.spark.read.parquet(log)).select(
        F.col("data_type").alias("dataset"), F.substring_index("task_id", ".", -1).alias("period"), "execution_status")
    states = board.states().select("dataset", "period", "what", "rows", "attempts").join(last, ["dataset", "period"])
    left = board.open(plan).agg(F.count("*").alias("n")).select(
        F.lit("open").alias("dataset"), F.col("n").cast("string").alias("period"))
    return states.unionByName(left, allowMissingColumns=True)
