"""Request templates: parameters nested to any depth, expanded to one set of parameters per block.

A template is a JSON text. Its maps are walked level by level as VARIANT values; a list at any depth, and a
placeholder that stands for a list, gives one block per entry. All lists of a template run side by side,
so they must be equally long. From the entries of each block the nested parameters are put together
again, from the deepest map up. The number of passes is the depth of the deepest template; all of them
work on all templates at once.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.backfill import CODE_PLACEHOLDERS, DATE_PLACEHOLDERS, MONTHS, TODAY, expand
from tallyloom.session import as_table
from tallyloom.sources.scan import empty

RANGE_KEYS = ("start_date", "end_date")  # what a month range becomes, in place of its own key
MOST_DEPTH = 100
LEAF = "req_id string, path array<string>, json string"


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    inside = F.to_json(F.array(text))
    return F.substring(inside, F.lit(2), F.length(inside) - 2)


def walked(templates: DataFrame) -> DataFrame:
    """LEAF rows of (req_id, params): every value that is no map with entries, under its keys.

    A null or empty list as the whole template is an empty map; text that is no JSON, or no map, raises.
    """
    whole = F.to_json(F.try_parse_json(F.coalesce("params", F.lit("{}"))))
    # A generator, not a projection: each text is parsed once, however often its result is used.
    level = templates.select("req_id", F.array().cast("array<string>").alias("path"), "params",
                             F.explode(F.array(whole)).alias("json"))
    wrong = F.raise_error(F.concat(F.lit("a template is a map, not "), F.coalesce("params", F.lit("null"))))
    level = level.select("req_id", "path", F.when(F.col("json") == "[]", "{}").when(
        F.col("json").startswith("{"), F.col("json")).otherwise(wrong.cast("string")).alias("json"))
    # JSON made from a variant has one form, so its first letter tells a map from a list or a value.
    inner = F.col("json").startswith("{") & (F.col("json") != "{}")
    parts = []
    for depth in range(MOST_DEPTH):
        if depth:
            parts.append(level.where(~inner))
        below = level.where(inner).select("req_id", "path", F.explode(
            F.variant_get(F.parse_json("json"), "$", "map<string,variant>")).alias("key", "value"))
        level = as_table(below.select("req_id", F.concat("path", F.array("key")).alias("path"),
                                      F.to_json("value").alias("json")), "template-level")
        if not level.take(1):
            break
    else:
        raise ValueError(f"templates are nested deeper than {MOST_DEPTH}")
    return as_table(reduce(DataFrame.unionByName, parts), "template-leaves") if parts else empty(
        templates.sparkSession, LEAF)


def _entries(requests: DataFrame, leaves: DataFrame, calendar: DataFrame, master: DataFrame | None,
             clip_quarters: bool) -> tuple[DataFrame, DataFrame]:
    """(req_id, path, block_index, json) of all lists, and the LEAF rows that are the same in every block."""
    named = (*DATE_PLACEHOLDERS, *(CODE_PLACEHOLDERS if master is not None else ()))
    text = F.when(F.col("json").isin(*[json.dumps(word) for word in named]), F.expr("substring(json, 2, length(json) - 2)"))
    marked = leaves.withColumn("placeholder", text)
    asked = marked.where("placeholder is not null").drop("json").join(requests.drop("params"), "req_id")
    found = as_table(expand(asked.withColumns({"dataset": F.col("req_id"), "grain": F.lit(None).cast("string")}),
                            calendar, clip_quarters, master), "template-entries")
    one = found.where(F.col("placeholder") == TODAY).select("req_id", "path", quoted(F.col("param_start")).alias("json"))
    many = found.where(F.col("placeholder") != TODAY)
    if master is not None:
        # Codes in their own order, numbered like days; a list is as long as the security master.
        codes = many.where(F.col("placeholder").isin(*CODE_PLACEHOLDERS)).groupBy("req_id", "path").agg(
            F.array_sort(F.collect_list("param_start")).alias("codes"))
        numbered = codes.select("req_id", "path", F.posexplode("codes").alias("block_index", "code"))
        many = many.where(~F.col("placeholder").isin(*CODE_PLACEHOLDERS)).select(
            "req_id", "path", "placeholder", "block_index", "param_start", "param_end").unionByName(
            numbered.select("req_id", "path", F.lit("").alias("placeholder"), "block_index",
                            F.col("code").alias("param_start"), F.col("code").alias("param_end")))
    parent = F.slice("path", 1, F.size("path") - 1)
    ends = F.array(*[F.struct(F.concat(parent, F.array(F.lit(key))).alias("path"), quoted(F.col(c)).alias("json"))
                     for key, c in zip(RANGE_KEYS, ("param_start", "param_end"))])
    single = F.array(F.struct("path", quoted(F.col("param_start")).alias("json")))
    spans = F.when(F.col("placeholder") == MONTHS, ends).otherwise(single)
    days = many.select("req_id", "block_index", F.explode(spans).alias("e")).select(
        "req_id", "e.path", "block_index", "e.json")
    listed = marked.where("placeholder is null and json like '[%' and json <> '[]'").select(
        "req_id", "path", F.posexplode(F.variant_get(F.parse_json("json"), "$", "array<variant>")).alias("block_index", "v"))
    lists = days.unionByName(listed.select("req_id", "path", "block_index", F.to_json("v").alias("json")))
    plain = marked.where("placeholder is null and (json not like '[%' or json = '[]')").select("req_id", "path", "json")
    # A placeholder whose range has no entry is an empty list.
    none = asked.select("req_id", "path").join(found.select("req_id", "path"), ["req_id", "path"], "left_anti").select(
        "req_id", "path", F.lit("[]").alias("json"))
    return as_table(lists, "template-lists"), as_table(plain.unionByName(one).unionByName(none), "template-values")


def _nested(cells: DataFrame) -> DataFrame:
    """(req_id, block_index, params) from (req_id, block_index, path, json), the deepest maps first, keys in order."""
    deepest = cells.agg(F.max(F.size("path"))).first()[0] or 0
    built = None
    for depth in range(deepest, 0, -1):
        # Maps built one level further down are the only other values at this depth.
        here = cells.where(F.size("path") == depth)
        here = here if built is None else here.unionByName(built)
        entry = F.struct(F.element_at("path", -1).alias("key"), F.col("json"))
        maps = here.groupBy("req_id", "block_index", F.slice("path", 1, depth - 1).alias("path")).agg(
            F.array_sort(F.collect_list(entry)).alias("entries"))
        text = F.array_join(F.transform("entries", lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["json"])), ",")
        built = maps.select("req_id", "block_index", "path", F.concat(F.lit("{"), text, F.lit("}")).alias("json"))
    return (cells if built is None else built).select("req_id", "block_index", F.col("json").alias("params"))


def blocks_of(requests: DataFrame, calendar: DataFrame, master: DataFrame | None = None,
              clip_quarters: bool = False) -> DataFrame:
    """(req_id, block_index, n_blocks, params, error), one row per block.

    Requests carry ``req_id, params, start_date, end_date, lookback, multiplier, truncate``. Unknown
    placeholders stay as they are, one without an entry in its range is an empty list. A month range gives
    the keys ``start_date`` and ``end_date`` in place of its own, which win over others of that name.
    A request whose lists differ in length has one row with the ``error`` and no parameters. Date lists
    are newest first, code lists in order of the codes.
    """
    requests = requests.withColumn("req_id", F.col("req_id").cast("string"))
    lists, values = _entries(requests, walked(requests.select("req_id", "params")), calendar, master, clip_quarters)
    lengths = lists.groupBy("req_id", "path").agg(F.count("*").alias("n")).groupBy("req_id").agg(
        F.min("n").alias("least"), F.max("n").alias("n_blocks"))
    sized = requests.select("req_id").join(lengths, "req_id", "left").select(
        "req_id", F.coalesce("n_blocks", F.lit(1)).cast("int").alias("n_blocks"),
        F.when(F.col("least") < F.col("n_blocks"), "list_lengths_differ").alias("error"))
    good = sized.where("error is null").select("req_id", "n_blocks", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block_index"))
    cells = lists.join(sized.where("error is null").select("req_id"), "req_id", "left_semi").withColumn("rank", F.lit(1)).unionByName(
        values.join(good.select("req_id", "block_index"), "req_id").withColumn("rank", F.lit(0)))
    once = cells.groupBy("req_id", "block_index", "path").agg(F.max_by("json", "rank").alias("json"))
    built = _nested(as_table(once, "template-cells"))
    done = good.join(built, ["req_id", "block_index"], "left").select(
        "req_id", "block_index", "n_blocks", F.coalesce("params", F.lit("{}")).alias("params"), F.lit(None).cast("string").alias("error"))
    return done.unionByName(sized.where("error is not null").select(
        "req_id", F.lit(None).cast("int").alias("block_index"), F.lit(None).cast("int").alias("n_blocks"),
        F.lit(None).cast("string").alias("params"), "error"))
