"""Joins against other sources, the security master and code maps.

No side is broadcast by hint. Spark broadcasts a side whose size it has checked against
``spark.sql.autoBroadcastJoinThreshold``, from statistics or from the finished shuffle, and
sort-merges beyond it, splitting hot keys at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.codes import code_digits, code_suffix
from tallyloom.operators.keyed import key_matches, per_key, tagged


def left_fold(base: DataFrame, others: Mapping[str, DataFrame],
              keys: Sequence[str] = ("ts_code", "trade_date"),
              clash: str = "drop") -> DataFrame:
    """Joins each source to the first by key, left.

    A column the result already has keeps its first value (``clash="drop"``) or comes in
    under ``<source>_<column>`` (``clash="prefix"``).
    """
    result = base
    for name, other in others.items():
        repeated = [c for c in other.columns if c in result.columns and c not in keys]
        if clash == "prefix":
            other = other.withColumnsRenamed({c: f"{name}_{c}" for c in repeated})
        else:
            other = other.drop(*repeated)
        result = result.join(other, list(keys), "left")
    return result


MASTER_FIELDS = ("ts_code", "list_status", "list_date", "delist_date")


def master_by_code(master: DataFrame) -> DataFrame:
    """One master row per normalised symbol: the latest listing, then the largest row."""
    row = F.struct("list_date", *[F.col(c) for c in MASTER_FIELDS if c != "list_date"])
    best = per_key(master.withColumn("_code", code_digits(F.col("symbol"))),
                   ["_code"], F.max(row).alias("_m"))
    return best.where(F.col("_code").isNotNull()).select(
        "_code", *[F.col(f"_m.{c}").alias(c) for c in MASTER_FIELDS])


def add_security(df: DataFrame, master: DataFrame, source: str,
                 target: str = "ts_code") -> DataFrame:
    """Adds code, status and listing dates; no match gives null."""
    looked_up = master_by_code(master).withColumnRenamed("ts_code", target)
    added = [target, "list_status", "list_date", "delist_date"]
    kept = [c for c in df.columns if c not in added or c == source]
    rows = df.withColumn("_code", code_digits(F.col(source)))
    rows = rows.select("_code", *[c for c in kept if c not in added])
    joined = rows.join(tagged(looked_up, ["_code"], rows), key_matches(["_code"]), "left")
    return joined.select(*[c for c in kept if c not in added], *added)


def remap_code(df: DataFrame, code_map: DataFrame, source: str,
               target: str | None = None) -> DataFrame:
    """New code by digits, ``.EX`` kept; an unmapped or null code stays as it is.

    One row per row: of several new codes for one old code the largest is taken.
    """
    target = target or source
    old = F.col(source)
    # A split code keeps its exchange; the digits before the dot are normalised like the rest.
    head = F.when(old.contains("."), code_digits(F.split_part(old, F.lit("."), F.lit(1))))
    rows = df.withColumn("_code", F.coalesce(head, code_digits(old)))
    mapping = code_map.where("old_code is not null").groupBy(F.col("old_code").alias("_code")).agg(F.max("new_code").alias("_new"))
    joined = rows.join(tagged(mapping, ["_code"], rows), key_matches(["_code"]), "left")
    mapped = F.concat(F.col("_new"),
                      F.when(old.contains("."), F.concat(F.lit("."), code_suffix(old)))
                      .otherwise(F.lit("")))
    return joined.withColumn(target, F.coalesce(mapped, old)).drop("_code", "_new", "_key_hash", "_key")


def remapped_master(master: DataFrame, code_map: DataFrame) -> DataFrame:
    """Symbol and code remapped, five columns kept."""
    both = remap_code(remap_code(master, code_map, "symbol"), code_map, "ts_code")
    return both.select("ts_code", "symbol", "list_status", "list_date", "delist_date")


def mapped_name(c: Column, names: Mapping[str, str]) -> Column:
    """Dictionary lookup of a small fixed mapping; other values stay."""
    if not names:
        return c
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])
    return F.coalesce(F.try_element_at(table, c), c)
