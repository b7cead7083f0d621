"""Per-key statistics and key-set joins that stay even when one key holds much of the data.

A window over a key moves every row of that key to one task. These helpers use two narrower
steps: a group-by, which Spark combines before the shuffle, so a hot key costs one row per map
task, and then a join of the rows with the few keys that matter.

The join compares a hash of the key and the key as one struct, both of which are never null. Three
things follow. Spark cannot reuse the partitioning of the group-by, so both join sides come straight
from an exchange, the shape in which adaptive execution splits a hot partition
(``SortMergeJoin(skew=true)`` in the final plan). It infers no null filter for one side only, so where
the rows come out of a shuffle, both sides read that shuffle instead of computing it twice. And rows
are sorted by the hash first, which compares fast whatever the key's types.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keys_present(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def per_key(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """One row per key with the given aggregates (G1-G3); null keys group together."""
    return df.groupBy(*keys).agg(*aggs)


def tagged(keyset: DataFrame, keys: Sequence[str], like: DataFrame) -> DataFrame:
    """The key columns of a key set as a hash and a struct, ready to be joined with ``like``.

    The hash depends on the type, so the keys take the types they have in the other frame.
    """
    rest = [c for c in keyset.columns if c not in keys]
    typed = keyset.select(*[F.col(k).cast(like.schema[k].dataType).alias(k) for k in keys], *rest)
    return typed.select(F.xxhash64(*keys).alias("_key_hash"), F.struct(*keys).alias("_key"), *rest)


def key_matches(keys: Sequence[str]) -> Column:
    """Join condition of rows with a tagged key set; nulls in the key compare as equal."""
    return (F.xxhash64(*keys) == F.col("_key_hash")) & (F.struct(*keys) == F.col("_key"))


def rows_with_key(df: DataFrame, keyset: DataFrame, keys: Sequence[str],
                  null_safe: bool = False) -> DataFrame:
    """Rows whose key is in the key set."""
    on = key_matches(keys)
    return df.join(tagged(keyset, keys, df), on if null_safe else on & keys_present(keys), "left_semi")


def rows_without_key(df: DataFrame, keyset: DataFrame, keys: Sequence[str],
                     extra: Column | None = None) -> DataFrame:
    """Rows whose key is not in the key set, or that miss the extra condition.

    Rows with a null key part always stay.
    """
    on = key_matches(keys) & keys_present(keys)
    return df.join(tagged(keyset, keys, df), on if extra is None else on & extra, "left_anti")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key: the smallest by the order columns, then by the row's own values.

    A bounded aggregate (one candidate row per key and map task), not a ranking window.
    Order columns that sort descending are passed negated or through ``descending``.
    """
    rest = [c for c in df.columns if c not in keys]
    candidate = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(F.min(candidate).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.`{c}`").alias(c)
                         for c in df.columns])


def descending(number: Column) -> list[Column]:
    """Sort keys for a numeric or date column, newest first and nulls last, under ``min``."""
    return [number.isNull().cast("int"), -number]
