"""What changed between versions of a partitioned table, row by row.

Only buckets whose digests differ are read. Rows that both versions have, equal in all columns and as often,
cancel out in one aggregate that is combined before the shuffle; what is left is the change.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.keyed import key_matches, tagged
from tallyloom.session import as_table
from tallyloom.sinks.partitions import PartitionStore, row_mark

CHANGES = ("insert", "update_before", "update_after", "delete")


def _difference(store: PartitionStore, first: int, second: int) -> DataFrame:
    """Rows that the versions have not equally often, with ``n_removed`` and ``n_added``."""
    buckets = as_table(store.changed_buckets(first, second), "changed-buckets")
    after = store.rows_in(second, buckets).withColumns({"_before": F.lit(0), "_after": F.lit(1)})
    sides = [after]
    if first >= 0:
        before = store.rows_in(first, buckets)
        sides.append(before.withColumns({"_before": F.lit(1), "_after": F.lit(0)}))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    columns = [c for c in both.columns if c not in ("_before", "_after")]
    counted = both.groupBy(*[f"`{c}`" for c in columns]).agg(
        F.sum("_before").alias("_before"), F.sum("_after").alias("_after"))
    return counted.where("_before <> _after").select(
        *[f"`{c}`" for c in columns], F.greatest(F.col("_before") - F.col("_after"), F.lit(0)).alias("n_removed"),
        F.greatest(F.col("_after") - F.col("_before"), F.lit(0)).alias("n_added"))


def _per_key(store: PartitionStore, difference: DataFrame) -> DataFrame:
    return difference.groupBy(*store.keys).agg(
        F.sum("n_removed").alias("_removed"), F.sum("n_added").alias("_added"))


def digest_diff(store: PartitionStore, first: int, second: int) -> DataFrame:
    """K8: the keys whose rows differ between two versions, as ``insert``, ``update`` or ``delete``."""
    kind = (F.when(F.col("_removed") == 0, "insert").when(F.col("_added") == 0, "delete").otherwise("update"))
    return _per_key(store, _difference(store, first, second)).select(*store.keys, kind.alias("change"))


def change_feed(store: PartitionStore, first: int, second: int) -> DataFrame:
    """Every row that a commit after ``first``, up to ``second``, took away or brought.

    ``version`` is the commit, ``change`` one of CHANGES. One row replaced by one of the same key is an
    update, also from one partition to another; where a key has several rows they are deleted and
    inserted. ``first`` may be -1, the empty table.
    """
    parts = []
    for number in range(first + 1, second + 1):
        found = as_table(_difference(store, number - 1, number), "row-changes")
        keys = _per_key(store, found).where("_removed = 1 and _added = 1").select(*store.keys, F.lit(True).alias("_update"))
        met = found.join(tagged(keys, store.keys, found), key_matches(store.keys), "left")
        sides = F.filter(F.array(F.struct(F.lit("removed").alias("side"), F.col("n_removed").alias("n")),
                                 F.struct(F.lit("added").alias("side"), F.col("n_added").alias("n"))), lambda s: s["n"] > 0)
        each = met.withColumn("_side", F.explode(sides)).withColumn(
            "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_side.n"))))
        taken = F.col("_side.side") == "removed"
        change = (F.when(F.col("_update") & taken, "update_before").when(F.col("_update"), "update_after")
                  .when(taken, "delete").otherwise("insert"))
        parts.append(each.select(*[f"`{c}`" for c in found.columns if c not in ("n_removed", "n_added")],
                                 F.lit(number).cast("long").alias("version"), change.alias("change")))
    if not parts:
        raise ValueError(f"no commit lies after {first} and up to {second}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def validity(store: PartitionStore, upto: int | None = None, first: int = -1) -> DataFrame:
    """Every row with the versions it is part of: from ``valid_from`` on, before ``valid_to`` (null: still).

    Built from the change feed. What one row gathers is a number per version that took it away or brought
    it, never rows. Repeated rows have an interval for each copy.
    """
    upto = store.log.head() if upto is None else upto
    feed = change_feed(store, first, upto)
    columns = [c for c in feed.columns if c not in ("version", "change")]
    came = F.col("change").isin("insert", "update_after")
    marked = feed.select(*[f"`{c}`" for c in columns], "version", came.alias("_came"), row_mark(columns).alias("_mark"))
    rows = marked.groupBy("_mark", *[f"`{c}`" for c in columns]).agg(
        F.array_sort(F.collect_list(F.when(F.col("_came"), F.col("version")))).alias("_from"),
        F.array_sort(F.collect_list(F.when(~F.col("_came"), F.col("version")))).alias("_to"))
    spans = F.arrays_zip(F.col("_from"), F.col("_to"))
    return rows.withColumn("_span", F.explode(spans)).select(
        *[f"`{c}`" for c in columns], F.col("_span._from").alias("valid_from"), F.col("_span._to").alias("valid_to"))


def as_of(history: DataFrame, number: int) -> DataFrame:
    """The rows of a version out of ``validity``."""
    there = (F.col("valid_from") <= number) & (F.col("valid_to").isNull() | (F.col("valid_to") > number))
    return history.where(there).drop("valid_from", "valid_to")
