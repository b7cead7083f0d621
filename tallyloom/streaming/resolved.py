"""One resolved row per key, kept up while extracts land."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.keyed import rows_without_key
from tallyloom.operators.resolve import dedupe_by_strategy
from tallyloom.session import as_table
from tallyloom.sinks.partitions import PartitionStore


def resolved_stream(rows: DataFrame, keys: Sequence[str], strategy: str, **columns: str) -> DataFrame:
    """X5 on a stream: the best row per key of all that has landed, whenever it landed.

    The state of a key is the one row that is best so far: the strategies order rows completely, so the best
    of a batch and of the state is the best of all, and every split of the input into batches ends the
    same. A late extract counts like any other. There is no watermark, as a revision may come after
    years; the state grows with the number of keys, not of rows, and is kept by the state store.
    """
    return dedupe_by_strategy(rows, list(keys), strategy, **columns)


def keep_resolved(rows: DataFrame, store: PartitionStore, strategy: str, progress: str, **columns: str) -> StreamingQuery:
    """D1, X5, 2.15: a stream of revisions into a table with one row per key of the store.

    Each batch brings the keys whose best row changed. Their partitions are read, these keys replaced, and
    saved; partitions without a change are neither read nor written. A batch that runs twice, after a
    failure, finds its rows there already and changes nothing. A key whose best row is in another
    partition than before leaves the old one. Ends when all that has landed is taken up.
    """
    best = resolved_stream(rows, store.keys, strategy, **columns)

    def upsert(batch: DataFrame, number: int) -> None:
        changed = as_table(batch, "resolved-batch")
        labels = [r["label"] for r in changed.select(F.col(f"`{store.by}`").alias("label")).distinct().collect()]
        if not labels:
            return
        if store.log.head() < 0:
            store.save(changed, info=f"batch {number}", shrink="allow")
            return
        # A key is told by the store's keys; only where the partition is no key can it lie elsewhere.
        near = store.read(labels=labels if store.by in store.keys else None)
        keys = changed.select(*[f"`{k}`" for k in store.keys])
        kept = rows_without_key(near, keys, store.keys)
        store.save(kept.unionByName(changed), info=f"batch {number}", shrink="allow", whole=store.by not in store.keys)

    return (best.writeStream.outputMode("update").foreachBatch(upsert)
            .option("checkpointLocation", progress).trigger(availableNow=True).start())
