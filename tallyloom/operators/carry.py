"""Values carried along sorted rows, from one row to the next and from one range to the next.

The rows are range-partitioned on (keys, order) and sorted, in one shuffle. A task reads its range once,
an Arrow batch at a time, and remembers one row: the last values of the entity it is in. So neither the whole
frame nor an entity that holds half of the rows is ever in one task or in memory.

Only the first entity of a range can have begun in an earlier one. Each range therefore reports two rows: its
first entity, and its last one with the values it leaves behind. From these, two per range, follows what
each range starts with; that is filled into the rows of its first entity, and no other row waits for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import as_table

ROW, HEAD, TAIL = 0, 1, 2


def in_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Sorted ranges of (keys, order), as many as the data are large for."""
    by = [*[F.col(f"`{k}`").asc() for k in keys], *order]
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def _carrier(keys: list[str], filled: list[str]):
    """Fills batches of one range; runs in tasks and needs nothing of this package there."""
    row, head, tail = ROW, HEAD, TAIL

    def carry(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        place = TaskContext.get().partitionId()
        held = None  # the last row: its keys, and per filled column the value it leaves behind
        in_first = True  # still in the first entity of this range

        def marks(names, columns, count, kind, first):
            named = dict(zip(names, columns))
            named["_range"] = pa.array(np.full(count, place, np.int32))
            named["_kind"] = pa.array(np.full(count, kind, np.int8))
            named["_first"] = pa.array(first)
            return pa.RecordBatch.from_arrays(list(named.values()), names=list(named))

        def report(like, kind, first):
            """One row with the keys and values of the row held, all else null."""
            columns = [held[n] if n in held else pa.nulls(1, f.type) for n, f in zip(like.names, like)]
            return marks(like.names, columns, 1, kind, np.array([first]))

        schema = None
        for batch in batches:
            if not batch.num_rows:
                continue
            count = batch.num_rows
            named = dict(zip(batch.schema.names, batch.columns))
            schema = schema or batch.schema
            # Where an entity begins: a key differs from the row before, nulls being equal.
            begins = np.zeros(count, bool)
            begins[0] = held is None
            for k in keys:
                joined = pa.concat_arrays([held[k] if held else named[k].slice(0, 1), named[k]])
                here, before = joined.slice(1), joined.slice(0, count)
                differ = pc.fill_null(pc.not_equal(here, before), False)
                begins |= pc.or_(differ, pc.xor(pc.is_null(here), pc.is_null(before))).to_numpy(zero_copy_only=False)
            opening = held is None
            if opening:
                begins[0] = True
            start = np.maximum.accumulate(np.where(begins, np.arange(count), -1))
            later = np.flatnonzero(begins[1:] if opening else begins)
            until = (later[0] + (1 if opening else 0)) if len(later) else count
            first = np.arange(count) < (until if in_first else 0)
            if in_first and until < count:
                in_first = False
            out, carried = [], {}
            for name in batch.schema.names:
                column = named[name]
                if name in filled:
                    # Index 0 stands for what the row before this batch left behind.
                    old = held[name] if held else pa.nulls(1, column.type)
                    there = pc.is_valid(column).to_numpy(zero_copy_only=False)
                    last = np.maximum.accumulate(np.where(there, np.arange(1, count + 1), 0))
                    fits = last > start  # found within the entity; 0 fits only where it began before this batch
                    chosen = pa.array(last, mask=~fits)
                    column = pa.concat_arrays([old, column]).take(chosen)
                    carried[name] = column.slice(count - 1, 1)
                out.append(column)
            if opening:
                held = {k: named[k].slice(0, 1) for k in keys}
                yield report(schema, head, True)
            yield marks(batch.schema.names, out, count, row, first)
            held = {**{k: named[k].slice(count - 1, 1) for k in keys}, **carried}
        if held is not None:
            yield report(schema, tail, in_first)

    return carry


def carry_forward(df: DataFrame, columns: Sequence[str], keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df`` with each null of ``columns`` replaced by the last value before it in its entity.

    An entity is a value of ``keys`` (nulls are a value), no keys make the whole frame one. ``keys`` and
    ``order`` together should tell rows apart. The filled ranges are written to a table, so that all that
    follows sees the same cut.
    """
    keys, columns = list(keys), list(columns)
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in df.schema], T.StructField("_range", T.IntegerType()),
                           T.StructField("_kind", T.ByteType()), T.StructField("_first", T.BooleanType())])
    ranges = as_table(in_order(df, keys, order).mapInArrow(_carrier(keys, columns), schema), "carried-ranges")
    # Two rows per range: what an entity has here is at most twice the number of ranges.
    before = Window.partitionBy(F.struct(F.lit(0).alias("_all"), *[f"`{k}`" for k in keys])).orderBy(
        "_range", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    left = {c: F.last(f"`{c}`", ignorenulls=True).over(before) for c in columns}
    reports = ranges.where(F.col("_kind") != ROW).select(
        "_kind", F.col("_range").alias("_at"), *[left[c].alias(f"_v_{i}") for i, c in enumerate(columns)])
    starts = as_table(reports.where(F.col("_kind") == HEAD).drop("_kind"), "range-starts")
    rows = ranges.where(F.col("_kind") == ROW)
    # One row per range, as many as one shuffle has tasks.
    met = rows.join(F.broadcast(starts), (F.col("_range") == F.col("_at")) & F.col("_first"), "left")
    filled = {c: F.coalesce(F.col(f"`{c}`"), F.col(f"_v_{i}")) for i, c in enumerate(columns)}
    return met.select(*[filled[c].alias(c) if c in filled else F.col(f"`{c}`") for c in df.columns])
