"""What was known at a moment: each row with the last row of another table at or before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.carry import carry_forward

OWN = "_asof_"


def merged_sides(left: DataFrame, right: DataFrame, keys: Sequence[str], moment: str, known: str,
                 values: Sequence[str], strict: bool = False, per_field: bool = False) -> DataFrame:
    """Both sides as one frame, rows to be answered beside rows that answer.

    Of equal moments the answers come first (last if ``strict``), so a row sees what became known at its own
    moment. Answers of one key and moment are in the order of their values, the largest last.
    """
    keyed = [F.col(f"`{k}`").alias(f"{OWN}k{i}") for i, k in enumerate(keys)]
    asking, answering = (1, 0) if not strict else (0, 1)
    payload = [F.col(f"`{c}`").alias(c) for c in (known, *values)]
    fields = ([F.struct(F.col(f"`{known}`").alias(known), F.col(f"`{c}`").alias(c)) for c in values]
              if per_field else [F.struct(*payload)])
    given = [F.when(F.col(f"`{c}`").isNotNull(), f) for c, f in zip(values, fields)] if per_field else fields
    answers = right.where(F.col(f"`{known}`").isNotNull()).select(
        *keyed, F.col(f"`{known}`").alias(OWN + "t"), F.lit(answering).alias(OWN + "side"),
        *[g.alias(f"{OWN}v{i}") for i, g in enumerate(given)], F.struct(*payload).alias(OWN + "tie"))
    asks = left.select(*keyed, F.col(f"`{moment}`").alias(OWN + "t"), F.lit(asking).alias(OWN + "side"),
                       F.struct(*[f"`{c}`" for c in left.columns]).alias(OWN + "row"))
    return asks.unionByName(answers, allowMissingColumns=True)


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], moment: str, known: str,
              values: Sequence[str], strict: bool = False, per_field: bool = False) -> DataFrame:
    """Every left row with ``known`` and ``values`` of the last right row of its key whose ``known`` is
    at or before its ``moment`` (before it, if ``strict``); null where there is none.

    With ``per_field`` each value is the last that was not null, with its own ``<value>_known``. Both sides
    are merged in sorted ranges and the answers carried along: no join on an inequality, no window over a
    key, one shuffle, and a key with half of the rows is spread over tasks. Null keys are a key; left rows
    without a moment stay without an answer, right rows without one are not used. Column names of the left
    side must not be those of the answer.
    """
    values = list(values)
    names = [n for c in values for n in (f"{c}_known", c)] if per_field else [known, *values]
    clash = [n for n in names if n in left.columns]
    if clash:
        raise ValueError(f"columns {clash} are on both sides")
    both = merged_sides(left, right, keys, moment, known, values, strict, per_field)
    carried = [f"{OWN}v{i}" for i in range(len(values) if per_field else 1)]
    order = [F.col(OWN + "t").asc_nulls_first(), F.col(OWN + "side").asc(), F.col(OWN + "tie").asc()]
    done = carry_forward(both, carried, [f"{OWN}k{i}" for i in range(len(keys))], order)
    asked = done.where(F.col(OWN + "row").isNotNull())
    if per_field:
        got = [g for i, c in enumerate(values) for g in (
            F.col(f"{OWN}v{i}.`{known}`").alias(f"{c}_known"), F.col(f"{OWN}v{i}.`{c}`").alias(c))]
    else:
        got = [F.col(f"{OWN}v0.`{c}`").alias(c) for c in names]
    return asked.select(*[F.col(f"{OWN}row.`{c}`").alias(c) for c in left.columns], *got)
