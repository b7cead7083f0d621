"""Filling nulls by a constant or from neighbouring rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.carry import carry_forward


def fill_constant(df: DataFrame, value, column: str | None = None) -> DataFrame:
    """one column, or every column the value's type fits."""
    return df.fillna(value, subset=[column] if column else None)


def fill_from_neighbours(df: DataFrame, columns: Sequence[str], order_by: Sequence[str],
                         partition_by: Sequence[str] = (), forward: bool = True) -> DataFrame:
    """the last value before (or first after) each null, in the given order.

    ``partition_by`` and ``order_by`` together must identify a row. One shuffle into sorted ranges; neither
    a whole-frame fill nor one hot entity ends up in a single task.
    """
    order = [F.col(f"`{c}`").asc() if forward else F.col(f"`{c}`").desc() for c in order_by]
    return carry_forward(df, columns, partition_by, order)
