"""Amount arithmetic as column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add, and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.contracts import LOSS_SIGN_CHANGE


def lenient_number(c: Column) -> Column:
    """a number or null, never an error."""
    return c.try_cast("double")


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def sign_by_date(value: Column, end_date: Column, change: int = LOSS_SIGN_CHANGE) -> Column:
    """the value from the change date on, its negative before it or without a date."""
    return F.when(lenient_number(end_date) >= change, value).otherwise(-value)


def fallback_total(total: Column, *parts: Column) -> Column:
    """the total, else the plain sum of its parts (null if any part is null)."""
    return F.coalesce(total, reduce(add, parts))


def signed_row_sum(parts: Iterable[tuple[Column, bool]]) -> Column:
    """Sum over (column, is_negative); null counts as 0 unless every part is null."""
    parts = list(parts)
    all_null = reduce(and_, [c.isNull() for c, _ in parts])
    terms = [F.coalesce(-c if negative else c, F.lit(0.0)) for c, negative in parts]
    return F.when(~all_null, reduce(add, terms))


def relative_spread(high: Column, low: Column, filled: Column) -> Column:
    """(max - min) / max with two or more values and a positive max, else null."""
    return F.when((filled >= 2) & (high > 0), F.abs(high - low) / high)
