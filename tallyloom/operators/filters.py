"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.contracts import BEIJING_OPENING, IMPLEMENTED
from tallyloom.functions.amounts import lenient_number
from tallyloom.functions.dates import compact_int


def nonempty_key(df: DataFrame, key: str = "ts_code") -> DataFrame:
    """Drops null, empty and single-blank keys; nothing is trimmed."""
    return df.where(F.col(key).isNotNull() & ~F.col(key).isin("", " "))


def nonnull(df: DataFrame, column: str) -> DataFrame:
    """P2."""
    return df.where(F.col(column).isNotNull())


def matching(df: DataFrame, column: str, condition: str, on_error: str = "raise") -> DataFrame:
    """``==x``, ``!=x``, ``>=n``, ``<=n``, ``>n``, ``<n``, ``notna``, ``isna``.

    ``!=`` keeps nulls. The literal of ``==`` and ``!=`` is read as the column's type; the other way
    round, ``>`` and its like read a text column as numbers, and text that is none fits no such condition.
    An absent column leaves the rows as they are; so does an unknown condition with
    ``on_error="skip"``, which otherwise raises.
    """
    if column not in df.columns:
        return df
    c, text = F.col(column), condition.strip()
    if text == "notna":
        return df.where(c.isNotNull())
    if text == "isna":
        return df.where(c.isNull())
    operator = next((o for o in ("==", "!=", ">=", "<=", ">", "<") if text.startswith(o)), None)
    literal = text[len(operator):].strip() if operator else ""
    if operator in ("==", "!="):
        value = F.lit(literal).try_cast(df.schema[column].dataType)
        return df.where(c == value if operator == "==" else ~F.coalesce(c == value, F.lit(False)))
    try:
        number = float(literal)
    except ValueError:
        operator = None
    if operator is None:
        if on_error == "skip":
            return df
        raise ValueError(f"condition not understood: {condition}")
    if isinstance(df.schema[column].dataType, T.StringType):
        c = lenient_number(c)
    tests = {">=": c >= number, "<=": c <= number, ">": c > number, "<": c < number}
    return df.where(tests[operator])


def _as_day_number(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return compact_int(F.col(name))
    return F.col(name).try_cast("int")


def within_listing(df: DataFrame, key: str = "ts_code", day: str = "trade_date",
                   listed: str = "list_date", delisted: str = "delist_date",
                   floor: int = BEIJING_OPENING) -> DataFrame:
    """Rows from the listing day up to and including the delisting day.

    The listing day of ``.BJ`` codes is at least ``floor``. A null listing day drops the row.
    """
    if day not in df.columns or listed not in df.columns:
        return df
    traded, start = _as_day_number(df, day), _as_day_number(df, listed)
    start = F.when(F.col(key).endswith(".BJ"), F.greatest(start, F.lit(floor))).otherwise(start)
    keep = start.isNotNull() & (traded >= start)
    if delisted in df.columns:
        end = _as_day_number(df, delisted)
        keep = keep & (end.isNull() | (traded <= end))
    # greatest() skips nulls, so the null listing day is tested on the column itself.
    return df.where(F.col(listed).isNotNull() & keep)


def with_status(df: DataFrame, column: str = "div_proc", status: str = IMPLEMENTED) -> DataFrame:
    """Rows with one status; a frame without the column passes."""
    return df.where(F.col(column) == status) if column in df.columns else df


def company_type(df: DataFrame, kind: str = "1", column: str = "comp_type") -> DataFrame:
    """Number or text company type; a frame without the column passes."""
    return df.where(F.col(column).cast("string") == kind) if column in df.columns else df


def open_days(calendar: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Open days of a calendar, optionally in a closed range of ``yyyyMMdd`` text."""
    days = calendar.where(F.col("is_open") == 1)
    if start is not None:
        days = days.where(F.col("cal_date") >= start)
    if end is not None:
        days = days.where(F.col("cal_date") <= end)
    return days


def sampled_entities(df: DataFrame, key: str, count: int, seed: int = 0) -> DataFrame:
    """Rows of N keys drawn at random, the same ones for the same seed."""
    drawn = df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(
        F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(count)
    return df.join(drawn, key, "left_semi")


def first_entities(df: DataFrame, key: str, limit: int | None) -> DataFrame:
    """Rows of the first N keys in ascending order; None or <= 0 keeps all."""
    if limit is None or limit <= 0:
        return df
    chosen = df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key).limit(limit)
    return df.join(chosen, key, "left_semi")
