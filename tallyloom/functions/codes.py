"""Security code formats as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two full code formats.
VENDOR_CODE = r"^(\d{6})\.(SH|SZ|BJ)$"
FEED_CODE = r"^(sh|sz|bj)(\d{6})$"


def _checked(valid: Column, value: Column, source: Column, on_invalid: str, what: str) -> Column:
    if on_invalid == "null":
        return F.when(valid, value)
    message = F.concat(F.lit(f"not a {what}: "), F.coalesce(source, F.lit("null")))
    return F.when(valid, value).otherwise(F.raise_error(message).cast("string"))


def to_feed_code(c: Column, upper: bool = False, on_invalid: str = "raise") -> Column:
    """``600000.SH`` to ``sh600000``; a bad code stops the job, or gives null on request."""
    # A code that passed the check has its parts at fixed places; one pattern match is enough.
    exchange = F.substring(c, 8, 2)
    value = F.concat(exchange if upper else F.lower(exchange), F.substring(c, 1, 6))
    return _checked(c.rlike(VENDOR_CODE), value, c, on_invalid, "vendor code")


def from_feed_code(c: Column, on_invalid: str = "raise") -> Column:
    """``sh600000`` (any case) to ``600000.SH``."""
    low = F.lower(c)
    value = F.concat(F.substring(c, 3, 6), F.lit("."), F.upper(F.substring(c, 1, 2)))
    return _checked(low.rlike(FEED_CODE), value, c, on_invalid, "feed code")


def code_digits(c: Column) -> Column:
    """part before the dot; without a dot a leading SZ or SH is dropped."""
    text = F.trim(c)
    return (F.when(text.contains("."), F.split_part(text, F.lit("."), F.lit(1)))
            .when(text.startswith("SZ") | text.startswith("SH"), F.substr(text, F.lit(3)))
            .otherwise(text))


def exchange_first(c: Column) -> Column:
    """``600000.SH`` to ``SH600000``."""
    return F.concat(F.split_part(c, F.lit("."), F.lit(2)), F.split_part(c, F.lit("."), F.lit(1)))


def digits_only(c: Column) -> Column:
    """``600000.SH`` to ``600000``."""
    return F.split_part(c, F.lit("."), F.lit(1))


def code_suffix(c: Column) -> Column:
    """Everything after the first dot, null without one."""
    at = F.instr(c, ".")
    return F.when(at > 0, F.substring(c, at + 1, F.length(c)))
