"""Projections and renames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tallyloom.contracts import INDICATOR_FIELDS, STATEMENT_FIELDS


def quoted(name: str) -> str:
    return f"`{name}`"


def ordered(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Existing fields in the given order, no repeats; none given keeps all."""
    names = [f for f in dict.fromkeys(fields) if f in df.columns]
    return df.select(*[quoted(n) for n in names]) if names else df


def missing_fields(df: DataFrame, fields: Sequence[str]) -> list[str]:
    """Wanted names the frame does not have."""
    return [f for f in dict.fromkeys(fields) if f not in df.columns]


def section_fields(section: Mapping[str, Mapping[str, str]]) -> list[str]:
    return [entry.get("renamed_field", name) for name, entry in section.items()]


def statement_projection(df: DataFrame, section: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """P10."""
    return ordered(df, [*STATEMENT_FIELDS, *section_fields(section)])


def indicator_projection(df: DataFrame, section: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """P11."""
    return ordered(df, [*INDICATOR_FIELDS, *section_fields(section)])


def drop_fields(df: DataFrame, *names: str) -> DataFrame:
    """Absent names are ignored."""
    return df.drop(*names)


def rename_one(df: DataFrame, old: str, new: str) -> DataFrame:
    """An absent column changes nothing."""
    return df.withColumnRenamed(old, new)


def rename_section(df: DataFrame, section: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Vendor name to ``renamed_field``; entries without one are left alone."""
    names = {old: entry["renamed_field"] for old, entry in section.items()
             if entry.get("renamed_field") and old in df.columns}
    return df.withColumnsRenamed({o: n for o, n in names.items() if o != n})


def replace_by_fixed(df: DataFrame, names: Sequence[str], suffix: str = "_fixed") -> DataFrame:
    """Each corrected column takes the place of its original."""
    present = [n for n in names if n + suffix in df.columns]
    return df.drop(*present).withColumnsRenamed({n + suffix: n for n in present})
