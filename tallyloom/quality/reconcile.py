"""Totals against the sum of their components."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.contracts import RECONCILE_MAX_PERCENT, RECONCILE_TOLERANCE
from tallyloom.functions.amounts import signed_row_sum

RESULT_SCHEMA = (
    "group_id string, group_name string, valid_records bigint, large_diff_count bigint, "
    "large_diff_percentage double, fields_present int, fields_total int, threshold double, "
    "passed boolean")


class ReconcileError(ValueError):
    """One or more groups differ too often."""


@dataclass(frozen=True)
class Group:
    group_id: str
    name: str
    total: str
    components: tuple[tuple[str, bool], ...]


def relationship_items(config: DataFrame, section: Sequence[str] = ()) -> DataFrame:
    """config rows (position, field, relationship, report_item) to one row per part.

    ``N`` and ``N_`` name a total, ``N_1`` a component, ``-N_1`` one that is subtracted; ``;``
    separates several. Parts of a deeper level or without a numeric group drop out. ``section``
    columns keep several configs apart.
    """
    parts = config.select(*section, "position", "field", "report_item",
                          F.explode(F.split("relationship", ";")).alias("_part"))
    pattern = r"^(-?)(\d+)(?:(_)(.*))?$"
    text = F.trim("_part")
    level = F.regexp_extract(text, pattern, 4)
    return parts.where(text.rlike(pattern) & level.isin("", "1")).select(
        *section, F.regexp_extract(text, pattern, 2).alias("group_id"),
        (level == "").alias("is_total"), "position", "field", "report_item",
        (F.regexp_extract(text, pattern, 1) == "-").alias("negative"))


def complete_groups(items: DataFrame, section: Sequence[str] = ()) -> DataFrame:
    """groups with a total and components; the first total wins, repeats count once."""
    by = [*section, "group_id"]
    component = ~F.col("is_total")
    once = items.groupBy(*by, "is_total", "field", "negative").agg(
        F.min(F.struct("position", "field", "report_item")).alias("_item"))
    groups = once.groupBy(*by).agg(
        F.min(F.when(F.col("is_total"), F.col("_item"))).alias("_total"),
        F.count_if(component).alias("n_components"),
        F.count_if(component & F.col("negative")).alias("n_negative"))
    return groups.where(F.col("_total").isNotNull() & (F.col("n_components") > 0)).select(
        *by, F.col("_total.report_item").alias("group_name"), F.col("_total.field").alias("total"),
        "n_components", "n_negative")


def load_groups(config: DataFrame) -> list[Group]:
    """Groups of one statement's config, brought to the driver to become columns of a plan.

    A statement has some hundred fields; this is configuration, never data.
    """
    totals, components = {}, {}
    for row in relationship_items(config).orderBy("position").collect():
        if row.is_total:
            totals.setdefault(row.group_id, row)
        else:
            components.setdefault(row.group_id, {})[(row.field, row.negative)] = None
    return [Group(g, totals[g].report_item, totals[g].field, tuple(components[g]))
            for g in sorted(totals.keys() & components.keys(), key=int)]


def groups_from_section(section: Mapping[str, Mapping[str, str]], spark) -> list[Group]:
    """Groups of a config section: field -> {relationship, report_item}."""
    rows = [(i, name, entry["relationship"], entry.get("report_item", ""))
            for i, (name, entry) in enumerate(section.items()) if entry.get("relationship")]
    schema = "position int, field string, relationship string, report_item string"
    return load_groups(spark.createDataFrame(rows, schema)) if rows else []


def reconcile(df: DataFrame, groups: Sequence[Group], tolerance: float = RECONCILE_TOLERANCE,
              max_percent: float = RECONCILE_MAX_PERCENT,
              overrides: Mapping[str, float] | None = None) -> DataFrame:
    """Q9: every group checked in one aggregate over the table.

    A row counts where both the total and the component sum exist. Groups whose total or all of
    whose components are no columns, and groups without a countable row, give no result.
    """
    overrides = overrides or {}
    aggs, checked = [], []
    for group in groups:
        present = [(f, neg) for f, neg in group.components if f in df.columns]
        if group.total not in df.columns or not present:
            continue
        total = F.col(f"`{group.total}`")
        parts = signed_row_sum([(F.col(f"`{f}`"), neg) for f, neg in present])
        gap = F.abs(parts - total)
        i = len(checked)
        aggs += [F.count(gap).alias(f"_valid{i}"), F.count_if(gap > tolerance).alias(f"_large{i}")]
        checked.append((group, len(present)))
    if not checked:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    entries = []
    for i, (group, present) in enumerate(checked):
        threshold = float(overrides.get(group.group_id, max_percent))
        percent = F.try_divide(F.col(f"_large{i}") * 100.0, F.col(f"_valid{i}"))
        entries.append(F.struct(
            F.lit(group.group_id).alias("group_id"), F.lit(group.name).alias("group_name"),
            F.col(f"_valid{i}").alias("valid_records"),
            F.col(f"_large{i}").alias("large_diff_count"),
            percent.alias("large_diff_percentage"), F.lit(present).alias("fields_present"),
            F.lit(len(group.components)).alias("fields_total"),
            F.lit(threshold).alias("threshold"), (percent <= threshold).alias("passed")))
    rows = df.agg(*aggs).select(F.inline(F.array(*entries)))
    return rows.where(F.col("valid_records") > 0)


def require_reconciled(results: DataFrame) -> None:
    """Raises after all groups were looked at, naming each that failed."""
    failed = results.where(~F.col("passed")).collect()
    if failed:
        text = "; ".join(f"group {r.group_id} ({r.group_name}): {r.large_diff_percentage:.2f}% "
                         f"over {r.threshold}%" for r in failed)
        raise ReconcileError(text)
