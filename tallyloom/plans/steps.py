"""Named steps and chains of them.

A step is a function ``DataFrame -> DataFrame`` with keyword parameters. A chain is a list of
``{"function": name, ...parameters}``; it adds nothing to the plan, Spark sees one query.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyloom.functions.dates import normalise_date, quarter_end_from_path
from tallyloom.operators import columns, fill, filters, lookup, resolve
from tallyloom.sources.scan import ROW_IN_FILE

log = logging.getLogger(__name__)

Step = Callable[..., DataFrame]


def run_steps(df: DataFrame, steps: Sequence[Mapping], registry: Mapping[str, Step],
              on_error: str = "raise", watch: dict[str, Observation] | None = None) -> DataFrame:
    """Applies the steps in order.

    An unknown step is reported and left out. A step that cannot be applied raises, or with
    ``on_error="skip"`` leaves the frame as it was. ``watch`` receives one row counter per step
    (G15), filled by whatever action runs the plan.
    """
    for number, step in enumerate(steps):
        name = step.get("function")
        parameters = {k: v for k, v in step.items() if k not in ("function", "description",
                                                                 "category", "required_fields")}
        if name not in registry:
            log.warning("unknown step %s left out", name)
            continue
        try:
            after = registry[name](df, **parameters)
            after.schema  # a step that does not fit the columns fails here
        except (AnalysisException, ValueError, KeyError, TypeError) as error:
            if on_error != "skip":
                raise
            log.warning("step %s left the rows as they were: %s", name, error)
            continue
        df = after
        if watch is not None:
            seen = Observation(f"{number:02d}_{name}")
            watch[f"{number:02d}_{name}"] = seen
            df = df.observe(seen, F.count("*").alias("rows"))
    return df


def _target(field_name, source_field, target_field=None, operation="add"):
    source = source_field or field_name
    if operation == "replace":
        return source, source
    return source, target_field or field_name or source


def convert_date(df, field_name=None, source_field=None, target_field=None, operation="add"):
    """F1 as a step."""
    source, target = _target(field_name, source_field, target_field, operation)
    return normalise_date(df, source, target) if source in df.columns else df


def end_date_from_path(df, field_name="end_date", source_field="file_path", operation="add"):
    """F5 as a step."""
    if source_field not in df.columns:
        return df
    return df.withColumn(field_name, quarter_end_from_path(F.col(source_field)))


def cleaning_registry(master: DataFrame | None = None, code_map: DataFrame | None = None,
                      row_order: Sequence[str] = ("file_path", ROW_IN_FILE)) -> dict[str, Step]:
    """The cleaning steps, bound to the reference tables they look up.

    ``row_order`` says which row comes first, as Spark rows have no order; landed files know the
    order they were written in.
    """
    def add_ts_code(df, source_field, field_name="ts_code", operation="add"):
        if master is None:
            raise ValueError("add_ts_code needs a security master")
        return lookup.add_security(df, master, source_field, field_name)

    def apply_bse_mapping(df, field_name=None, source_field=None, target_field=None,
                          operation="add"):
        source, target = _target(field_name, source_field, target_field, operation)
        if source not in df.columns:
            return df
        if code_map is None:
            return df.withColumn(target, F.col(source))
        return lookup.remap_code(df, code_map, source, target)

    def drop_duplicates(df, subset=None, **_):
        order = [c for c in row_order if c in df.columns]
        if not subset and ROW_IN_FILE in df.columns:
            subset = [c for c in df.columns if c != ROW_IN_FILE]
        return resolve.distinct_on(df, subset, order)

    def rename_column(df, old_name, new_name=None, field_name=None, **_):
        return columns.rename_one(df, old_name, new_name or field_name)

    def fill_na(df, field_name=None, fill_value=None, method=None, partition_by=(), **_):
        if fill_value is not None:
            return fill.fill_constant(df, fill_value, field_name)
        if method in ("ffill", "bfill"):
            names = [field_name] if field_name else [c for c in df.columns if c not in row_order]
            return fill.fill_from_neighbours(df, names, list(row_order), partition_by,
                                             forward=method == "ffill")
        return df

    def filter_data(df, field_name, condition, **_):
        return filters.matching(df, field_name, condition)

    return {
        "convert_date_format": convert_date,
        "apply_bse_mapping": apply_bse_mapping,
        "add_ts_code": add_ts_code,
        "extract_end_date_from_path": end_date_from_path,
        "drop_duplicates": drop_duplicates,
        "rename_column": rename_column,
        "fill_na": fill_na,
        "filter_data": filter_data,
    }
