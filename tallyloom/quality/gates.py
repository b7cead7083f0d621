"""Checks that stop a job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.resolve import repeated_keys, repeated_rows
from tallyloom.sinks.writers import write_rejects


class DuplicateKeyError(ValueError):
    """Rows share a key that must be unique."""


def require_unique(df: DataFrame, keys: Sequence[str], rejects_root: str | None = None,
                   run_id: str | None = None) -> None:
    """Raises on a repeated key, with the row count and the first ten keys.

    The offending rows go to the rejects of the run if a root is given.
    """
    repeated = repeated_keys(df, keys)
    total = repeated.agg(F.sum("n_rows").alias("n")).first()["n"]
    if not total:
        return
    where = ""
    if rejects_root:
        where = f"; rows kept in {write_rejects(repeated_rows(df, keys), rejects_root, run_id)}"
    sample = [tuple(r[k] for k in keys) for r in repeated.orderBy(*keys).limit(10).collect()]
    raise DuplicateKeyError(f"{total} rows share a key of {'+'.join(keys)}, "
                            f"first keys {sample}{where}")
