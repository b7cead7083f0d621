"""The eight table processors: step lists over the operators.

A processor is two things: ``plan`` builds the cleaned table as one lazy query, and ``run`` writes
it, checks what was written, and publishes it. The checks read only the columns they need from the
written version, so the cleaning itself is computed once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyloom import contracts as C
from tallyloom.functions.amounts import fallback_total, sign_by_date
from tallyloom.operators import columns, filters, resolve
from tallyloom.operators.resolve import statement_keys
from tallyloom.plans.steps import Step, run_steps
from tallyloom.quality.gates import require_unique
from tallyloom.quality.reconcile import groups_from_section, reconcile, require_reconciled
from tallyloom.sinks.snapshot import Outcome, SnapshotStore

Section = Mapping[str, Mapping[str, str]]


def fix_losses(df: DataFrame, change: int = C.LOSS_SIGN_CHANGE) -> DataFrame:
    """both loss columns with the sign of the later rule."""
    return df.withColumns({
        f"{name}_fixed": sign_by_date(F.col(name), F.col("end_date"), change)
        for name in ("assets_impair_loss", "credit_impa_loss")})


def fix_total_cost(df: DataFrame) -> DataFrame:
    """F11."""
    return df.withColumn("total_opcost_fixed", fallback_total(
        F.col("total_opcost"), F.col("total_cogs"), F.col("credit_impa_loss_fixed"),
        F.col("assets_impair_loss_fixed")))


def put_fixed(df: DataFrame) -> DataFrame:
    """P19."""
    return columns.replace_by_fixed(df, ["total_opcost", "credit_impa_loss", "assets_impair_loss"])


def drop_and_distinct(df: DataFrame, drops: Sequence[str] = ()) -> DataFrame:
    """P9, D4."""
    return resolve.distinct_rows(columns.drop_fields(df, *drops))


STEPS: dict[str, Step] = {
    "remove_empty_ts_code": filters.nonempty_key,
    "remove_empty_ann_date": lambda df: filters.nonnull(df, "ann_date"),
    "drop_columns_and_duplicates": drop_and_distinct,
    "handle_01_records": resolve.resolve_01,
    "handle_11_records": resolve.resolve_11,
    "handle_01_and_11_records": resolve.resolve_flags,
    "fix_losses": fix_losses,
    "fix_total_cost": fix_total_cost,
    "rename_fixed_columns": put_fixed,
    "filter_implementation_only": filters.with_status,
    "handle_duplicate_records": resolve.resolve_dividends,
    "filter_listing_dates": filters.within_listing,
}


@dataclass(frozen=True)
class Processor:
    section: str
    steps: tuple[dict, ...]
    fields: Sequence[str] = ()
    reconciles: bool = False
    keys: Sequence[str] | None = None
    max_percent: Mapping[str, float] = field(default_factory=dict)


def _steps(*names, **parameters) -> tuple[dict, ...]:
    return tuple({"function": n, **parameters.get(n, {})} for n in names)


QUOTE_KEYS = ("ts_code", "trade_date")

PROCESSORS = {
    "balance_sheet": Processor(
        "balance_sheet", _steps("remove_empty_ts_code", "handle_01_and_11_records"),
        C.STATEMENT_FIELDS, reconciles=True),
    "cash_flow": Processor(
        "cash_flow",
        _steps("remove_empty_ts_code", "drop_columns_and_duplicates", "handle_01_records",
               drop_columns_and_duplicates={"drops": C.CASH_FLOW_DROPS}),
        C.STATEMENT_FIELDS, reconciles=True, max_percent=C.CASH_FLOW_MAX_PERCENT),
    "indicator": Processor(
        "indicator",
        _steps("remove_empty_ts_code", "remove_empty_ann_date", "drop_columns_and_duplicates",
               "handle_01_records",
               drop_columns_and_duplicates={"drops": C.INDICATOR_DROPS}),
        C.INDICATOR_FIELDS, keys=("ts_code", "end_date", "ann_date")),
    "income": Processor(
        "income_statement",
        _steps("remove_empty_ts_code", "drop_columns_and_duplicates", "handle_01_records",
               "fix_losses", "fix_total_cost", "rename_fixed_columns",
               drop_columns_and_duplicates={"drops": C.INCOME_DROPS}),
        C.STATEMENT_FIELDS, reconciles=True),
    "dividend": Processor(
        "dividend",
        _steps("remove_empty_ts_code", "filter_implementation_only", "handle_duplicate_records"),
        keys=("ts_code", "end_date", "ann_date")),
    "daily": Processor(
        "daily", _steps("remove_empty_ts_code", "filter_listing_dates"), C.DAILY_FIELDS,
        keys=QUOTE_KEYS),
    "adj_factor": Processor(
        "adj_factor", _steps("remove_empty_ts_code", "filter_listing_dates"), C.ADJ_FIELDS,
        keys=QUOTE_KEYS),
    "daily_basic": Processor(
        "daily_basic", _steps("remove_empty_ts_code", "filter_listing_dates"), C.BASIC_FIELDS,
        keys=QUOTE_KEYS),
}


def plan(df: DataFrame, name: str, section: Section | None = None,
         overrides: Mapping[str, dict] | None = None,
         watch: dict[str, Observation] | None = None) -> DataFrame:
    """The cleaned table of one processor. ``overrides`` adds parameters to steps by name."""
    processor, section = PROCESSORS[name], section or {}
    steps = [{**s, **(overrides or {}).get(s["function"], {})} for s in processor.steps]
    cleaned = columns.rename_section(run_steps(df, steps, STEPS, watch=watch), section)
    if not processor.fields:
        return cleaned
    return columns.ordered(cleaned, [*processor.fields, *columns.section_fields(section)])


def reconciliation(df: DataFrame, name: str, section: Section) -> DataFrame:
    """Q9, P6 on the cleaned table, whose columns already have their new names."""
    renamed = {entry.get("renamed_field", old): entry for old, entry in section.items()}
    groups = groups_from_section(renamed, df.sparkSession)
    return reconcile(filters.company_type(df), groups,
                     overrides=PROCESSORS[name].max_percent)


def run(df: DataFrame, name: str, store: SnapshotStore, dataset: str,
        section: Section | None = None, overrides: Mapping[str, dict] | None = None,
        rejects_root: str | None = None, run_id: str | None = None) -> Outcome:
    """Writes a version, checks it, and only then publishes it."""
    processor = PROCESSORS[name]
    cleaned = plan(df, name, section, overrides)

    def check(written: DataFrame) -> None:
        keys = processor.keys or statement_keys(written.columns)
        missing = [k for k in keys if k not in written.columns]
        if missing:
            raise ValueError(f"{name}: key columns {missing} are missing, uniqueness cannot be checked")
        require_unique(written, keys, rejects_root, run_id)
        if processor.reconciles and section:
            require_reconciled(reconciliation(written, name, section))

    return store.save_computed(cleaned, dataset, info=name, shrink="allow", check=check)
