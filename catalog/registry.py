"""Where queries register: a Spark function and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.views import Inputs, oracle
from tallyloom.session import apply_plan_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Inputs(apply_plan_settings(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return build
    return register
