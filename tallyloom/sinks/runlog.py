"""The log of runs: rows are only ever added, the newest state wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATUSES = ("SUCCESS", "FAILED", "PARTIAL", "SKIPPED")
RUN_SCHEMA = (
    "task_id string, source_name string, data_type string, data_md5 string, previous_md5 string, "
    "duration_ms bigint, data_rows bigint, original_rows bigint, row_difference bigint, "
    "error_message string, api_params string, original_filename string, file_path string, "
    "archive_path string, execution_status string, created_at timestamp, updated_at timestamp")


def append_runs(rows: DataFrame, path: str) -> None:
    """Adds run states; the row difference is derived."""
    rows.withColumn("row_difference", F.col("data_rows") - F.col("original_rows")) \
        .write.mode("append").parquet(path)


def latest_runs(log: DataFrame, key: str = "task_id", moment: str = "updated_at") -> DataFrame:
    """The newest state of each task."""
    rest = [c for c in log.columns if c not in (key, moment)]
    newest = log.groupBy(key).agg(F.max(F.struct(moment, *rest)).alias("_run"))
    return newest.select(*[F.col(c) if c == key else F.col(f"_run.{c}").alias(c)
                           for c in log.columns])


def run_rows(spark: SparkSession, runs: list[dict]) -> DataFrame:
    names = [part.split()[0] for part in RUN_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in runs], RUN_SCHEMA)
