"""Landed files as a stream: each file is taken up once, however often the job runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def landed_stream(spark: SparkSession, path: str, schema: T.StructType | str,
                  files_per_batch: int = 1000) -> DataFrame:
    """Rows of the Parquet files below a path with their ``file_path``; known files are skipped."""
    files = (spark.readStream.schema(schema).option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", files_per_batch)
             .parquet(path))
    return files.select("*", F.col("_metadata.file_path").alias("file_path"))


def append_new(stream: DataFrame, clean: Callable[[DataFrame], DataFrame], target: str,
               progress: str) -> StreamingQuery:
    """Cleans what has landed since the last run and adds it to the target, then stops.

    A batch is written to a directory of its own number, so one that is repeated after a failure
    replaces itself instead of doubling its rows.
    """
    def write(batch: DataFrame, number: int) -> None:
        clean(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", progress)
            .trigger(availableNow=True).start())
