"""What has landed, as a table that is kept up by difference.

The landing area is listed, which opens no file, and saved as a table partitioned by method. The save
compares digests and writes only methods whose files changed, so the table's commits are the history of the
area and two of them tell which files came, changed or went. Each file carries the grain of its method,
from which its period follows, and whether it has a sidecar.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.dates import path_period, period_end, period_grain, period_start
from tallyloom.operators.overlap import overlap_join
from tallyloom.sinks.changes import digest_diff
from tallyloom.sinks.partitions import PartitionStore
from tallyloom.sources.landing import UNDATED
from tallyloom.sources.scan import empty, file_listing, file_stem

STATES = {"insert": "new", "update": "changed", "delete": "gone"}


def listed_files(spark: SparkSession, root: str, grains: Mapping[str, str] | None = None) -> DataFrame:
    """Every Parquet file at ``<root>/<source>/<method>/...`` with source, method, grain, period and sidecar.

    ``grains`` says how a method is stored (one of the grains of the layout); a method it does not name has
    the grain its folders look like. The label of a file kept by symbol is its folder, that of a snapshot
    ``snapshot``; both have no bounds.
    """
    plain = root.rstrip("/").split(":", 1)[-1].replace("//", "/")
    inside = F.split(F.substring_index("file_path", f"{plain}/", -1), "/")
    data = file_listing(spark, [root]).withColumns({"stem": file_stem(F.col("file_path")), "parts": inside})
    notes = file_listing(spark, [root], "*.json").select(file_stem(F.col("file_path")).alias("stem"), F.lit(True).alias("noted"))
    known = data.where(F.size("parts") > 2).join(notes, "stem", "left")
    below = F.concat(F.array_join(F.slice("parts", 3, F.size("parts")), "/"))
    seen = path_period(below)
    given = F.create_map(*[F.lit(x) for pair in (grains or {"": ""}).items() for x in pair])
    grain = F.coalesce(F.upper(F.try_element_at(given, F.col("parts")[1])), F.upper(period_grain(seen)), F.lit("SNAPSHOT"))
    named = known.select(
        F.col("file_path").alias("path"), F.col("parts")[0].alias("source"), F.col("parts")[1].alias("method"),
        grain.alias("grain"), seen.alias("seen"), F.col("parts")[2].alias("folder"), "modified", "length",
        F.coalesce("noted", F.lit(False)).alias("has_sidecar"))
    dated = ~F.col("grain").isin(*UNDATED)
    label = (F.when(dated, F.when(F.upper(period_grain(F.col("seen"))) == F.col("grain"), F.col("seen")))
             .when(F.col("grain") == "SYMBOL", F.col("folder")).otherwise("snapshot"))
    labelled = named.withColumn("period", label)
    start = period_start(F.col("period"))
    bounds = F.struct(F.when(dated, start).alias("period_start"), F.when(dated, period_end(F.col("period"), start)).alias("period_end"))
    # A generator, so that the path is parsed once and filters on the bounds stay above it.
    return labelled.drop("seen", "folder").select("*", F.inline(F.array(bounds)))


class FileCatalogue:
    """The files of a landing area, kept at ``path``."""

    def __init__(self, spark: SparkSession, path: str, root: str, grains: Mapping[str, str] | None = None):
        self.spark, self.root, self.grains = spark, root, dict(grains or {})
        self.store = PartitionStore(spark, path, "method", ["path"])

    def refresh(self) -> DataFrame:
        """Takes up the area as it is now; returns (path, state) of files that are new, changed or gone.

        A file is changed if its time or length is another. An area without any file is refused: it is more
        likely out of reach than empty.
        """
        before = self.store.log.head()
        saved = self.store.save(listed_files(self.spark, self.root, self.grains), shrink="allow", whole=True)
        if saved.number is None:
            return empty(self.spark, "path string, state string")
        state = F.create_map(*[F.lit(x) for pair in STATES.items() for x in pair])
        changes = digest_diff(self.store, before, saved.number)
        return changes.select("path", F.element_at(state, F.col("change")).alias("state"))

    def files(self, number: int | None = None) -> DataFrame:
        """The files as of the last refresh, or of one before."""
        return self.store.read(number)

    def landed(self) -> DataFrame:
        """(dataset, period) of what has landed with its sidecar."""
        there = self.files().where(F.col("has_sidecar") & F.col("period").isNotNull())
        return there.select(F.col("method").alias("dataset"), "period").distinct()

    def periods(self) -> DataFrame:
        """(method, period) of dated files."""
        return self.files().where(F.col("period_start").isNotNull()).select("method", "period").distinct()

    def files_for(self, requests: DataFrame) -> DataFrame:
        """Each request (method, start_day, end_day) with the files whose period it overlaps."""
        dated = self.files().where(F.col("period_start").isNotNull()).select("method", "path", "period", "period_start", "period_end")
        return overlap_join(requests, dated, ["method"], ("start_day", "end_day"), ("period_start", "period_end"))
