"""Versioned tables written only when their content changed.

A version is a directory of its own. Publishing it is one commit of the store's log, made by one atomic
step, so readers see either the old version or the new one, a lost executor or job leaves no half-written
table in sight, and of two savers that began with the same version one publishes and the other is told.
Old versions stay where they are; the log says which one is current.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.sinks.commits import CommitLog

MANIFEST_SCHEMA = (
    "dataset string, version string, path string, rows bigint, columns int, fingerprint string, "
    "previous_version string, previous_rows bigint, previous_fingerprint string, "
    "info string, created_at timestamp, updated_at timestamp")


class StaleError(RuntimeError):
    """Another save published a version of the dataset while this one was being made."""


class ShrinkError(ValueError):
    """The new content has fewer rows than the current version and nothing confirmed it."""


def fingerprint_aggs(df: DataFrame) -> list[Column]:
    """K8: aggregates whose values do not depend on row order or partitioning.

    The row hash covers a null flag per column, as a null alone would not change it.
    """
    marks = [c for name in df.columns
             for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    row = F.xxhash64(*marks)
    return [F.count("*").alias("rows"), F.sum(row.cast("decimal(38,0)")).alias("hash_sum"),
            F.bit_xor(row).alias("hash_xor")]


def fingerprint(df: DataFrame) -> DataFrame:
    """K8: content fingerprint of a table as one row."""
    return df.agg(*fingerprint_aggs(df))


def _text(values) -> str:
    return f"{values['rows']}-{values['hash_sum']}-{values['hash_xor']}"


@dataclass(frozen=True)
class Outcome:
    dataset: str
    method: str
    rows: int
    fingerprint: str | None
    path: str | None
    message: str


class SnapshotStore:
    """K7-K12 below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, self.root, MANIFEST_SCHEMA)

    def manifest(self, upto: int | None = None) -> DataFrame:
        """Every published version, optionally up to a commit."""
        return self.log.entries(upto).drop("number")

    def current(self, upto: int | None = None) -> DataFrame:
        """The newest row per dataset."""
        rows = self.manifest(upto)
        rest = [c for c in rows.columns if c not in ("dataset", "updated_at", "version")]
        newest = rows.groupBy("dataset").agg(
            F.max(F.struct("updated_at", "version", *rest)).alias("_row"))
        return newest.select("dataset", *[F.col(f"_row.{c}").alias(c) for c in rows.columns
                                          if c != "dataset"])

    def latest(self, dataset: str, upto: int | None = None):
        found = self.current(upto).where(F.col("dataset") == dataset).take(1)
        return found[0] if found else None

    def read(self, dataset: str) -> DataFrame | None:
        row = self.latest(dataset)
        return self.spark.read.parquet(row.path) if row else None

    def versions(self, dataset: str) -> DataFrame:
        """K9: versions of a dataset, the superseded ones marked."""
        rows = self.manifest().where(F.col("dataset") == dataset)
        newest = rows.agg(F.max(F.struct("updated_at", "version"))["version"].alias("v"))
        return rows.withColumn("superseded", F.col("version") != newest.scalar())

    def superseded_before(self, cutoff: dt.datetime) -> DataFrame:
        """Versions no longer current and older than the cutoff."""
        rows, now = self.manifest(), self.current().select("dataset", "version")
        old = rows.where(F.col("updated_at") < F.lit(cutoff))
        return old.join(now, ["dataset", "version"], "left_anti")

    def changed_since(self, moment: dt.datetime) -> DataFrame:
        """Current versions published after a moment; their paths are what to read."""
        return self.current().where(F.col("updated_at") > F.lit(moment))

    def save(self, df: DataFrame, dataset: str, info: str = "", shrink: str = "raise",
             second: Callable[[], DataFrame] | None = None, force: bool = False,
             check: Callable[[DataFrame], None] | None = None) -> Outcome:
        """K7: ``new``, ``update`` or ``skip`` for an extract that is cheap to read.

        The fingerprint is taken before anything is written, so unchanged content costs one read
        and no write; changed content is read twice. ``shrink`` says what fewer rows than before mean: ``raise``, ``verify``
        (a second extract must agree) or ``allow``. Empty input is refused. ``check`` sees the
        written version and may raise to keep it from being published.
        """
        old, seen = self.latest(dataset), fingerprint(df).first()
        known = self._judge(dataset, seen, old, shrink, second, force)
        if known is not None:
            return known
        version, path, facts = self._write(df, dataset)
        judged = _text(facts) == _text(seen)  # else the extract changed between the two reads
        return self._settle(df, dataset, info, shrink, second, force, version, path, facts, old,
                            check, judged)

    def save_computed(self, df: DataFrame, dataset: str, info: str = "", shrink: str = "raise",
                      second: Callable[[], DataFrame] | None = None, force: bool = False,
                      check: Callable[[DataFrame], None] | None = None) -> Outcome:
        """K7 for the result of a long plan, which runs once.

        The version is written first and its fingerprint taken on the way; content that turns out
        unchanged or refused stays unpublished.
        """
        old = self.latest(dataset)
        version, path, facts = self._write(df, dataset)
        return self._settle(df, dataset, info, shrink, second, force, version, path, facts, old, check)

    def _settle(self, df, dataset, info, shrink, second, force, version, path, facts, old, check,
                judged: bool = False) -> Outcome:
        """Publishes a written version, or deletes it: nothing that is not published stays."""
        try:
            known = None if judged else self._judge(dataset, facts, old, shrink, second, force)
            outcome = known or self._publish(df, dataset, info, version, path, facts, old, check)
        except Exception:
            if not self.manifest().where(F.col("version") == version).take(1):
                self._discard(path)
            raise
        if known is not None:
            self._discard(path)
        return outcome

    def _discard(self, path: str) -> None:
        """Deletes a version that this save wrote and did not publish."""
        context = self.spark.sparkContext
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)

    def _judge(self, dataset, facts, old, shrink, second, force) -> Outcome | None:
        """Skip for unchanged content, an error for refused content, None for content to publish."""
        if shrink not in ("raise", "verify", "allow"):
            raise ValueError(f"shrink must be raise, verify or allow, not {shrink}")
        if facts["rows"] == 0:
            raise ValueError(f"{dataset}: no rows, nothing is saved")
        mark = _text(facts)
        if old and old.fingerprint == mark and not force:
            return Outcome(dataset, "skip", facts["rows"], mark, old.path, "content unchanged")
        if old and facts["rows"] < old.rows:
            self._check_shrink(dataset, mark, facts["rows"], old.rows, shrink, second)
        return None

    def _check_shrink(self, dataset, mark, rows, old_rows, shrink, second) -> None:
        """K10."""
        if shrink == "allow":
            return
        if shrink == "verify" and second is not None:
            if _text(fingerprint(second()).first()) == mark:
                return
        raise ShrinkError(f"{dataset}: {old_rows} rows before, {rows} now")

    def _write(self, df: DataFrame, dataset: str) -> tuple[str, str, dict]:
        """A version of its own, its fingerprint observed by the write."""
        now = dt.datetime.now(dt.timezone.utc)
        version = f"{now:%Y%m%d_%H%M%S_%f}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/{dataset}/version={version}"
        seen = Observation()
        (df.observe(seen, *fingerprint_aggs(df))
         .write.option("compression", "snappy").parquet(path))
        return version, path, seen.get

    def _publish(self, df, dataset, info, version, path, facts, old, check) -> Outcome:
        """Checks the written version, then adds the manifest row that makes it current."""
        if check is not None:
            check(self.spark.read.parquet(path))
        while True:
            head = self.log.head()
            there = self.latest(dataset, head)
            if (there.version if there else None) != (old.version if old else None):
                raise StaleError(f"{dataset}: {there.version if there else 'no version'} is current, "
                                 f"this save began with {old.version if old else 'none'}")
            now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            row = {"dataset": dataset, "version": version, "path": path, "rows": facts["rows"], "columns": len(df.columns),
                   "fingerprint": _text(facts), "previous_version": old.version if old else None,
                   "previous_rows": old.rows if old else None, "previous_fingerprint": old.fingerprint if old else None,
                   "info": info, "created_at": (old.created_at if old else now).isoformat(), "updated_at": now.isoformat()}
            if self.log.append(row, head):  # else another dataset was published meanwhile
                break
        return Outcome(dataset, "update" if old else "new", facts["rows"], _text(facts), path,
                       "published")
