"""Who works on which block: claims with a lease, kept as commits of a log.

A block is a period of a dataset. Its state is the newest entry that names it: claimed until a moment, done or
failed. A claim is one commit, made by one atomic step, so of two runs that both saw a block open one gets it;
the other looks again. What a stopped run had claimed is open again once its lease is over.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sinks.commits import CommitLog, put_if_absent

BOARD = ("at timestamp, run string, what string, until timestamp, "
         "blocks array<struct<dataset: string, period: string, method: string, rows: bigint, error: string>>")
STATES = ("claimed", "done", "failed")


@dataclass(frozen=True)
class Block:
    dataset: str
    period: str


@dataclass(frozen=True)
class Result:
    """What became of a claimed block."""

    block: Block
    method: str | None  # new, update or skip; None: failed
    rows: int = 0
    error: str | None = None


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Board:
    def __init__(self, spark: SparkSession, root: str, most_attempts: int = 3, now: Callable[[], dt.datetime] = utc_now,
                 put: Callable[[SparkSession, str, str], bool] = put_if_absent):
        self.spark, self.most_attempts, self.now = spark, most_attempts, now
        self.log = CommitLog(spark, root, BOARD, put=put)

    def states(self, upto: int | None = None) -> DataFrame:
        """(dataset, period, what, run, until, method, rows, error, attempts) of every block ever claimed."""
        what = F.when(F.col("what") == "claimed", "claimed").when(F.col("b.method").isNull(), "failed").otherwise("done")
        each = self.log.entries(upto).select("number", "run", "what", "until", F.explode("blocks").alias("b")).withColumn("what", what)
        newest = F.max_by(F.struct("what", "run", "until", "b.method", "b.rows", "b.error"), "number").alias("s")
        states = each.groupBy("b.dataset", "b.period").agg(newest, F.count_if(F.col("what") == "claimed").alias("attempts"))
        return states.select("dataset", "period", "s.*", "attempts")

    def open(self, plan: DataFrame, upto: int | None = None, run: str | None = None) -> DataFrame:
        """The blocks (dataset, period) of a plan that nobody has done or is at work on.

        A failed block is open until it was tried ``most_attempts`` times, but not for the run it failed in.
        """
        known = self.states(upto)
        over = (F.col("what") == "claimed") & (F.col("until") < F.lit(self.now()))
        again = (F.col("what") == "failed") & (F.col("attempts") < self.most_attempts) & (F.col("run") != F.lit(run or ""))
        shut = known.where(~(over | again)).select("dataset", "period")
        return plan.select("dataset", "period").distinct().join(shut, ["dataset", "period"], "left_anti")

    def claim(self, plan: DataFrame, run: str, most: int, lease: dt.timedelta) -> list[Block]:
        """Up to ``most`` open blocks, in order, which are this run's until the lease is over."""
        while True:
            head = self.log.head()
            found = self.open(plan, head, run).orderBy("dataset", "period").limit(most).collect()
            blocks = [Block(r["dataset"], r["period"]) for r in found]
            if not blocks or self._append("claimed", run, [Result(b, None) for b in blocks], head, self.now() + lease):
                return blocks

    def finish(self, run: str, results: Sequence[Result]) -> list[Result]:
        """Records what became of claimed blocks; returns those that were still this run's.

        A block whose lease was over and that another run has claimed since stays with that run.
        """
        while True:
            head = self.log.head()
            mine = {Block(r["dataset"], r["period"]) for r in self.states(head).where(
                (F.col("what") == "claimed") & (F.col("run") == run)).select("dataset", "period").collect()}
            kept = [r for r in results if r.block in mine]
            if not kept or self._append("finished", run, kept, head, None):
                return kept

    def _append(self, what: str, run: str, results: Sequence[Result], head: int, until) -> bool:
        return self.log.append({
            "at": self.now().isoformat(), "run": run, "what": what, "until": until.isoformat() if until else None,
            "blocks": [{"dataset": r.block.dataset, "period": r.block.period, "method": r.method, "rows": r.rows,
                        "error": r.error} for r in results]}, head)
