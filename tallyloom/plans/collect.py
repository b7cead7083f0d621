"""Saving extracts that already lie in a drop folder."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark import InheritableThread
from pyspark.sql import DataFrame

from tallyloom.plans.board import Block, Board, Result
from tallyloom.sinks.partitions import PartitionStore
from tallyloom.sinks.runlog import append_runs, run_rows
from tallyloom.sinks.snapshot import SnapshotStore

STATUS = {"skip": "SKIPPED", None: "FAILED"}  # any other method: SUCCESS


def side_by_side(jobs: Mapping[str, Callable[[], object]], together: int) -> dict[str, object]:
    """Runs jobs in threads, some at a time, each in the scheduler pool of its name.

    With ``spark.scheduler.mode=FAIR`` the pools share the executors; a small job then does not wait for a
    large one's tasks. What a job raises is its result.
    """
    done: dict[str, object] = {}
    waiting = list(jobs)

    def work() -> None:
        from pyspark import SparkContext
        while waiting:
            try:
                name = waiting.pop(0)
            except IndexError:
                return
            context = SparkContext._active_spark_context
            context.setLocalProperty("spark.scheduler.pool", name)
            try:
                done[name] = jobs[name]()
            except Exception as error:  # whatever went wrong belongs in the log
                done[name] = error
            finally:
                context.setLocalProperty("spark.scheduler.pool", None)

    threads = [InheritableThread(target=work) for _ in range(min(together, len(waiting)))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    return done


def collect(extracts: Mapping[str, DataFrame], store: SnapshotStore, source: str,
            log_path: str, shrink: str = "raise",
            second: Mapping[str, Callable[[], DataFrame]] | None = None,
            force: bool = False, together: int = 4) -> list[dict]:
    """Saves each extract if it changed and logs one run row per extract.

    Datasets are saved side by side. An extract that fails is logged and does not stop the rest.
    """
    def save(dataset: str, extract: DataFrame) -> dict:
        began, now = time.monotonic(), dt.datetime.now()
        old = store.latest(dataset)
        run = {"task_id": f"{source}.{dataset}", "source_name": source, "data_type": dataset,
               "previous_md5": old.fingerprint if old else None,
               "original_rows": old.rows if old else 0, "archive_path": old.path if old else None,
               "created_at": now, "updated_at": now}
        try:
            done = store.save(extract, dataset, info=source, shrink=shrink, force=force,
                              second=(second or {}).get(dataset))
            run |= {"data_md5": done.fingerprint, "data_rows": done.rows, "file_path": done.path,
                    "execution_status": STATUS.get(done.method, "SUCCESS")}
        except Exception as error:  # whatever went wrong belongs in the log
            run |= {"execution_status": "FAILED", "error_message": str(error).splitlines()[0]}
        return run | {"duration_ms": int((time.monotonic() - began) * 1000)}

    done = side_by_side({d: (lambda d=d, e=e: save(d, e)) for d, e in extracts.items()}, together)
    runs = [done[dataset] for dataset in extracts]
    append_runs(run_rows(store.spark, runs), log_path)
    return runs


def collect_blocks(plan: DataFrame, fetch: Callable[[str, Sequence[str]], DataFrame],
                   store_of: Callable[[str], PartitionStore], board: Board, log_path: str, source: str = "vendor",
                   run: str | None = None, batch: int = 100, lease: dt.timedelta = dt.timedelta(hours=1),
                   together: int = 4, shrink: str = "raise") -> list[Result]:
    """Works through a plan's open blocks until none is left, from plan to record.

    Blocks are claimed ``batch`` at a time. ``fetch(dataset, periods)`` gives the rows of a dataset's claimed
    periods, with the store's partition column (pages joined by ``merge_pages``); they are saved by partition,
    and every block gets its state on the board and a row in the run log. A period without rows, and all
    periods of a dataset whose fetch or save raises, have failed and are open for the next run. Another
    run of the same plan, at the same time or after this one was stopped, takes up only what is open; a
    block that two runs save after all (a lease was too short) is found unchanged by the second.
    """
    run = run or uuid.uuid4().hex[:12]
    finished: list[Result] = []

    def work(dataset: str, periods: list[str]) -> list[Result]:
        began = time.monotonic()
        try:
            saved = store_of(dataset).save(fetch(dataset, periods), info=run, shrink=shrink)
            found = {r["label"]: r for r in saved.partitions.collect()}
            results = [Result(Block(dataset, p), found[p]["method"], found[p]["rows"]) if p in found
                       else Result(Block(dataset, p), None, error="no rows") for p in periods]
        except Exception as error:  # whatever went wrong belongs on the board
            message = (str(error).splitlines() or [type(error).__name__])[0][:500]
            results = [Result(Block(dataset, p), None, error=message) for p in periods]
        kept = board.finish(run, results)
        spent, now = int((time.monotonic() - began) * 1000), dt.datetime.now()
        append_runs(run_rows(board.spark, [{
            "task_id": f"{source}.{dataset}.{r.block.period}", "source_name": source, "data_type": dataset,
            "duration_ms": spent, "data_rows": r.rows if r.method else None, "error_message": r.error,
            "execution_status": STATUS.get(r.method, "SUCCESS"), "created_at": now, "updated_at": now} for r in kept]), log_path)
        return kept

    while claimed := board.claim(plan, run, batch, lease):
        by_dataset: dict[str, list[str]] = {}
        for block in claimed:
            by_dataset.setdefault(block.dataset, []).append(block.period)
        done = side_by_side({d: (lambda d=d, p=p: work(d, p)) for d, p in by_dataset.items()}, together)
        for outcome in done.values():
            if isinstance(outcome, Exception):
                raise outcome
            finished += outcome
    return finished
