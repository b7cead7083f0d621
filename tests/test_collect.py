"""Templates, claims with leases, and collecting from plan to record."""

import datetime as dt
import json
import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.plans.backfill import CODE_WORDS
from tallyloom.plans.board import Block, Board, Result
from tallyloom.plans.collect import collect_blocks, side_by_side
from tallyloom.plans.templates import blocks_of
from tallyloom.session import scratch_path
from tallyloom.sinks import runlog
from tallyloom.sinks.commits import put_if_absent
from tallyloom.sinks.partitions import PartitionStore

HOLIDAYS = {"20240101", "20250101"}


def days(first, last):
    day, out = dt.datetime.strptime(first, "%Y%m%d").date(), []
    while day.strftime("%Y%m%d") <= last:
        out.append(day)
        day += dt.timedelta(1)
    return out


def trade_days(first, last):
    return [d.strftime("%Y%m%d") for d in days(first, last) if d.weekday() < 5 and d.strftime("%Y%m%d") not in HOLIDAYS][::-1]


@pytest.fixture(scope="module")
def calendar(spark):
    opened = set(trade_days("20240101", "20251231"))
    rows = [(d.strftime("%Y%m%d"), int(d.strftime("%Y%m%d") in opened)) for d in days("20240101", "20251231")]
    return spark.createDataFrame(rows, "cal_date string, is_open int")


@pytest.fixture
def expanded(spark, calendar):
    def run(params, start="20250107", end="20250115", lookback=0, multiplier=1.0, truncate=False, master=None):
        text = params if isinstance(params, str) or params is None else json.dumps(params)
        requests = spark.createDataFrame([("r", text, start, end, lookback, multiplier, truncate)],
                                         "req_id string, params string, start_date string, end_date string, lookback int, "
                                         "multiplier double, truncate boolean")
        rows = blocks_of(requests, calendar, master).orderBy("block_index").collect()
        if rows[0]["error"]:
            return rows[0]["error"]
        assert [r["block_index"] for r in rows] == list(range(len(rows))) and {r["n_blocks"] for r in rows} == {len(rows)}
        return [json.loads(r["params"]) for r in rows]
    return run


# The scenarios of requests: word, bounds, periods and multiplier, the values that result.
QUARTERS = ["20251231", "20250930", "20250630", "20250331", "20241231", "20240930", "20240630", "20240331"]
SCENARIOS = [
    ("<TRADE_DATE>", "20250107", "20250115", 5, 1.0, trade_days("20250107", "20250115")[:5]),
    ("<QUARTERLY_DATE>", "20240101", "20251231", 3, 2.0, QUARTERS[:6]),
    ("<TRADE_DATE>", "20240101", "20241231", 50, 3.0, trade_days("20240101", "20241231")[:150]),
    ("<TRADE_DATE>", "20250107", "20250107", 1, 0.0, ["20250107"]),
    ("<TRADE_DATE>", "20250101", "20250101", 1, 0.0, []),
    ("<INVALID_PLACEHOLDER>", "20250101", "20250131", 1, 0.0, "<INVALID_PLACEHOLDER>"),
    ("<TRADE_DATE>", "20250107", "20250110", 3, 2.0, trade_days("20250107", "20250110")),
]


@pytest.mark.parametrize("word, start, end, lookback, multiplier, values", SCENARIOS)
def test_scenarios(expanded, word, start, end, lookback, multiplier, values):
    got = expanded({"symbol": "AAPL", "day": word, "limit": 100}, start, end, lookback, multiplier, True)
    wanted = values if isinstance(values, list) and values else [values]
    assert got == [{"symbol": "AAPL", "day": v, "limit": 100} for v in wanted]


@pytest.mark.parametrize("start, end, lookback, multiplier, months", [
    ("202401", "202503", 2, 3.0, ["202503", "202502", "202501", "202412", "202411", "202410"]),
    ("202501", "202502", 1, 1.0, ["202502"])])
def test_month_ranges_replace_their_key(expanded, start, end, lookback, multiplier, months):
    got = expanded({"symbol": "T", "span": {"date_range": "<MONTHLY_DATE_RANGE>", "freq": "M", "end_date": "old"}},
                   start, end, lookback, multiplier, True)
    assert [g["span"]["start_date"][:6] for g in got] == months
    for g in got:
        last = (dt.date(int(g["span"]["start_date"][:4]), int(g["span"]["start_date"][4:6]), 28) + dt.timedelta(4)).replace(day=1) - dt.timedelta(1)
        assert g == {"symbol": "T", "span": {"freq": "M", "start_date": g["span"]["start_date"], "end_date": last.strftime("%Y%m%d")}}


def test_bad_dates_are_refused(expanded):
    with pytest.raises(PySparkException, match="yyyyMM"):
        expanded({"day": "<TRADE_DATE>"}, "2025", "20250131")


def test_lists_at_any_depth_run_side_by_side(expanded):
    deep = {"a": {"b": {"c": {"d": {"e": [1, 2.5, None]}}}}, "l": ["x", {"y": [7, 8]}, "z\"\\"], "odd key \"": {"": [True, False, {}]}}
    assert expanded(deep) == [
        {"a": {"b": {"c": {"d": {"e": 1}}}}, "l": "x", "odd key \"": {"": True}},
        {"a": {"b": {"c": {"d": {"e": 2.5}}}}, "l": {"y": [7, 8]}, "odd key \"": {"": False}},
        {"a": {"b": {"c": {"d": {"e": None}}}}, "l": "z\"\\", "odd key \"": {"": {}}}]
    assert expanded({"a": [1, 2], "b": {"c": [1, 2, 3]}}) == "list_lengths_differ"
    days_ = trade_days("20250107", "20250109")
    assert expanded({"a": ["u", "v", "w"], "b": {"c": "<TRADE_DATE>"}}, end="20250109") == [
        {"a": x, "b": {"c": d}} for x, d in zip("uvw", days_)]


def test_templates_without_lists(expanded):
    assert expanded({}) == expanded([]) == expanded(None) == [{}]
    assert expanded({"a": [], "b": {}, "c": None, "d": "<"}) == [{"a": [], "b": {}, "c": None, "d": "<"}]
    today = expanded({"day": "<TODAY>", "list": ["a", "b"]})
    assert [t["list"] for t in today] == ["a", "b"] and all(len(t["day"]) == 8 for t in today)
    for bad in ('[1, 2]', '"text"', '{"a": ', "7"):
        with pytest.raises(PySparkException):
            expanded(bad)


def test_code_lists(spark, expanded):
    master = spark.createDataFrame([("600519.SH", "L"), ("000001.SZ", "L"), ("000013.SZ", "D"), ("odd", "L")],
                                   "ts_code string, list_status string")
    got = {w: [b["s"]["code"] for b in expanded({"s": {"code": w}}, master=master)] for w in CODE_WORDS}
    assert got == {CODE_WORDS[0]: ["SH600519", "SZ000001"], CODE_WORDS[1]: ["SZ000013"],
                   CODE_WORDS[2]: ["000001.SZ", "000013.SZ", "600519.SH", "odd"], CODE_WORDS[3]: ["000001", "000013", "600519"]}


# --- claims --------------------------------------------------------------------------------

class Clock:
    def __init__(self):
        self.time = dt.datetime(2024, 1, 1)

    def __call__(self):
        return self.time


@pytest.fixture
def plan(spark):
    return spark.createDataFrame([("a", f"p{i}") for i in range(6)] + [("b", "p0")], "dataset string, period string")


HOUR = dt.timedelta(hours=1)


def test_a_block_is_claimed_once(spark, plan):
    root, clock = scratch_path(spark, "board"), Clock()
    one, two = Board(spark, root, now=clock), Board(spark, root, now=clock)
    first, second = one.claim(plan, "one", 4, HOUR), two.claim(plan, "two", 10, HOUR)
    assert len(first) == 4 and len(second) == 3 and not set(first) & set(second)
    assert one.claim(plan, "three", 10, HOUR) == []
    one.finish("one", [Result(first[0], "new", 5), Result(first[1], None, error="x")])
    clock.time += 2 * HOUR  # what was only claimed is open again, what failed too
    assert {Block(r["dataset"], r["period"]) for r in two.open(plan).collect()} == {*first[1:], *second}
    assert first[1] not in one.claim(plan, "one", 10, HOUR)  # not for the run it failed in


def test_two_runs_that_see_the_same_open_blocks(spark, plan):
    root = scratch_path(spark, "board")
    other, taken = Board(spark, root), []

    def put(session, path, text):
        if not taken:
            taken.extend(other.claim(plan, "other", 5, HOUR))
        return put_if_absent(session, path, text)
    mine = Board(spark, root, put=put).claim(plan, "mine", 5, HOUR)
    assert len(taken) == 5 and len(mine) == 2 and not set(taken) & set(mine)


def test_results_after_the_lease_belong_to_the_new_run(spark, plan):
    clock = Clock()
    board = Board(spark, scratch_path(spark, "board"), now=clock)
    late = board.claim(plan, "slow", 2, HOUR)
    clock.time += 2 * HOUR
    board.claim(plan, "quick", 1, HOUR)
    kept = board.finish("slow", [Result(b, "new", 1) for b in late])
    assert [r.block for r in kept] == late[1:]
    states = {(r["dataset"], r["period"]): (r["what"], r["run"], r["attempts"]) for r in board.states().collect()}
    assert states[("a", "p0")] == ("claimed", "quick", 2) and states[("a", "p1")] == ("done", "slow", 1)


def test_blocks_that_keep_failing_are_given_up(spark, plan):
    board = Board(spark, scratch_path(spark, "board"), most_attempts=2)
    for run in ("one", "two"):
        claimed = board.claim(plan.where("dataset = 'b'"), run, 9, HOUR)
        board.finish(run, [Result(b, None, error="down") for b in claimed])
    assert board.claim(plan.where("dataset = 'b'"), "three", 9, HOUR) == []


# --- collecting ----------------------------------------------------------------------------

ROWS = [(i, f"v{i}", f"p{i % 6}") for i in range(60)]


def test_a_stopped_job_ends_with_each_block_saved_once(spark, plan):
    root = scratch_path(spark, "collect")
    rows = spark.createDataFrame(ROWS, "k long, v string, p string")
    board, log, asked = Board(spark, f"{root}/board"), f"{root}/runs", []

    def store_of(dataset):
        return PartitionStore(spark, f"{root}/{dataset}", "p", ["k"])

    def fetch(dataset, periods):
        asked.append((dataset, tuple(periods)))
        if len(asked) == 3:
            raise KeyboardInterrupt  # the job is stopped, nothing is recorded
        return rows.where(F.col("p").isin(list(periods)))

    class Stopped(Exception):
        pass

    def stopping(dataset, periods):
        try:
            return fetch(dataset, periods)
        except KeyboardInterrupt:
            raise SystemExit from None
    clock = Clock()
    board.now = clock
    collect_first = threading.Thread(target=lambda: collect_blocks(plan, stopping, store_of, board, log, run="first", batch=2))
    hook, threading.excepthook = threading.excepthook, lambda *a: None
    collect_first.start()
    collect_first.join()
    threading.excepthook = hook
    before = {(r["dataset"], r["period"]) for r in board.states().where("what = 'done'").collect()}
    assert 0 < len(before) < 7
    clock.time += 2 * HOUR
    collect_blocks(plan, fetch, store_of, board, log, run="second", batch=3)
    assert {r["what"] for r in board.states().collect()} == {"done"} and board.states().count() == 7
    assert store_of("a").read().count() == 60 and store_of("b").read().count() == 10
    logged = [r["task_id"] for r in spark.read.parquet(log).collect()]
    assert len(logged) == len(set(logged)) == 7  # each block has one record
    taken = len(asked)
    assert collect_blocks(plan, fetch, store_of, board, log) == [] and len(asked) == taken  # nothing is planned
    last = runlog.latest_runs(spark.read.parquet(log))
    assert {r["execution_status"] for r in last.collect()} == {"SUCCESS"}


def test_unchanged_and_missing_periods(spark, plan):
    root = scratch_path(spark, "collect")
    rows = spark.createDataFrame([r for r in ROWS if r[2] != "p5"], "k long, v string, p string")
    store = PartitionStore(spark, f"{root}/s", "p", ["k"])
    store.save(rows.where("p = 'p1'"))
    done = collect_blocks(plan.where("dataset = 'a'"), lambda d, p: rows.where(F.col("p").isin(p)), lambda d: store,
                          Board(spark, f"{root}/board"), f"{root}/runs")
    assert {(r.block.period, r.method, r.error) for r in done} == {
        *[(f"p{i}", "new", None) for i in (0, 2, 3, 4)], ("p1", "skip", None), ("p5", None, "no rows")}


def test_jobs_run_side_by_side(spark):
    gate = threading.Barrier(3, timeout=30)

    def fails():
        gate.wait()
        raise ValueError("x")
    done = side_by_side({"a": gate.wait, "b": fails, "c": gate.wait}, 3)
    assert isinstance(done["b"], ValueError) and {done["a"], done["c"]} <= {0, 1, 2}
    assert side_by_side({}, 3) == {}
