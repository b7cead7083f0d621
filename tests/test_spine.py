"""Spine scenarios: trade days, months, quarters, truncation, single days, bad input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import spine
from tallyloom.plans import backfill


@pytest.fixture(scope="module")
def calendar(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(500)]
    return spark.createDataFrame([(f"{d:%Y%m%d}", int(d.weekday() < 5)) for d in days],
                                 "cal_date string, is_open int")


def plan(spark, calendar, placeholder, start, end, lookback=100, multiplier=1.0, truncate=False,
         grain="DAILY", clip=False):
    request = spark.createDataFrame(
        [("d", grain, placeholder, start, end, lookback, float(multiplier), truncate)],
        "dataset string, grain string, placeholder string, start_date string, end_date string, "
        "lookback int, multiplier double, truncate boolean")
    rows = backfill.expand(request, calendar, clip).orderBy("block_index").collect()
    return [(r.param_start, r.param_end) for r in rows]


def firsts(pairs):
    return [a for a, _ in pairs]


def test_trade_days(spark, calendar):
    want = ["20250115", "20250114", "20250113", "20250110", "20250109", "20250108", "20250107"]
    assert firsts(plan(spark, calendar, "<TRADE_DATE>", "20250107", "20250115")) == want
    assert firsts(plan(spark, calendar, "<TRADE_DATE>", "20250107", "20250115", 3, 1, True)) == want[:3]
    assert firsts(plan(spark, calendar, "<TRADE_DATE>", "20250107", "20250115", 3, 2, True)) == want[:6]
    assert firsts(plan(spark, calendar, "<TRADE_DATE>", "20250107", "20250115", 5, 0, True)) == want[:1]


def test_single_days_and_calendar_edges(spark, calendar):
    assert firsts(plan(spark, calendar, "<TRADE_DATE>", "20250107", "20250107")) == ["20250107"]
    assert plan(spark, calendar, "<TRADE_DATE>", "20250111", "20250112") == []
    assert firsts(plan(spark, calendar, "<TRADE_DATE>", "20230101", "20240102")) == [
        "20240102", "20240101"]
    assert plan(spark, calendar, "<TRADE_DATE>", "20200101", "20200201") == []
    assert len(plan(spark, calendar, "<TRADE_DATE>", "202401", "202412")) == 262


def test_natural_days_and_six_digit_bounds(spark, calendar):
    got = firsts(plan(spark, calendar, "<NATURAL_DATE>", "202501", "202502"))
    assert got[0] == "20250228" and got[-1] == "20250101" and len(got) == 59


def test_months(spark, calendar):
    got = plan(spark, calendar, "<MONTHLY_DATE_RANGE>", "20240115", "20240310", grain="MONTHLY")
    assert got == [("20240301", "20240310"), ("20240201", "20240229"), ("20240101", "20240131")]
    cut = plan(spark, calendar, "<MONTHLY_DATE_RANGE>", "202401", "202503", 2, 3, True, "MONTHLY")
    assert len(cut) == 6 and cut[0] == ("20250301", "20250331")


def test_quarters(spark, calendar):
    got = firsts(plan(spark, calendar, "<QUARTERLY_DATE>", "20240401", "20241231", grain="QUARTERLY"))
    assert got == ["20241231", "20240930", "20240630", "20240331",
                   "20231231", "20230930", "20230630", "20230331"]
    clipped = firsts(plan(spark, calendar, "<QUARTERLY_DATE>", "20240401", "20241231",
                          grain="QUARTERLY", clip=True))
    assert clipped == ["20241231", "20240930", "20240630"]
    assert len(plan(spark, calendar, "<QUARTERLY_DATE>", "20240101", "20251231", 3, 2, True,
                    "QUARTERLY")) == 6


def test_unknown_and_bad(spark, calendar):
    assert plan(spark, calendar, "<NO_SUCH>", "20250107", "20250115") == [("<NO_SUCH>", "<NO_SUCH>")]
    assert plan(spark, calendar, "E", None, None, grain="SNAPSHOT") == [("E", "E")]
    with pytest.raises(Exception, match="yyyyMM"):
        plan(spark, calendar, "<NATURAL_DATE>", "2025", "20250115")
    assert len(plan(spark, calendar, "<TODAY>", "20250107", "20250115")) == 1


def test_missing_blocks(spark, calendar):
    request = spark.createDataFrame(
        [("d", "DAILY", "<NATURAL_DATE>", "20250101", "20250103", 1, 1.0, False)],
        "dataset string, grain string, placeholder string, start_date string, end_date string, "
        "lookback int, multiplier double, truncate boolean")
    landed = spark.createDataFrame([("d", "20250102"), ("e", "20250103")],
                                   "dataset string, period string")
    left = backfill.backfill_plan(request, calendar, landed)
    assert sorted(r.period for r in left.collect()) == ["20250101", "20250103"]
    assert backfill.backfill_plan(request, calendar, landed, force=True).count() == 3


def test_available_from(spark, calendar):
    df = spark.createDataFrame([("20240105",), ("20240106",), ("20231201",), ("20300101",), (None,)],
                               "a string").withColumn("ann", F.to_date("a", "yyyyMMdd"))
    def known(after):
        out = spine.available_from(df, calendar, "ann", "day", after).collect()
        return {r.a: str(r.day) if r.day else None for r in out}
    assert known(True) == {"20240105": "2024-01-08", "20240106": "2024-01-08",
                           "20231201": "2024-01-01", "20300101": None, None: None}
    assert known(False)["20240105"] == "2024-01-05"


def test_code_lists(spark, calendar):
    request = spark.createDataFrame(
        [("d", "SYMBOL", "<LISTED_SYMBOL>", None, None, 1, 1.0, False),
         ("e", "SYMBOL", "<DIGIT_SYMBOL>", None, None, 1, 1.0, False)],
        "dataset string, grain string, placeholder string, start_date string, end_date string, "
        "lookback int, multiplier double, truncate boolean")
    master = spark.createDataFrame([("600000.SH", "L"), ("000001.SZ", "D")],
                                   "ts_code string, list_status string")
    landed = spark.createDataFrame([("e", "000001")], "dataset string, period string")
    left = backfill.backfill_plan(request, calendar, landed, master=master)
    assert sorted((r.dataset, r.period) for r in left.collect()) == [("d", "SH600000"),
                                                                   ("e", "600000")]
