import pytest
from pyspark.sql import functions as F

from tallyloom.contracts import field_names
from tallyloom.functions import amounts, codes, dates


def values(spark, schema, data, *columns):
    df = spark.createDataFrame(data, schema)
    return [tuple(r) for r in df.select(*columns).collect()]


def test_date_text_forms(spark):
    texts = ["2008-06-24T00:00:00.000Z", "20230426 00:00:00", "2025-08-26 00:00:00", "20230426",
             " 2023-04-26 ", None, "n/a"]
    got = values(spark, "d string", [(t,) for t in texts], dates.compact_date_text(F.col("d")))
    assert [g[0] for g in got] == ["20080624", "20230426", "20250826", "20230426", "20230426",
                                   None, "n/a"]


def test_date_column_types(spark):
    df = spark.sql("select date'2020-01-31' as d, timestamp'2020-02-01 10:00:00' as t, 20200301 as i")
    out = dates.normalise_date(dates.normalise_date(df, "d"), "t").first()
    assert (out.d, out.t) == ("20200131", "20200201")
    days = df.select(*[dates.as_day(df, c).cast("string") for c in df.columns]).first()
    assert tuple(days) == ("2020-01-31", "2020-02-01", "2020-03-01")


@pytest.mark.parametrize("text, day", [
    ("20240229", "2024-02-29"), ("20230229", None), ("19000229", None), ("20000229", "2000-02-29"),
    ("20240431", None), ("20241301", None), ("20240100", None), ("00000101", None), ("2024", None),
    ("99991231", "9999-12-31"), ("20240101x", None), ("", None), (None, None), ("-20240101", None)])
def test_compact_dates(spark, text, day):
    parsed = dates.parse_compact(F.col("t")).cast("string")
    assert values(spark, "t string", [(text,)], parsed) == [(day,)]


def test_fiscal_period(spark):
    data = [(20240331,), (20240630,), (20241231,), (None,)]
    got = values(spark, "d int", data, dates.fiscal_period(F.col("d")),
                 dates.fiscal_period(F.col("d"), "annual"))
    assert got == [(202401, 2024), (202402, 2024), (202404, 2024), (None, None)]


@pytest.mark.parametrize("path, label, grain, quarter_end", [
    ("s/m/202401/05/data.parquet", "20240105", "daily", None),
    ("s/m/202401/data.parquet", "202401", "monthly", None),
    ("s/m/2024Q3/data.parquet", "2024Q3", "quarterly", "20240930"),
    ("s/m/2024Q7/data.parquet", None, None, "20241231"),
    ("s/m/2024/data.parquet", "2024", "yearly", None),
    ("s/m/data.parquet", None, None, None),
])
def test_period_in_path(spark, path, label, grain, quarter_end):
    found = dates.path_period(F.col("p"))
    got = values(spark, "p string", [(path,)], found, dates.period_grain(found),
                 dates.quarter_end_from_path(F.col("p")))
    assert got == [(label, grain, quarter_end)]


@pytest.mark.parametrize("label, start, end", [
    ("20240229", "2024-02-29", "2024-02-29"), ("202402", "2024-02-01", "2024-02-29"),
    ("2023Q4", "2023-10-01", "2023-12-31"), ("2024", "2024-01-01", "2024-12-31"),
    ("202413", None, None), ("600519", None, None), (None, None, None)])
def test_period_bounds(spark, label, start, end):
    first = dates.period_start(F.col("l"))
    got = values(spark, "l string", [(label,)], first.cast("string"),
                 dates.period_end(F.col("l"), first).cast("string"))
    assert got == [(start, end)]


def test_bounds_of_requests(spark):
    got = values(spark, "a string, b string", [("202402", "202402"), ("20240115", "20241231")],
                 dates.bound_start(F.col("a")).cast("string"),
                 dates.bound_end(F.col("b")).cast("string"))
    assert got == [("2024-02-01", "2024-02-29"), ("2024-01-15", "2024-12-31")]
    with pytest.raises(Exception, match="yyyyMM or yyyyMMdd"):
        values(spark, "a string", [("2024",)], dates.bound_start(F.col("a")))


def test_storage_date_prefers_direct_parameters(spark):
    df = spark.createDataFrame(
        [("20240101", None, "DAILY"), (None, "20240515", "QUARTERLY"), (None, "20240515", "MONTHLY"),
         (None, "20240515", "daily"), (None, "20241105", "QUARTERLY"), (None, None, "DAILY")],
        "trade_date string, start_date string, grain string")
    got = [r[0] for r in df.select(dates.storage_date(df.columns, F.col("grain"))).collect()]
    assert got == ["20240101", "20240630", "202405", "20240515", "20241231", None]


def test_code_formats(spark):
    data = [("600000.SH",), ("SZ000001",), ("BJ830001",), (" 000001 ",), (None,), ("000001.SZ.X",)]
    got = values(spark, "c string", data, codes.code_digits(F.col("c")))
    assert [g[0] for g in got] == ["600000", "000001", "BJ830001", "000001", None, "000001"]
    assert values(spark, "c string", [("600000.SH",)], codes.to_feed_code(F.col("c")),
                  codes.to_feed_code(F.col("c"), upper=True),
                  codes.from_feed_code(F.lit("SH600000")), codes.exchange_first(F.col("c")),
                  codes.digits_only(F.col("c"))) == [
        ("sh600000", "SH600000", "600000.SH", "SH600000", "600000")]


def test_bad_code_stops_or_gives_null(spark):
    assert values(spark, "c string", [("X",)], codes.to_feed_code(F.col("c"), on_invalid="null")
                  ) == [(None,)]
    for bad in ("600000.XX", "60000.SH", None):
        with pytest.raises(Exception, match="not a vendor code"):
            values(spark, "c string", [(bad,)], codes.to_feed_code(F.col("c")))


def test_amounts(spark):
    data = [(None, None, None), (1.0, None, 2.0), (5.0, 3.0, None)]
    total = amounts.signed_row_sum([(F.col("a"), False), (F.col("b"), True), (F.col("c"), False)])
    assert values(spark, "a double, b double, c double", data, total) == [(None,), (3.0,), (2.0,)]
    fixed = amounts.sign_by_date(F.col("a"), F.col("d"))
    assert values(spark, "a double, d string",
                  [(1.0, "20190630"), (1.0, "20190629"), (1.0, None), (None, "20200101")],
                  fixed) == [(1.0,), (-1.0,), (-1.0,), (None,)]
    fallback = amounts.fallback_total(F.col("t"), F.col("a"), F.col("b"))
    assert values(spark, "t double, a double, b double",
                  [(None, 1.0, 2.0), (9.0, 1.0, 2.0), (None, 1.0, None)],
                  fallback) == [(3.0,), (9.0,), (None,)]
    assert values(spark, "t string", [("1.5",), ("x",), (None,)],
                  amounts.lenient_number(F.col("t"))) == [(1.5,), (None,), (None,)]


def test_field_suffixes():
    assert field_names("revenue") == {
        "sc": "revenue_sc", "sq": "revenue_sq", "ttm": "revenue_ttm", "yoy": "revenue_yoy",
        "qoq": "revenue_qoq"}
