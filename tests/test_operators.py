import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import columns, derived, fill, filters, lookup, reshape
from tallyloom.plans.steps import cleaning_registry, run_steps


def test_empty_keys(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("  ",), ("A",)], "ts_code string")
    assert [r.ts_code for r in filters.nonempty_key(df).collect()] == ["  ", "A"]


@pytest.mark.parametrize("condition, kept", [
    ("==2", [2]), ("!=2", [1, None]), (">=2", [2]), ("<=1", [1]), (">1", [2]), ("<2", [1]),
    ("notna", [1, 2]), ("isna", [None])])
def test_conditions(spark, condition, kept):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    got = [r.v for r in filters.matching(df, "v", condition).collect()]
    assert sorted(got, key=str) == sorted(kept, key=str)


def test_literal_of_another_type(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    assert filters.matching(df, "v", "==x").count() == 0
    assert filters.matching(df, "v", "!=x").count() == 2


def test_odd_conditions(spark):
    df = spark.createDataFrame([(1,)], "v int")
    assert filters.matching(df, "absent", "==1") is df
    assert filters.matching(df, "v", "like 1", on_error="skip") is df
    with pytest.raises(ValueError):
        filters.matching(df, "v", "like 1")
    with pytest.raises(ValueError):
        filters.matching(df, "v", ">=x")


@pytest.mark.parametrize("kind", ["string", "int", "date"])
def test_listing_window(spark, kind):
    data = [("1.SH", "20200102", "20200102", None, True), ("1.SH", "20200101", "20200102", None, False),
            ("1.SH", "20200105", "20200102", "20200105", True),
            ("1.SH", "20200106", "20200102", "20200105", False),
            ("8.BJ", "20211114", "20200102", None, False), ("8.BJ", "20211115", "20200102", None, True),
            ("8.BJ", "20220101", "20220102", None, False), ("8.BJ", "20220101", None, None, False),
            ("1.SH", "20220101", None, None, False)]
    df = spark.createDataFrame(data, "ts_code string, trade_date string, list_date string, "
                                     "delist_date string, keep boolean")
    if kind != "string":
        def cast(c):
            return F.to_date(c, "yyyyMMdd") if kind == "date" else F.col(c).cast("int")
        df = df.withColumns({c: cast(c) for c in ("trade_date", "list_date", "delist_date")})
    kept = filters.within_listing(df)
    assert kept.count() == df.where("keep").count()
    assert kept.where("not keep").count() == 0
    assert filters.within_listing(df.drop("list_date")).count() == len(data)


def test_first_entities(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3), ("a", 4)], "k string, v int")
    assert sorted(r.v for r in filters.first_entities(df, "k", 2).collect()) == [1, 2, 4]
    assert filters.first_entities(df, "k", None) is df
    assert filters.first_entities(df, "k", 0) is df


def test_projections_and_renames(spark):
    df = spark.createDataFrame([(1, 2, 3)], "b int, `$amount` int, a int")
    assert columns.ordered(df, ["a", "$amount", "absent", "a"]).columns == ["a", "$amount"]
    assert columns.ordered(df, []).columns == df.columns
    assert columns.missing_fields(df, ["a", "x", "x"]) == ["x"]
    section = {"a": {"renamed_field": "alpha"}, "b": {}, "z": {"renamed_field": "y"}}
    assert columns.rename_section(df, section).columns == ["b", "$amount", "alpha"]
    fixed = spark.createDataFrame([(1, 2, 3)], "t int, t_fixed int, u int")
    assert columns.replace_by_fixed(fixed, ["t", "u"]).collect()[0].asDict() == {"t": 2, "u": 3}


def test_security_lookup(spark):
    master = spark.createDataFrame(
        [("000001.SZ", "000001", "L", "19910101", None), ("000009.SZ", "000001", "L", "19990101", None),
         ("600000.SH", "600000", "D", "19990101", "20200101")],
        "ts_code string, symbol string, list_status string, list_date string, delist_date string")
    df = spark.createDataFrame([("SZ000001", 1), ("600000.SH", 2), ("BJ1", 3), (None, 4)],
                               "code string, id int")
    got = {r.id: (r.ts_code, r.list_status) for r in lookup.add_security(df, master, "code").collect()}
    assert got == {1: ("000009.SZ", "L"), 2: ("600000.SH", "D"), 3: (None, None), 4: (None, None)}
    own = lookup.add_security(df.withColumnRenamed("code", "ts_code"), master, "ts_code")
    assert own.columns == ["id", "ts_code", "list_status", "list_date", "delist_date"]
    assert own.where("id = 2").first().ts_code == "600000.SH"


def test_code_remap(spark):
    mapping = spark.createDataFrame([("833943", "920943")], "old_code string, new_code string")
    data = [("833943.BJ", "920943.BJ"), ("833943", "920943"), ("SZ833943", "920943"),
            ("000001.SZ", "000001.SZ"), ("000001", "000001"), (None, None)]
    df = spark.createDataFrame(data, "code string, want string")
    got = lookup.remap_code(df, mapping, "code", "new")
    assert got.where(~F.col("new").eqNullSafe(F.col("want"))).count() == 0
    assert lookup.remap_code(df, mapping, "code").columns == df.columns


def test_left_fold_clashes(spark):
    a = spark.createDataFrame([("s", 1, 10.0)], "ts_code string, trade_date int, close double")
    b = spark.createDataFrame([("s", 1, 11.0, 2.0)],
                              "ts_code string, trade_date int, close double, pe double")
    assert lookup.left_fold(a, {"basic": b}).first().close == 10.0
    assert lookup.left_fold(a, {"basic": b}, clash="prefix").first().basic_close == 11.0


@pytest.mark.parametrize("forward", [True, False])
@pytest.mark.parametrize("partitioned", [True, False])
def test_fill_across_ranges(spark, forward, partitioned):
    """One entity with most rows: its gaps reach over several ranges."""
    rng = random.Random(1)
    data = [("HOT" if i % 3 else rng.choice("ABC"), i, float(i) if rng.random() < 0.02 else None)
            for i in range(3000)]
    df = spark.createDataFrame(data, "k string, o int, v double").repartition(5)
    by = ["k"] if partitioned else []
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.o: r.v for r in
               fill.fill_from_neighbours(df, ["v"], ["o"], by, forward).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    last, want = {}, {}
    for k, o, v in data if forward else reversed(data):
        key = k if partitioned else ""
        last[key] = v if v is not None else last.get(key)
        want[o] = last[key]
    assert got == want


def test_fill_constant(spark):
    df = spark.createDataFrame([(None, None)], "a double, b double")
    assert tuple(fill.fill_constant(df, 1.0).first()) == (1.0, 1.0)
    assert tuple(fill.fill_constant(df, 1.0, "a").first()) == (1.0, None)


def test_point_in_time(spark):
    df = spark.createDataFrame(
        [("600000.SH", 20240331, "20240430", "20240430", 1.0, None, "f", "1"),
         ("600000.SH", 20240630, "20240830", "20240830", 2.0, 3.0, "f", "1")],
        "ts_code string, end_date int, ann_date string, f_ann_date string, rev double, "
        "profit double, file_path string, comp_type string")
    long = reshape.to_point_in_time(df)
    got = sorted((r.symbol, r.period, str(r.datetime), r.field, r.value) for r in long.collect())
    assert got == [("sh600000", 202401, "2024-04-30", "rev_q", 1.0),
                   ("sh600000", 202402, "2024-08-30", "profit_q", 3.0),
                   ("sh600000", 202402, "2024-08-30", "rev_q", 2.0)]
    named = reshape.to_point_in_time(df, "annual", {"rev": "sales", "absent": "x"})
    assert {(r.period, r.field) for r in named.collect()} == {(2024, "sales_a")}


def test_unequal_lists_raise(spark):
    df = spark.createDataFrame([([1, 2], [1])], "a array<int>, b array<int>")
    with pytest.raises(Exception, match="differ in length"):
        reshape.explode_blocks(df, ["a", "b"]).collect()


def test_derived_gaps(spark):
    df = spark.createDataFrame(
        [("s", 2023, 1, 10.0), ("s", 2023, 2, 25.0), ("s", 2023, 4, 70.0), ("s", 2024, 1, 12.0),
         ("s", 2024, 2, None)], "k string, y int, q int, v double")
    single = {(r.y, r.q): r.sq for r in
              derived.single_quarter(df, "k", "y", "q", "v", "sq").collect()}
    assert single == {(2023, 1): 10.0, (2023, 2): 15.0, (2023, 4): None, (2024, 1): 12.0,
                      (2024, 2): None}
    yoy = {(r.y, r.q): r.g for r in derived.growth(df, "k", "y", "q", "v", "g", 4).collect()}
    assert yoy[(2024, 1)] == pytest.approx(0.2) and yoy[(2023, 1)] is None
    ttm = {(r.y, r.q): r.t for r in derived.trailing_year(df, "k", "y", "q", "v", "t").collect()}
    assert all(v is None for v in ttm.values()) and len(ttm) == 5
    whole = spark.createDataFrame([("s", 2023, q, float(q)) for q in (1, 2, 3, 4)],
                                  "k string, y int, q int, v double")
    got = derived.trailing_year(whole, "k", "y", "q", "v", "t").where("t is not null").collect()
    assert [(r.y, r.q, r.t) for r in got] == [(2023, 4, 10.0)]
    assert derived.trailing_coverage(whole.selectExpr("v as t"), "t").first().enough


def test_steps(spark):
    df = spark.createDataFrame([("2024-01-02", 1), ("2024-01-02", 1), (None, 2)],
                               "day string, id int")
    registry = cleaning_registry(row_order=["id"])
    steps = [{"function": "convert_date_format", "field_name": "day"},
             {"function": "no_such_step"},
             {"function": "drop_duplicates"},
             {"function": "rename_column", "old_name": "id", "new_name": "no"},
             {"function": "filter_data", "field_name": "day", "condition": "notna"}]
    assert [tuple(r) for r in run_steps(df, steps, registry).collect()] == [("20240102", 1)]
    broken = [{"function": "add_ts_code", "source_field": "day"}]
    with pytest.raises(ValueError):
        run_steps(df, broken, registry)
    assert run_steps(df, broken, registry, on_error="skip") is df
    filled = run_steps(df, [{"function": "fill_na", "field_name": "day", "method": "ffill"}],
                       registry)
    assert filled.where("day is null").count() == 0
