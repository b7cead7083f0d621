"""Record resolution against straightforward row loops, with null, tie and hot-key cases."""

import random
from collections import Counter, defaultdict

import pytest

from tallyloom.operators import resolve
from tallyloom.quality.gates import DuplicateKeyError, require_unique

SCHEMA = ("ts_code string, end_date int, f_ann_date int, ann_date string, update_flag string, "
          "id int")
KEYS = ["ts_code", "end_date", "f_ann_date"]


def statements(n=600, hot=0.33, seed=3):
    rng, rows = random.Random(seed), []
    for i in range(n):
        code = "HOT" if rng.random() < hot else rng.choice(["A", "B", "C", "D", None])
        day = 1 if code == "HOT" else rng.randrange(20)
        rows.append((code, 20240331 if code == "HOT" else rng.choice([20240331, None, 20240630]),
                     day, rng.choice(["20240401", "20240402", None]),
                     rng.choice(["0", "1", "1", "x"]), i))
    return rows


def number(text):
    return float(text) if text in ("0", "1") else None


def expected_flags(rows, zero_one=True, one_one=True):
    groups = defaultdict(list)
    for r in rows:
        groups[r[:3]].append(r)
    kept = []
    for key, members in groups.items():
        flags = [number(m[4]) for m in members]
        pair = len(members) == 2 and None not in key
        if zero_one and pair and sorted(flags, key=str) == [0.0, 1.0]:
            kept += [m for m in members if m[4] == "1"]
        elif one_one and pair and flags == [1.0, 1.0]:
            last = max((m[3] for m in members if m[3]), default=None)
            kept += [m for m in members if m[3] is not None and m[3] == last]
        else:
            kept += members
    return sorted(kept, key=repr)


@pytest.mark.parametrize("operator, zero_one, one_one", [
    (resolve.resolve_01, True, False), (resolve.resolve_11, False, True),
    (resolve.resolve_flags, True, True)])
def test_flag_pairs(spark, rows, operator, zero_one, one_one):
    data = statements()
    df = spark.createDataFrame(data, SCHEMA)
    want = expected_flags(data, zero_one, one_one)
    assert rows(operator(df)) == want
    assert len(want) < len(data)
    assert rows(operator(operator(df))) == rows(operator(df))


def test_flag_steps_do_not_depend_on_order(spark, rows):
    df = spark.createDataFrame(statements(seed=5), SCHEMA)
    together = rows(resolve.resolve_flags(df))
    assert rows(resolve.resolve_11(resolve.resolve_01(df))) == together
    assert rows(resolve.resolve_01(resolve.resolve_11(df))) == together


def test_keys_follow_the_columns():
    assert resolve.statement_keys(["f_ann_date", "ann_date"])[-1] == "f_ann_date"
    assert resolve.statement_keys(["ann_date"])[-1] == "ann_date"
    assert resolve.statement_keys([]) == ["ts_code", "end_date"]


def test_hot_pairs_are_split_in_the_join(spark):
    """With no broadcast, the hot key's rows are read by several join tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = spark.range(0, 60000, 1, 8).selectExpr(
            "case when id % 3 = 0 then 'HOT' else cast(id div 2 as string) end as ts_code",
            "20240331 as end_date", "1 as f_ann_date", "'20240401' as ann_date",
            "cast(id % 2 as string) as update_flag", "cast(id as int) as id")
        done = resolve.resolve_flags(df)
        kept = done.collect()
        assert "SortMergeJoin(skew=true)" in done._jdf.queryExecution().executedPlan().toString()
        assert Counter(r.ts_code for r in kept)["HOT"] == 20000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_dividends(spark, rows):
    schema = "ts_code string, end_date int, ann_date int, imp_ann_date string, cash_div_tax double, id int"
    data = [
        ("A", 1, 1, "20240101", 1.00, 1), ("A", 1, 1, "20240201", 1.05, 2),     # latest wins
        ("B", 1, 1, "20240101", 1.00, 3), ("B", 1, 1, "20240201", 1.50, 4),     # too far apart
        ("C", 1, 1, None, 1.00, 5), ("C", 1, 1, "20240101", 1.00, 6),           # null day is last
        ("D", 1, 1, "20240101", 1.00, 8), ("D", 1, 1, "20240101", 1.00, 7),     # tie: smaller id
        ("E", 1, None, "20240101", 1.0, 9), ("E", 1, None, "20240201", 1.0, 10),  # null key: kept
        ("F", 1, 1, "20240101", None, 11), ("F", 1, 1, "20240102", 3.0, 12),    # one amount only
        ("G", 1, 1, "20240101", 0.0, 13), ("G", 1, 1, "20240102", -5.0, 14),    # no positive max
        ("H", 1, 1, "20240101", 1.0, 15),
    ]
    df = spark.createDataFrame(data, schema)
    got = resolve.resolve_dividends(df, tie_break=["id"])
    assert sorted(r.id for r in got.collect()) == [2, 3, 4, 6, 7, 9, 10, 12, 14, 15]
    assert got.columns == df.columns
    assert rows(resolve.resolve_dividends(df.drop("imp_ann_date"))) == rows(df.drop("imp_ann_date"))


def test_dividends_are_read_twice_and_grouped_once(spark, tmp_path):
    data = [("A", 1, 1, "20240101", 1.0, 1), ("A", 1, 1, "20240201", 5.0, 2), ("B", 1, None, "20240101", 1.0, 3)]
    spark.createDataFrame(data, "ts_code string, end_date int, ann_date int, imp_ann_date string, "
                                "cash_div_tax double, id int").write.parquet(str(tmp_path / "d"))
    plan = resolve.resolve_dividends(spark.read.parquet(str(tmp_path / "d")), tie_break=["id"])
    assert sorted(r.id for r in plan.collect()) == [1, 2, 3]
    final = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("Scan parquet") == 2


def test_distinct_on(spark, rows):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), ("x", 3, "c"), ("x", 3, "d")],
                               "k string, o int, v string")
    assert rows(resolve.distinct_on(df, ["k"], ["o"])) == sorted(
        [(None, 1, "a"), ("x", 3, "c")], key=repr)
    assert resolve.distinct_on(df, ["absent"], ["o"]) is df
    assert resolve.distinct_on(df.union(df), None, []).count() == 4


def test_repeated_rows_count_null_keys_as_equal(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), ("x", 3)], "k string, id int")
    assert rows(resolve.repeated_rows(df, ["k"])) == sorted([(None, 1), (None, 2)], key=repr)


def test_uniqueness_gate(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, id int")
    require_unique(df, ["k", "id"])
    with pytest.raises(DuplicateKeyError, match="2 rows share a key of k"):
        require_unique(df, ["k"], str(tmp_path), "run1")
    assert spark.read.parquet(f"{tmp_path}/rejects/run1").count() == 2


def test_strategies(spark):
    df = spark.createDataFrame(
        [("s", "0", "20240105", "2"), ("s", "1", "20240103", "2"), ("s", "1", "20240104", "3"),
         ("s", None, "20240101", "1")],
        "symbol string, update_flag string, ann_date string, report_type string")
    def pick(name):
        row = resolve.dedupe_by_strategy(df, ["symbol"], name).first()
        return row.update_flag, row.ann_date
    assert pick("keep_latest_update") == ("1", "20240104")
    assert pick("keep_earliest_ann") == (None, "20240101")
    assert pick("keep_official_report") == (None, "20240101")
    with pytest.raises(ValueError):
        pick("other")


def test_key_sets_of_another_number_type(spark, rows):
    from tallyloom.operators.keyed import rows_with_key, rows_without_key
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    keyset = spark.createDataFrame([(1,), (None,)], "k bigint")
    assert rows(rows_with_key(df, keyset, ["k"])) == [(1, "a")]
    assert rows(rows_with_key(df, keyset, ["k"], null_safe=True), "v") == [("a",), ("c",)]
    assert rows(rows_without_key(df, keyset, ["k"]), "v") == [("b",), ("c",)]
