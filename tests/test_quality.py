import pytest
from pyspark.sql import functions as F

from tallyloom.quality import reconcile as rec
from tallyloom.quality import rules
from tallyloom.sinks.writers import write_audit_report


def statuses(results):
    return {r.rule_id: r.status for r in results.collect()}


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", 1, "20240501", "20240331", 1.0), ("b", 2, "20240501", "20240331", None),
         ("c", 3, None, "20240331", 2.0)],
        "symbol string, n int, ann_date string, period_end string, v double")


def test_clean_table_passes(table):
    got = statuses(rules.audit(table, ["symbol"], {"v": "float", "n": "int", "symbol": "str"}))
    assert got == {r: "PASS" for r in rules.RULES}


def test_failures(spark, table):
    bad = table.union(table.limit(1)).withColumn("gone", F.lit(None).cast("double")).withColumn(
        "period_end", F.lit("20240601"))
    got = statuses(rules.audit(bad, ["symbol"], {"v": "str"}, required=["x"]))
    assert got == {"DQ001": "FAIL", "DQ002": "FAIL", "DQ003": "PASS", "DQ004": "FAIL",
                   "SC001": "FAIL", "SC002": "FAIL", "PIT001": "FAIL"}


def test_skips_and_errors(spark, table, tmp_path):
    plain = table.select("symbol")
    got = statuses(rules.audit(plain, []))
    assert (got["DQ002"], got["SC002"], got["PIT001"]) == ("SKIP", "SKIP", "SKIP")
    got = statuses(rules.audit(plain, ["absent"]))
    assert (got["DQ002"], got["SC002"], got["SC001"]) == ("SKIP", "FAIL", "FAIL")
    odd = table.withColumn("ann_date", F.lit("soon"))
    assert statuses(rules.audit(odd, ["symbol"]))["PIT001"] == "ERROR"
    custom = [
        rules.CustomRule("C1", "rows", "data_quality", "INFO", lambda df: df.agg(
            F.when(F.count("*") > 2, "PASS").otherwise("FAIL").alias("status"),
            F.lit("m").alias("message"))),
        rules.CustomRule("C2", "broken", "data_quality", "INFO", lambda df: df.select("nothing")),
        rules.CustomRule("C3", "homeless", "elsewhere", "INFO", lambda df: df),
    ]
    results = rules.audit(table, ["symbol"], custom=custom, disabled=["DQ003"])
    got = statuses(results)
    assert (got["C1"], got["C2"], got["C3"]) == ("PASS", "ERROR", "ERROR") and "DQ003" not in got
    verdict = rules.verdict(results)
    assert not verdict.first().has_critical_issues
    write_audit_report(results, verdict, str(tmp_path / "report"))
    assert spark.read.json(f"{tmp_path}/report/results").count() == len(got)


def test_outliers_need_spread(spark):
    df = spark.createDataFrame([(1.0, 5.0, i) for i in range(99)] + [(1000.0, 5.0, 99)],
                               "v double, flat double, i int")
    got = {r.column_name: r.n_outliers for r in rules.outlier_profile(df).collect()}
    assert got == {"v": 1, "i": 0}


def test_relationships(spark):
    section = {
        "total": {"relationship": "1", "report_item": "t"},
        "second_total": {"relationship": "1", "report_item": "later"},
        "a": {"relationship": "1_1;2_1"}, "b": {"relationship": " -1_1 "},
        "sub": {"relationship": "2_;1_1"}, "deep": {"relationship": "1_1_2"},
        "x": {"relationship": "9"}, "y": {"relationship": "8_1"}, "z": {"relationship": "p_1"},
        "none": {},
    }
    groups = {g.group_id: g for g in rec.groups_from_section(section, spark)}
    assert set(groups) == {"1", "2"}
    assert groups["1"].total == "total" and groups["1"].name == "t"
    assert groups["1"].components == (("a", False), ("b", True), ("sub", False))
    assert groups["2"].total == "sub" and groups["2"].components == (("a", False),)


def test_reconcile(spark):
    groups = [rec.Group("1", "ok", "t", (("a", False), ("b", True), ("absent", False))),
              rec.Group("2", "bad", "u", (("a", False),)),
              rec.Group("3", "no total", "absent", (("a", False),)),
              rec.Group("4", "no rows", "n", (("a", False),))]
    rows = [(10.0, 4.0, 6.0, 90000.0, None)] * 9 + [(None, None, 1.0, None, None)]
    df = spark.createDataFrame(rows, "a double, b double, t double, u double, n double")
    got = {r.group_id: r for r in rec.reconcile(df, groups).collect()}
    assert set(got) == {"1", "2"}
    assert got["1"].passed and got["1"].valid_records == 9 and got["1"].fields_total == 3
    assert not got["2"].passed and got["2"].large_diff_percentage == 100.0
    with pytest.raises(rec.ReconcileError, match="group 2"):
        rec.require_reconciled(rec.reconcile(df, groups))
    rec.require_reconciled(rec.reconcile(df, groups, overrides={"2": 100.0}))
