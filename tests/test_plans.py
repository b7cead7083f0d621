"""What no plan may hold: nested loops, Python, gathered groups, rows of a key in one task."""

import pytest
from conftest import SF_DIR

from catalog import QUERIES

# These hold a window on purpose: over one range and entity, or in the view they read, which sums
# four quarters of a year.
WINDOWS_ALLOWED = {"fill_forward", "fill_back", "fill_per_code", "single_quarter"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "MapInPandas", "collect_list", "collect_set")


# Lists of bounded length: a number per version that changed a row, the keys of one map, the
# files of one entity.
LISTS_ALLOWED = {"validity", "version_as_of", "template_nested", "feed_order"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    lists = ("collect_list",) if name in LISTS_ALLOWED else ()
    assert not [word for word in FORBIDDEN if word in plan and word not in lists]
    if name not in WINDOWS_ALLOWED:
        assert "Window [" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["implemented_only"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan
    schema = plan.split("ReadSchema: struct<", 1)[1].split(">", 1)[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "o_orderkey", "o_custkey", "o_orderstatus"}
