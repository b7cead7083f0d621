"""Values carried along ranges, fills and as-of joins, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import asof, carry, fill


@pytest.fixture(params=[(5, 3), (40, 1)])
def small_pieces(spark, request):
    """Many ranges, and Arrow batches of a few rows."""
    ranges, batch = request.param
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(ranges),
                "spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plain_fill(data, keys, forward=True):
    last, out = {}, {}
    for row in data if forward else reversed(data):
        entity = tuple(row[:keys])
        seen = last.setdefault(entity, [None] * (len(row) - keys - 1))
        for i, v in enumerate(row[keys + 1:]):
            if v is not None:
                seen[i] = v
        out[(entity, row[keys])] = tuple(seen)
    return out


@pytest.mark.parametrize("forward", [True, False])
def test_fill_of_several_columns_and_keys(spark, small_pieces, forward):
    draw = random.Random(3)
    data = []
    for i in range(400):
        key = ("HOT", 1) if i % 2 else (draw.choice(["A", None, "B"]), draw.choice([1, None]))
        data.append((*key, i, f"s{i}" if draw.random() < 0.1 else None, dt.date(2020, 1, 1) + dt.timedelta(i) if draw.random() < 0.05 else None))
    df = spark.createDataFrame(data, "k string, n int, o int, v string, d date").repartition(6)
    got = fill.fill_from_neighbours(df, ["v", "d"], ["o"], ["k", "n"], forward).collect()
    assert {((r.k, r.n), r.o): (r.v, r.d) for r in got} == plain_fill(data, 2, forward)


def test_fill_of_nothing_and_of_all_nulls(spark, small_pieces):
    df = spark.createDataFrame([("a", i, None) for i in range(30)], "k string, o int, v double")
    assert {r.v for r in fill.fill_from_neighbours(df, ["v"], ["o"], ["k"]).collect()} == {None}
    assert fill.fill_from_neighbours(df.where("o < 0"), ["v"], ["o"], ["k"]).collect() == []
    one = spark.createDataFrame([(1, 2.0)] + [(i, None) for i in range(2, 60)], "o int, v double")
    assert {r.v for r in fill.fill_from_neighbours(one, ["v"], ["o"]).collect()} == {2.0}  # over all ranges


def plain_asof(left, right, strict=False):
    out = []
    for k, t in left:
        known = [(kt, *v) for rk, kt, *v in right if rk == k and kt is not None and t is not None and (kt < t if strict else kt <= t)]
        out.append((k, t, *(max(known, key=lambda r: tuple((x is not None, x) for x in r)) if known else (None, None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_agrees_with_plain_python(spark, small_pieces, strict):
    draw = random.Random(7)
    keys = ["HOT"] * 6 + ["a", "b", None, "only left"]
    left = [(draw.choice(keys), draw.choice([None, *range(40)])) for _ in range(300)]
    right = [(draw.choice([k for k in keys if k != "only left"] + ["only right"]), draw.choice([None, *range(40)]),
              draw.choice([None, draw.randrange(50)]), f"x{i}") for i in range(150)]
    days = spark.createDataFrame(left, "k string, t int")
    told = spark.createDataFrame(right, "k string, known int, v int, w string")
    got = asof.asof_join(days, told, ["k"], "t", "known", ["v", "w"], strict=strict)
    assert got.columns == ["k", "t", "known", "v", "w"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_asof(left, right, strict)


def test_asof_join_per_field(spark, small_pieces):
    draw = random.Random(8)
    left = [(draw.choice("ab"), draw.randrange(40)) for _ in range(120)]
    right = [(draw.choice("ab"), t, draw.choice([None, float(t)]), draw.choice([None, f"w{t}"])) for t in range(0, 40, 2)]
    got = asof.asof_join(spark.createDataFrame(left, "k string, t int"),
                         spark.createDataFrame(right, "k string, known int, v double, w string"), ["k"], "t", "known",
                         ["v", "w"], per_field=True)
    want = []
    for k, t in left:
        row = [k, t]
        for c in (2, 3):
            seen = [(r[1], r[c]) for r in right if r[0] == k and r[1] <= t and r[c] is not None]
            row += max(seen) if seen else (None, None)
        want.append(tuple(row))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_asof_join_of_empty_sides_and_clashing_names(spark):
    days, told = (spark.createDataFrame([("a", 1)], f"k string, {c} int") for c in ("t", "known"))
    told = told.withColumn("v", F.lit(2))
    assert [tuple(r) for r in asof.asof_join(days, told.limit(0), ["k"], "t", "known", ["v"]).collect()] == [("a", 1, None, None)]
    assert asof.asof_join(days.limit(0), told, ["k"], "t", "known", ["v"]).collect() == []
    assert [tuple(r) for r in asof.asof_join(days, told, [], "t", "known", ["v"]).collect()] == [("a", 1, 1, 2)]
    with pytest.raises(ValueError, match="both sides"):
        asof.asof_join(days.withColumn("v", F.lit(1)), told, ["k"], "t", "known", ["v"])


def test_a_symbol_with_half_of_the_rows_is_spread(spark):
    """No task gets half of the rows, the plan joins on no inequality and has one shuffle."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        key = F.when(F.col("id") % 2 == 0, "HOT").otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("k")
        days = spark.range(40_000).select(key, F.col("id").alias("t"))
        told = spark.range(0, 40_000, 7).select(key, F.col("id").alias("known"), (F.col("id") * 2).alias("v"))
        both = asof.merged_sides(days, told, ["k"], "t", "known", ["v"])
        order = [F.col(asof.OWN + "t"), F.col(asof.OWN + "side"), F.col(asof.OWN + "tie")]
        ranges = carry.in_order(both, [asof.OWN + "k0"], order)
        sizes = [r["count"] for r in ranges.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 0.4 * sum(sizes)
        plan = ranges._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange rangepartitioning") == 1 and "Window" not in plan and "Join" not in plan
        done = asof.asof_join(days, told, ["k"], "t", "known", ["v"])
        assert done.where("k = 'HOT' and t >= 14 and (v is null or known > t)").count() == 0
        assert done.count() == 40_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
