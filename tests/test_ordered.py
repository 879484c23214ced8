"""Windows over whole tables in one order, against Spark's own single-task windows."""

import random

import pytest
from planutil import plan_text
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import ordered as O

SCHEMA = "id long, v double, s string, t timestamp_ntz, d date"


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        v = None if i % 50 == 0 else float("nan") if i % 211 == 0 else 7.0 if i % 3 == 0 else rng.randrange(-40, 40) / 4
        rows.append((i, v, rng.choice(["a,b", 'q"q', "ä", "", None, "zz\n"]), i % 997, i % 5))
    return spark.createDataFrame(rows, "id long, v double, s string, n int, m int").selectExpr(
        "id", "v", "s", "cast(timestamp'2024-03-31 00:30:00' + make_dt_interval(0, 0, n, 0.123456) as timestamp_ntz) as t",
        "date_add(date'2024-01-01', m) as d").repartition(4)


@pytest.fixture(autouse=True)
def small_buckets(monkeypatch):
    monkeypatch.setattr(O, "BUCKET_ROWS", 60)


ORDERS = [(["v"], ["id"]), ([("v", False)], ["id"]), (["s", ("v", False)], ["id"]), ([("t", False), "d"], ["id"]),
          (["d"], [("id", False)])]


def spec(order):
    return Window.orderBy(*O._sorted_by(order))


def same(got, want):
    cols = sorted(want.columns)
    a, b = got.select(*cols), want.select(*cols)
    assert a.count() == b.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize(("order", "tie"), ORDERS)
def test_ranks_with_heavy_values_over_many_buckets(facts, order, tie):
    w = spec(order)
    want = facts.withColumns({"rank": F.rank().over(w).cast("long"), "dense_rank": F.dense_rank().over(w).cast("long")})
    same(O.ranked(facts, order, tie), want)


@pytest.mark.parametrize("rows", [1, 2, 7, 400])
def test_windows_look_back_over_bounds(facts, rows):
    order, tie = ["s", ("v", False)], ["id"]
    columns = {"total": lambda w: F.sum("id").over(w.rowsBetween(-(rows - 1), 0)),
               "most": lambda w: F.max("v").over(w.rowsBetween(-(rows - 1), 0))}
    if rows > 1:
        columns["before"] = lambda w: F.lag("id", rows - 1).over(w)
    w = spec([*order, *tie])
    same(O.windowed(facts, order, tie, rows, columns), facts.withColumns({n: fn(w) for n, fn in columns.items()}))


def test_running_totals_and_positions(facts):
    order, tie = [("t", False)], ["id"]
    w = spec([*order, *tie])
    amount = F.when(F.col("id") % 7 > 0, F.col("id")).cast("decimal(20,2)")
    same(O.running(facts, order, tie, {"so_far": amount}),
         facts.withColumn("so_far", F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    same(O.positions(facts, order, tie), facts.withColumn("row_id", F.row_number().over(w).cast("long")))


def test_time_zones_with_missing_and_repeated_hours(spark, facts):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        local = facts.withColumn("t", F.timestamp_seconds(F.lit(1711845000) + F.col("id") * 7))      # over the change of March 2024
        w = spec(["t", "id"])
        same(O.positions(local, ["t"], ["id"]), local.withColumn("row_id", F.row_number().over(w).cast("long")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_empty_single_and_equal_rows(spark):
    empty = spark.createDataFrame([], "id long, v double")
    assert O.positions(empty, ["v"]).collect() == [] and O.ranked(empty, ["v"]).collect() == []
    assert O.windowed(empty, ["v"], [], 3, {"x": lambda w: F.lag("v").over(w)}).collect() == []
    assert O.running(empty, ["v"], [], {"x": F.col("v")}).collect() == []
    alike = spark.createDataFrame([(1, 2.0)] * 500, "id long, v double")
    assert {(r["rank"], r.dense_rank) for r in O.ranked(alike, ["v"], ["id"]).collect()} == {(1, 1)}
    assert sorted(r.row_id for r in O.positions(alike, ["v"], ["id"]).collect()) == list(range(1, 501))
    with pytest.raises(TypeError):
        O.positions(spark.range(3).select(F.array("id").alias("a")), ["a"])


def test_buckets_share_a_heavy_value_and_stay_even(facts):
    sizes = [r["count"] for r in O.bucketed(facts, ["v", "id"]).groupBy(O._B).count().collect()]
    assert len(sizes) > 20 and max(sizes) < 8 * O.BUCKET_ROWS
    spread = O.bucketed(facts, ["v", "id"]).where("v = 7.0").select(O._B).distinct().count()
    assert spread > 8


def test_number_of_bounds_is_limited(facts, monkeypatch):
    monkeypatch.setattr(O, "MOST_BUCKETS", 3)
    assert O.bucketed(facts, ["id"]).select(O._B).distinct().count() <= 12
    same(O.positions(facts, ["id"]), facts.withColumn("row_id", F.col("id") + 1))


def test_facts_are_shuffled_once_and_never_to_one_task(facts):
    plan = plan_text(O.bucketed(facts, ["v", "id"]).withColumn(
        "n", F.row_number().over(Window.partitionBy(O._B).orderBy("v", "id"))), "simple")
    assert "SinglePartition" not in plan and plan.count("Exchange hashpartitioning(" + O._B) == 1
