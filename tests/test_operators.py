"""Operator properties: rules partition the input, aggregate-based dedupe
equals the window form, upsert is idempotent, ids are consecutive, exact
median equals the sorted middle, null-safe joins, metric rows."""

import statistics

from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from planutil import plan_text
from strata.functions import columns as C
from strata.operators import aggregate, enrich, rules, upsert, windows
from strata.session import scratch_path

SCHEMA = "id long, fare double, pax int, code int"


def test_split_partitions_input_with_nulls(spark):
    rows = [(1, 10.0, 1, 1), (2, None, 2, 2), (3, -1.0, None, 3), (4, 5.0, 9, None),
            (5, None, None, None), (6, 600.0, 1, 7)]
    df = spark.createDataFrame(rows, SCHEMA)
    rl = [("fare_ok", (F.col("fare") > 0) & (F.col("fare") < 500)),
          ("pax_ok", F.col("pax").between(1, 6)),
          ("code_ok", F.col("code").isin(1, 2, 3, 4, 5, 6))]
    clean, bad = rules.split(df, rl, failed_col="_failed")
    assert clean.count() + bad.count() == df.count()
    assert clean.join(bad, "id").count() == 0
    assert [r.id for r in clean.collect()] == [1]
    reasons = {r.id: r._failed for r in bad.collect()}
    assert reasons[5] == ["fare_ok", "pax_ok", "code_ok"]
    assert reasons[6] == ["fare_ok", "code_ok"]
    # keep() agrees with the clean branch
    assert sorted(r.id for r in rules.keep(df, rl).collect()) == [1]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 50)),
                min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1], t[2])))
def test_latest_per_key_equals_row_number(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, tie int")
    got = sorted(tuple(r) for r in windows.latest_per_key(df, ["k"], ["ts", "tie"]).collect())
    w = Window.partitionBy("k").orderBy(F.col("ts").desc(), F.col("tie").desc())
    want = sorted(tuple(r) for r in df.withColumn("rn", F.row_number().over(w))
                  .filter("rn = 1").collect())
    assert got == want


def test_latest_per_key_limits_before_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as ts", "id * 2 as v")
    plan = plan_text(windows.latest_per_key(df, ["k"], ["ts"]), "simple")
    # a partial per-task limit sits below the exchange
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)],
                                   "k int, v string, x double")
    source = spark.createDataFrame([(2, "B", 20.0), (3, "C", 30.0), (3, "C2", 31.0),
                                    (None, "m", 9.0)], "k int, v string, x double")
    once = upsert.upsert(target, source, ["k"], order=["x"])
    twice = upsert.upsert(once, source, ["k"], order=["x"])
    a = sorted((tuple(r) for r in once.collect()), key=repr)
    b = sorted((tuple(r) for r in twice.collect()), key=repr)
    # the null key never matches: it is inserted again on every run (as MERGE does)
    assert [r for r in a if r[0] is not None] == [r for r in b if r[0] is not None]
    assert sorted(r for r in a if r[0] is not None) == [(1, "a", 1.0), (2, "B", 20.0),
                                                       (3, "C2", 31.0)]


def test_upsert_refuses_ambiguous_source(spark):
    t = spark.createDataFrame([(1, 1.0)], "k int, x double")
    s = spark.createDataFrame([(1, 2.0), (1, 3.0)], "k int, x double")
    try:
        upsert.upsert(t, s, ["k"]).collect()
        raise AssertionError("expected AmbiguousSource")
    except upsert.AmbiguousSource:
        pass


def test_upsert_into_partitioned_path(spark):
    base = scratch_path(spark, "test-upsert")
    t = spark.range(100).selectExpr("id as k", "id % 5 as part", "cast(id as double) as x")
    t.write.partitionBy("part").parquet(base)
    src = spark.createDataFrame([(3, 3, -3.0), (200, 0, 2.0)], "k long, part long, x double")
    upsert.upsert_into_path(src, base, ["k"], partition_col="part")
    back = spark.read.parquet(base)
    assert back.count() == 101
    assert back.filter("k = 3").first().x == -3.0


def test_row_ids_consecutive(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 as k").repartition(5)
    ids = windows.row_ids(df, ["k"], partitions=4).orderBy("k").collect()
    assert [r.row_id for r in ids] == list(range(1, 1001))
    assert [r.k for r in ids] == list(range(1000))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), min_size=1, max_size=30))
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    vals = [v for v in values if v is not None]
    got = aggregate.exact_median(df, "v", partitions=3)
    assert got == (statistics.median(vals) if vals else None)


def test_null_safe_enrich(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, s string")
    dim = spark.createDataFrame([(1, "one"), (None, "none")], "key int, name string")
    plain = enrich.enrich(left, dim, "k", "key", {"name": "name"})
    safe = enrich.enrich(left, dim, "k", "key", {"name": "name"}, null_safe=True)
    assert {r.s: r.name for r in plain.collect()} == {"a": "one", "b": None}
    assert {r.s: r.name for r in safe.collect()} == {"a": "one", "b": "none"}


def test_broadcast_is_size_checked(spark):
    small = spark.range(10)
    assert enrich.fits(small, 10) and not enrich.fits(small, 9)


def test_metric_rows_single_scan(spark):
    df = spark.range(1, 11).selectExpr("id as n", "cast(id as double) * 1.5 as v")
    m = aggregate.metric_rows(df, {"Total": C.money_text(F.sum("v")),
                                   "Count": C.count_text(F.count(F.lit(1)))})
    plan = plan_text(m, "simple")
    assert plan.count("Range (") == 1
    assert {r.metric: r.value for r in m.collect()} == {"Total": "$82.50", "Count": "10"}


def test_half_up_is_order_independent(spark):
    # 0.1 + 0.2 sums to 0.30000000000000004 in one order
    df = spark.createDataFrame([(0.1,), (0.2,), (1.005,)], "x double")
    r = df.agg(C.half_up(F.sum("x"), 2).alias("s"),
               C.half_up(F.lit(1.005), 2).alias("t")).first()
    assert (r.s, r.t) == (1.31, 1.01)
