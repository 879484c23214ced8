"""Broadcasts by proven bytes, asked for once; heavy keys spread over tasks."""

import pytest
from planutil import plan_text
from pyspark.sql import functions as F

from strata.operators import enrich
from strata.session import scratch_path


def same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    key = lambda r: repr(tuple(r))
    assert sorted(a.select(*cols).collect(), key=key) == sorted(b.select(*cols).collect(), key=key)


def test_bytes_count_what_the_rows_hold(spark):
    few = spark.createDataFrame([(i, "x" * 1000) for i in range(20)], "k int, s string")
    many = spark.range(1000).selectExpr("cast(id as int) as k", "'x' as s")
    assert 20_000 < enrich.proven_bytes(few) < 22_000 < enrich.proven_bytes(many) < 40_000
    nested = spark.createDataFrame([(1, ["a" * 300, None], None)], "k int, a array<string>, b binary")
    assert enrich.proven_bytes(nested) > 300
    assert enrich.proven_bytes(few.limit(0)) == 0
    facts = spark.range(50).selectExpr("cast(id % 20 as int) as f")
    assert "BroadcastHashJoin" in plan_text(enrich.enrich(facts, few, "f", "k", {"s": "s"}, broadcast_bytes=30_000), "simple")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan_text(enrich.enrich(facts, few, "f", "k", {"s": "s"}, broadcast_bytes=10_000), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_a_dimension_is_summed_once(spark):
    path = scratch_path(spark, "t-dim")
    spark.range(30).selectExpr("id as k", "concat('n', id) as name").write.parquet(path)
    tracker, group = spark.sparkContext.statusTracker(), "t-dim-jobs"

    def jobs():
        spark.sparkContext.setJobGroup(group, group)
        before = len(tracker.getJobIdsForGroup(group))
        enrich.proven_bytes(spark.read.parquet(path).select("k", "name"))
        return len(tracker.getJobIdsForGroup(group)) - before
    try:
        spark.sparkContext.setJobGroup(group, group)
        spark.read.parquet(path)        # reading the schema is a job of its own
        base = len(tracker.getJobIdsForGroup(group))
        assert base <= 1
        first, second = jobs(), jobs()
        assert second < first and second <= 1
        spark.range(60).selectExpr("id as k", "concat('n', id) as name").write.mode("overwrite").parquet(path)
        assert enrich.proven_bytes(spark.read.parquet(path).select("k", "name")) > 60 * 24      # other files, other sum
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_the_plain_one(spark, how, null_safe):
    facts = spark.range(3000).selectExpr("case when id % 3 = 0 then 7 when id % 5 = 0 then null else id % 900 end as k",
                                         "id % 2 as part", "id as v").repartition(5)
    dim = spark.createDataFrame([(i, j, f"n{i}-{j}") for i in range(0, 900, 2) for j in (0, 1)] + [(7, 1, "a"), (7, 1, "b"), (None, 0, "none")],
                                "key long, part2 long, name string")
    got = enrich.enrich(facts, dim, ["k", "part"], ["key", "part2"], {"name": "name"}, how, null_safe, broadcast_bytes=0, salt=True)
    want = enrich.enrich(facts, dim, ["k", "part"], ["key", "part2"], {"name": "name"}, how, null_safe, broadcast_bytes=None)
    same(got, want)


def test_heavy_keys_are_found_and_spread(spark):
    facts = spark.range(20_000).selectExpr("case when id % 3 = 0 then 7 else id end as k", "id as v").repartition(4)
    assert [r.k for r in enrich.heavy_keys(facts, ["k"]).collect()] == [7]
    assert enrich.heavy_keys(spark.range(5000), ["id"]).collect() == [] and enrich.heavy_keys(facts.limit(0), ["k"]).collect() == []
    dim = spark.range(20_000).selectExpr("id as key", "concat('n', id) as name")
    joined = enrich.salted_join(facts, dim, {"k": "key"})
    assert joined.count() == 20_000
    assert "__salt" in plan_text(joined, "simple") and "CartesianProduct" not in plan_text(joined, "simple")
    with pytest.raises(ValueError):
        enrich.salted_join(facts, dim, {"k": "key"}, "full")
    assert F
