"""Hot keys: one key holding a third of all rows gives the same answers as a
brute-force computation, and the plans keep it out of any single task."""

from pyspark.sql import functions as F

from planutil import plan_text
from strata.operators import aggregate, windows
from strata.streaming import publish

N = 30000


def _skewed(spark):
    # a third of the rows share key 0; the rest are spread over 1000 keys
    return spark.range(N).selectExpr(
        "case when id % 3 = 0 then 0 else id % 1000 + 1 end as k",
        "id as ts", "cast(id % 97 as double) as v")


def test_latest_per_key_hot_key(spark):
    df = _skewed(spark)
    got = {r.k: r.ts for r in windows.latest_per_key(df, ["k"], ["ts"]).collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.max("ts").alias("m")).collect()}
    assert got == want
    below = plan_text(windows.latest_per_key(df, ["k"], ["ts"]), "simple")
    below = below[below.index("Exchange"):]
    assert "WindowGroupLimit" in below      # each task sends one row per key


def test_frequency_and_median_hot_value(spark):
    df = _skewed(spark)
    top = aggregate.frequency(df, "k").first()
    assert (top.k, top["count"]) == (0, N // 3)
    vals = sorted(r.v for r in df.select("v").collect())
    want = (vals[(len(vals) - 1) // 2] + vals[len(vals) // 2]) / 2
    assert aggregate.exact_median(df, "v") == want


def test_publisher_keeps_every_message_of_a_hot_key(spark):
    df = _skewed(spark)
    placed = publish.place_by_key(publish.to_messages(df, "k"))
    assert placed.count() == N
    assert placed.filter("key = '0'").count() == N // 3
