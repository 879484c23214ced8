"""Column builders and small aggregates."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import aggregate, rules, windows


def test_column_builders(spark):
    df = spark.createDataFrame(
        [(1, 2.0, 0.0, "2024-01-06 10:00:00", True), (4, None, 3.0, "bad", None)],
        "code int, a double, b double, t string, flag boolean")
    r = df.select(
        C.label("code", {1: "one", 2: "two"}).alias("lab"),
        C.lookup("code", {1: "uno"}).alias("lk"),
        C.flag_label("flag", "Y", "N").alias("fl"),
        C.ratio("a", "b").alias("ratio"),
        C.guarded_ratio("a", "b").alias("g"),
        C.parse_timestamp("t").alias("ts"),
        C.hour_label(F.lit(7)).alias("hl"),
        C.money_text(F.lit(1234567.891)).alias("money"),
        C.count_text(F.lit(1234)).alias("cnt"),
        C.nan_to_null(F.lit(float("nan"))).alias("nan"),
        C.weekday_number(F.lit(dt.date(2024, 1, 7)), sunday=0).alias("dow0"),
        C.is_weekend(F.lit(dt.date(2024, 1, 6))).alias("we"),
    ).collect()
    a, b = r
    assert (a.lab, b.lab, a.lk, b.lk, a.fl, b.fl) == ("one", "Unknown", "uno", None, "Y", "N")
    assert (a.ratio, a.g, b.ratio) == (None, None, None)
    assert a.ts is not None and b.ts is None
    assert (a.hl, a.money, a.cnt, a.nan, a.dow0, a.we) == ("07:00", "$1,234,567.89", "1,234",
                                                          None, 0, True)


def test_surrogate_key_and_row_hash(spark):
    df = spark.createDataFrame([(1, None, "a")], "x int, y string, z string")
    r = df.select(C.surrogate_key("x", "y", "z").alias("k"),
                  C.row_hash(["x", "y", "z"]).alias("h"),
                  C.row_hash(["x", "y", "z"], null_marker="~").alias("h2")).first()
    want = spark.sql("select md5('1-_dbt_utils_surrogate_key_null_-a') k, md5('1|a') h, "
                     "md5('1|~|a') h2").first()
    assert (r.k, r.h, r.h2) == (want.k, want.h, want.h2)


def test_completeness_and_all_true(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    c = aggregate.completeness(df).first()
    assert (c.rows, c.null_cells, c.cells, c.completeness_pct) == (2, 1, 4, 75.0)
    r = df.agg(aggregate.all_true(F.col("a") > 0).alias("x"),
               aggregate.all_true(F.col("b") > 0).alias("y")).first()
    assert (r.x, r.y) == (True, False)


def test_tag_failures_and_route(spark):
    df = spark.range(6).withColumn("v", F.when(F.col("id") == 5, None).otherwise(F.col("id")))
    tagged = rules.tag(df, [("small", F.col("v") < 3)])
    got = {r.id: r._quarantine_reason for r in tagged.collect()}
    assert got[0] is None and got[4] == "small" and got[5] == "small"
    routed = rules.route(df, {"lo": F.col("v") < 2, "mid": F.col("v") < 4}, "hi")
    assert {r.id: r._route for r in routed.collect()} == {0: "lo", 1: "lo", 2: "mid", 3: "mid",
                                                          4: "hi", 5: "hi"}


def test_rolling_change_rank(spark):
    df = spark.createDataFrame([(d, float(v)) for d, v in
                                [(1, 10), (2, 20), (3, 20), (4, 40)]], "d int, v double")
    r = df.select("d", windows.rolling_mean("v", "d", 2).alias("m"),
                  windows.change("v", "d").alias("c"),
                  windows.rank_desc("v").alias("rk"),
                  windows.rank_desc("v", dense=True).alias("drk")).orderBy("d").collect()
    assert [x.m for x in r] == [10.0, 15.0, 20.0, 30.0]
    assert [x.c for x in r] == [None, 10.0, 0.0, 20.0]
    assert [x.rk for x in r] == [4, 2, 2, 1] and [x.drk for x in r] == [3, 2, 2, 1]


def test_wall_clock_duration_ignores_session_time_zone(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 2024-03-10 02:00 local: clocks jump forward in New York
        df = spark.createDataFrame([("2024-03-09 12:00:00", "2024-03-10 12:00:00")],
                                   "a string, b string").select(
            F.to_timestamp_ntz("a").alias("a"), F.to_timestamp_ntz("b").alias("b"))
        r = df.select(C.duration_minutes("a", "b", None, C.is_wall_clock(df, "a")).alias("m"))
        assert r.first().m == 1440.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
