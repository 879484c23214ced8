"""The gate with missing columns and repeated keys, message keys and positions,
repeats inside one micro-batch, declared model tests, two silver batches."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.plans import gate, medallion as M
from strata.session import scratch_path
from strata.streaming import monitor, publish

DAY = dt.datetime(2023, 5, 1, 8)


@pytest.fixture()
def trips(spark):
    rows = [(f"a{i}", DAY, DAY + dt.timedelta(minutes=i + 1), 10.0 + i, 1.0, 2, 1) for i in range(4)]
    rows += [("a0", DAY, DAY + dt.timedelta(minutes=9), 11.0, 1.0, 2, 1), (None,) + rows[0][1:],
             (None,) + rows[1][1:]]
    return spark.createDataFrame(
        rows, "trip_id string, pickup_datetime timestamp, dropoff_datetime timestamp, fare_usd double, "
              "distance_miles double, passenger_count int, payment_type_code int")


def _by_name(results):
    return {r["check"]: (r["status"], r["detail"]) for r in results.collect()}


def test_missing_column_fails_its_checks_only(trips):
    whole = _by_name(Q.run_checks(trips, gate.trip_checks(trips)))
    assert whole["All required columns present"][0] == "PASS"
    less = trips.drop("passenger_count")
    res = _by_name(Q.run_checks(less, gate.trip_checks(less)))
    assert len(res) == 14
    assert res["All required columns present"][0] == "FAIL"
    assert res["passenger_count between 1 and 6"] == ("FAIL", "missing column: passenger_count")
    same = set(res) - {"All required columns present", "passenger_count between 1 and 6",
                       "Overall completeness >= 95%"}
    assert all(res[k] == whole[k] for k in same)


def test_unique_counts_rows_beyond_the_first_and_has_its_own_pass(trips):
    res = _by_name(Q.run_checks(trips, [Q.unique("trip_id"), Q.row_count_between(1)], "Overall"))
    assert res["trip_id is unique"] == ("FAIL", "2 duplicates found")
    assert res["Overall"][0] == "FAIL"
    empty = _by_name(Q.run_checks(trips.limit(0), [Q.unique("trip_id")]))
    assert empty["trip_id is unique"][0] == "PASS"
    plan = Q.run_checks(trips, gate.trip_checks(trips))._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "distinct" not in plan.lower()


def test_published_files_carry_key_and_position(spark):
    path = scratch_path(spark, "t-publish")
    df = spark.range(50).selectExpr("if(id % 5 = 0, null, id % 5) as customer", "id")
    publish.publish_files(df, "customer", path)
    back = monitor.read_messages(spark, path)
    assert back.filter("key is null").count() == 10
    assert back.select("partition", "offset").distinct().count() == 50
    dense = back.groupBy("partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"),
                                          F.count("*").alias("n")).collect()
    assert all((r.lo, r.hi) == (0, r.n - 1) for r in dense)


def test_start_position_leaves_out_earlier_files(spark):
    path = scratch_path(spark, "t-start")
    publish.publish_files(spark.range(5), "id", path)
    for start, n in (("earliest", 5), ("2999-01-01 00:00:00", 0)):
        out = scratch_path(spark, "t-out")
        monitor.run_append(monitor.message_source(spark, path, starting=start), out,
                           scratch_path(spark, "t-ckpt"))
        try:
            assert spark.read.parquet(out).count() == n
        except AnalysisException:      # no row: an empty folder
            assert n == 0


def test_repeat_in_one_micro_batch_goes_by_event_time_then_position(spark):
    log = spark.createDataFrame(
        [("k", "old", "2023-01-01", 0, 0, 0), ("k", "late", "2023-01-02", 1, 0, 3),
         ("k", "later", "2023-01-02", 1, 0, 4), ("k", "stale", "2023-01-01", 1, 0, 9)],
        "id string, status string, ts string, _batch_id int, partition int, offset long")
    assert monitor.latest_events(log, "id", ["ts"]).first().status == "later"
    first = monitor.compact_log(log.filter("_batch_id = 0"), "id", ["ts"], scratch_path(spark, "t-v0"))
    assert monitor.last_batch(first) == 0 and monitor.last_batch(first.limit(0)) == -1
    second = monitor.compact_log(log.filter("_batch_id = 1"), "id", ["ts"], scratch_path(spark, "t-v1"),
                                 state=first, after=0)
    assert [r.status for r in second.collect()] == ["later"]


def test_column_tests(spark):
    df = spark.createDataFrame([(1, 7), (1, 9), (None, None), (None, 1)], "k int, code int")
    got = {(r.test, r.column_name): (r.failures, r.status) for r in Q.column_tests(
        df, "m", ["k"], ["k"], {"code": [1, 7]}).collect()}
    assert got == {("not_null", "k"): (2, "FAIL"), ("unique", "k"): (1, "FAIL"),
                   ("accepted_values", "code"): (1, "FAIL")}


def test_silver_validation(spark):
    df = spark.createDataFrame([(1.0, -2.0, "Cash"), (None, 3.0, "Cash"), (2.0, 1.0, "Unknown")],
                               "trip_duration_mins double, fare_amount double, payment_label string")
    got = {(r.check, r.value): r.rows for r in M.silver_validation(df).collect()}
    assert got == {("null_durations", None): 1, ("negative_fares", None): 1,
                   ("payment_label", "Cash"): 2, ("payment_label", "Unknown"): 1}
