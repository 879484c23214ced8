"""Values worked out by hand on small rows with known faults (fixtures.py)."""

import json

import pytest
from pyspark.sql import functions as F

import fixtures as FX
from strata.functions import columns as C
from strata.operators import aggregate, enrich, quality as Q, rules
from strata.plans import etl, gate


@pytest.fixture(scope="module")
def trips(spark):
    return FX.frame(spark, FX.TRIPS, FX.TRIPS_SCHEMA, ts_cols=(1, 2))


def by_id(df, col):
    return [r[col] for r in df.orderBy("trip_id").collect()]


def test_trip_features(trips):
    f = etl.trip_features(trips)
    assert by_id(f, "trip_duration_mins") == [30, 20, 40, 12, 5, 30]
    assert by_id(f, "total_amount") == [28, 25, 46, 12, None, 30]
    assert by_id(f, "fare_per_km") == [2.5, 3.13, 2.5, 2.75, None, 2.4]      # 3.125 rounds up
    assert by_id(f, "pickup_hour") == [6, 7, 22, 9, 10, 18]


def test_null_profile_and_median_fill(trips):
    f = etl.trip_features(trips)
    before = {r["column_name"]: r["null_count"] for r in aggregate.null_profile(f).collect()}
    assert before == {"fare_usd": 1, "tip_usd": 1, "total_amount": 1, "fare_per_km": 1}
    filled, medians = etl.fill_fare(f)
    assert medians["fare_usd"] == 25.0                    # 11 25 25 30 40
    after = {r["column_name"]: r["null_count"] for r in aggregate.null_profile(filled).collect()}
    assert after == {"total_amount": 1, "fare_per_km": 1}  # derived before the fill


def test_filters_and_router(trips):
    routed = rules.route(trips, {"Harbour": F.col("pickup_zone") == "Harbour"}, "other")
    assert rules.branch(routed, "Harbour").count() == 3
    assert trips.filter(F.col("distance_km") > 4).count() == 4
    assert trips.filter(F.col("payment_type") == "card").count() == 4


def test_zone_summary(trips):
    filled, _ = etl.fill_fare(etl.trip_features(trips))
    rows = etl.zone_summary(filled).collect()
    got = [(r["pickup_zone"], r["trip_count"], r["total_revenue"], r["avg_fare"],
            r["avg_distance"]) for r in rows]
    assert got == [("Harbour", 3, 90.0, 30.0, 11.33), ("Station", 2, 36.0, 18.0, 2.5),
                   ("Hill", 1, 30.0, 30.0, 12.5)]


def test_sort_mixed_directions(trips):
    top = (trips.orderBy(F.col("pickup_zone").asc_nulls_last(),
                         F.col("fare_usd").desc_nulls_last(), "trip_id").limit(6))
    assert [r.trip_id for r in top.collect()] == ["A3", "A1", "A2", "C4", "B5", "B6"]


def test_left_join_keeps_both_keys(spark, trips):
    zones = spark.createDataFrame(FX.ZONES, FX.ZONES_SCHEMA)
    j = enrich.enrich(trips, zones, "pickup_zone", "zone",
                      {"borough": "borough", "zone_type": "zone_type"},
                      null_safe=True, keep_right_key=True)
    assert j.count() == 6
    assert j.filter(F.col("borough").isNull()).count() == 0
    assert "zone" in j.columns and "pickup_zone" in j.columns


def test_quality_gate(spark):
    df = FX.frame(spark, FX.QUALITY, FX.QUALITY_SCHEMA, ts_cols=(1, 2))
    results, scored, clean, bad = gate.run_gate(df)
    res = {r["check"]: (r["status"], r["detail"]) for r in results.collect()}
    assert len(res) == 14
    failing = {k for k, v in res.items() if v[0] == "FAIL"}
    assert failing == {"fare_usd >= 0", "passenger_count between 1 and 6"}
    assert res["fare_usd >= 0"][1] == "1 negative fares found"
    assert res["avg fare between $5 and $100"][1] == "avg fare = $19.33"      # 116 / 6
    assert res["Overall completeness >= 95%"][1] == "completeness = 100.0%"
    s = scored.first()
    assert (s.total_checks, s.passed_checks, s.failed_checks, s.score_pct) == (14, 12, 2, 85.7)
    assert s.decision == Q.PROCEED_WITH_QUARANTINE
    assert clean.count() == 4
    assert sorted(r.trip_id for r in bad.collect()) == ["Q3", "Q5"]
    assert {r._quarantine_reason for r in bad.collect()} == {gate.QUARANTINE_REASON}


def test_weather_payload(spark, tmp_path):
    p = tmp_path / "payload.json"
    p.write_text(json.dumps(FX.WEATHER, indent=2))
    schema = ("daily struct<time array<string>, temperature_2m_max array<double>, "
              "temperature_2m_min array<double>, precipitation_sum array<double>, "
              "wind_speed_10m_max array<double>>")
    from strata.sources import readers
    raw = readers.read_json_payload(spark, str(p), schema)
    w = etl.weather_features(etl.flatten_daily(raw)).orderBy("date").collect()
    assert [r.temp_avg_c for r in w] == [15.0, 16.8, 15.0, 15.3, 17.8, 19.0]   # half up
    assert [r.temp_range_c for r in w] == [10.0, 9.5, 8.0, 5.5, 9.5, 10.0]
    assert w[0].day_of_week == "Wednesday" and str(w[0].date) == "2022-06-01"
    assert [r.is_rainy_day for r in w].count(True) == 2
    df = etl.weather_features(etl.flatten_daily(raw))
    res = Q.run_checks(df, etl.series_checks(df))
    assert {r.status for r in res.collect()} == {"PASS"}
    assert Q.all_passed(res).first().all_passed is True


def test_small_lists(spark):
    d = spark.createDataFrame([(x,) for x in FX.DISTANCES], "distance_km double")
    s = aggregate.global_stats(d, "distance_km").first()
    assert (s.n, s.total, s.mean, s.max, s.min) == (5, 77.5, 15.5, 40.0, 3.0)
    buckets = d.select(C.tier("distance_km", [(5, "short"), (15, "medium")], "long",
                              above=False).alias("b")).collect()
    assert [r.b for r in buckets] == ["short", "medium", "medium", "long", "long"]
    raw = spark.createDataFrame([(x,) for x in FX.RAW_FARES], "fare string")
    clean, rejected = rules.safe_cast(raw, "fare")
    assert sorted(r.fare for r in clean.collect()) == [-1.0, 7.25]
    assert sorted(r.fare for r in rejected.collect()) == ["  ", "NaN", "free"]
    rep = rules.cast_report(raw, "fare").first()
    assert (rep.rejected_rows, rep.rejected_pct) == (3, 60.0)
    fares = spark.createDataFrame([(x,) for x in FX.FARES], "fare double")
    taxed = [r.t for r in fares.select(C.scaled("fare", 1.18, 2).alias("t")).collect()]
    assert taxed == [11.8, 2.66, 118.0]                                   # 2.655 rounds up
    pays = spark.createDataFrame([(x,) for x in FX.PAYMENTS], "p string")
    rep = aggregate.distinct_report(pays, "p").first()
    assert (rep.distinct_values, rep.duplicate_rows) == (3, 3)


def test_unpivot_record(spark):
    rec = spark.createDataFrame([("A2", "Harbour", "Station", 8.0, 25.0, "cash", 1)],
                                "trip_id string, pickup_zone string, dropoff_zone string, "
                                "distance_km double, fare_usd double, payment_type string, "
                                "passenger_count int")
    rec = rec.withColumn("fare_per_km", C.ratio("fare_usd", "distance_km", 2))
    cols = [c for c in rec.columns]
    pairs = rec.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "field", "value").collect()
    assert len(pairs) == 8
    assert dict((r.field, r.value) for r in pairs)["fare_per_km"] == "3.13"


def test_range_check_counts_outside_rows_only(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "passenger_count int")
    res = Q.run_checks(df, [Q.in_range("passenger_count", 1, 6)]).first()
    assert (res.status, res.detail) == ("FAIL", "1 invalid rows")
    ok = spark.createDataFrame([(1,), (None,)], "passenger_count int")
    res = Q.run_checks(ok, [Q.in_range("passenger_count", 1, 6)]).first()
    assert (res.status, res.detail) == ("FAIL", "0 invalid rows")


def test_gate_treats_nan_as_missing(spark):
    rows = [r if r[0] != "Q4" else (r[0], r[1], r[2], float("nan")) + r[4:] for r in FX.QUALITY]
    df = FX.frame(spark, rows, FX.QUALITY_SCHEMA, ts_cols=(1, 2))
    results, _, clean, bad = gate.run_gate(df)
    res = {r["check"]: (r["status"], r["detail"]) for r in results.collect()}
    assert res["No nulls in [fare_usd]"] == ("FAIL", "1 nulls found")
    assert res["fare_usd < $500 (outlier check)"] == ("PASS", "0 outliers found")
    assert clean.count() + bad.count() == 6
