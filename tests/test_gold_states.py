"""Gold from states: equal to gold from all of silver, reading only the months of a batch."""

import pytest
from planutil import plan_text
from pyspark.sql import functions as F

from strata.plans import adapter, gold_states as G, medallion as M
from strata.session import scratch_path

LIMITS = M.Limits(max_fare=50_000.0)
TIES = ("l_orderkey", "l_linenumber", "l_partkey")


def rows_of(df):
    cols = sorted(c for c in df.columns if c != "_gold_ts")
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def two_batches(spark, sf_small):
    raw = adapter.trips(spark, sf_small)
    zones = adapter.zones(spark, sf_small, "ASIA")         # some trips have no zone
    base, day, reads = scratch_path(spark, "t-gold"), F.col("tpep_pickup_datetime"), []
    real = G.read_months

    def watched(spark, path, months):
        df = real(spark, path, months)
        files = [r[0] for r in df.select(F.input_file_name()).distinct().collect()]
        reads.append((sorted(map(str, months)), sorted({f.split("pickup_month=")[1][:10] for f in files}),
                      "PartitionFilters: [pickup_month" in plan_text(df, "formatted")))
        return df
    G.read_months = watched
    try:
        for name, part in (("b1", raw.where(day < "1996-01-01")),
                           ("b2", raw.where((day >= "1995-11-01") & (day < "1996-03-01")).withColumn("fare_amount", F.col("fare_amount") + 1))):
            M.run_layers(part, zones, base, name, "2024-01-01 00:00:00", LIMITS, order=TIES, source_file=F.lit(None).cast("string"))
    finally:
        G.read_months = real
    return base, reads


def test_second_batch_reads_only_its_months(spark, two_batches):
    base, reads = two_batches
    assert reads[1] == (*[["1995-11-01", "1995-12-01", "1996-01-01", "1996-02-01"]] * 2, True)
    assert len(reads[0][1]) == 12


def test_states_equal_a_full_rebuild(spark, two_batches):
    base, _ = two_batches
    kept = spark.read.parquet(f"{base}/gold_states")
    fresh = G.states(spark.read.parquet(f"{base}/silver")).select(*kept.columns)
    assert kept.exceptAll(fresh).isEmpty() and fresh.exceptAll(kept).isEmpty()


def test_gold_from_states_equals_gold_from_silver(spark, two_batches):
    base, _ = two_batches
    silver, kept = spark.read.parquet(f"{base}/silver"), spark.read.parquet(f"{base}/gold_states")
    for name in ("daily_revenue", "zone_performance", "hourly_demand"):
        assert rows_of(getattr(G, name)(kept)) == rows_of(getattr(M, name)(silver))
        assert rows_of(spark.read.parquet(f"{base}/gold/{name}")) == rows_of(getattr(M, name)(silver))


def test_refresh_twice_changes_nothing(spark, two_batches):
    base, _ = two_batches
    before = rows_of(spark.read.parquet(f"{base}/gold_states"))
    months = G.months_of(spark.read.parquet(f"{base}/silver"))[:3]
    G.refresh_states(spark, f"{base}/silver", f"{base}/gold_states", months)
    assert rows_of(spark.read.parquet(f"{base}/gold_states")) == before


def test_states_of_nulls_and_of_nothing(spark, two_batches):
    base, _ = two_batches
    silver = spark.read.parquet(f"{base}/silver").limit(40)
    for c in ("fare_amount", "trip_distance", "passenger_count", "has_tip", "pickup_zone_name"):
        silver = silver.withColumn(c, F.when(F.col("l_linenumber") > 2, F.col(c)))
    for name in ("daily_revenue", "zone_performance", "hourly_demand"):
        assert rows_of(getattr(G, name)(G.states(silver))) == rows_of(getattr(M, name)(silver))
        assert getattr(G, name)(G.states(silver.limit(0))).collect() == []


def test_rules_reach_the_bronze_files(spark, two_batches):
    base, _ = two_batches
    from strata.operators import rules
    kept = rules.keep(spark.read.parquet(f"{base}/bronze").where("_batch_id = 'b1'"), M.quality_rules(LIMITS))
    assert "GreaterThan(trip_distance,0.0)" in plan_text(kept, "formatted")
