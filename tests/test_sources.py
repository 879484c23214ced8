"""Sources and sinks: optional source, CSV text vs typed, table overwrite,
empty-table creation, append + history, view vs table, partition overwrite,
routed writes, landing metadata."""

from pyspark.sql import functions as F

from strata.plans import medallion as M
from strata.session import scratch_path
from strata.sources import readers, sinks

ROWS = [("T001", "Airport", 35.50, 22.1), ("T002", "Downtown", 12.00, 8.3),
        ("T003", "Suburbs", 28.75, 17.8)]


def test_csv_round_trip_text_and_typed(spark):
    path = scratch_path(spark, "t-csv")
    df = spark.createDataFrame(ROWS, "trip_id string, zone string, fare double, distance double")
    sinks.write_csv(df, path)
    text = readers.read_csv(spark, path)
    assert text.count() == 3 and all(t == "string" for _, t in text.dtypes)
    typed = readers.read_csv(spark, path, infer=True)
    assert dict(typed.dtypes)["fare"] == "double"


def test_optional_source_missing_and_present(spark):
    assert readers.read_optional(spark, scratch_path(spark, "nothing"), "csv") is None
    path = scratch_path(spark, "t-opt")
    spark.range(3).write.parquet(path)
    assert readers.read_optional(spark, path, "parquet").count() == 3


def test_tables_overwrite_ensure_append_history(spark):
    tag = scratch_path(spark, "t").rsplit("-", 1)[-1]
    name, path = f"t_bronze_{tag}", scratch_path(spark, "t-bronze")
    df = spark.createDataFrame(ROWS, "trip_id string, zone string, fare double, distance double")
    sinks.overwrite_table(df, name, path)
    sinks.overwrite_table(df.limit(2), name, path)
    assert readers.read_catalog(spark, name).count() == 2
    assert sinks.ensure_table(spark, df, name) is False
    empty = f"t_empty_{tag}"
    assert sinks.ensure_table(spark, df, empty, scratch_path(spark, "t-empty")) is True
    assert readers.read_catalog(spark, empty).count() == 0
    audit, audit_path = f"t_audit_{tag}", scratch_path(spark, "t-audit")
    for i in range(7):
        row = spark.createDataFrame([("bronze", f"b{i}", 10 * i, f"2024-01-0{i + 1} 00:00:00")],
                                    "layer string, batch_id string, rows long, run_ts string")
        sinks.append_table(row.withColumn("run_ts", F.col("run_ts").cast("timestamp")), audit,
                           path=audit_path)
    hist = sinks.run_history(readers.read_catalog(spark, audit), 5).collect()
    assert [r.batch_id for r in hist] == ["b6", "b5", "b4", "b3", "b2"]


def test_materialize_view_or_table(spark):
    df = spark.range(5)
    v = sinks.materialize(df, "t_view_model")
    assert v.count() == 5 and spark.catalog.tableExists("t_view_model")
    tag = scratch_path(spark, "t").rsplit("-", 1)[-1]
    t = sinks.materialize(df, f"t_table_model_{tag}", as_table=True,
                          path=scratch_path(spark, "t-model"))
    assert t.count() == 5


def test_partition_overwrite_replaces_only_its_batch(spark):
    path = scratch_path(spark, "t-batches")
    a = spark.range(4).withColumn("_batch_id", F.lit("a"))
    b = spark.range(3).withColumn("_batch_id", F.lit("b"))
    sinks.overwrite_partitions(a, path, ["_batch_id"])
    sinks.overwrite_partitions(b, path, ["_batch_id"])
    sinks.overwrite_partitions(b.limit(1), path, ["_batch_id"])  # re-run of batch b
    got = {r._batch_id: r["count"] for r in spark.read.parquet(path).groupBy("_batch_id")
           .count().collect()}
    assert got == {"a": 4, "b": 1}


def test_landing_metadata(spark):
    path = scratch_path(spark, "t-raw")
    spark.createDataFrame([(1, "x", 2.5), (2, None, 3.0)], "id long, s string, v double") \
        .write.parquet(path)
    landed = M.land(readers.read_files(spark, path), "2023_01", "2024-01-01 00:00:00",
                    hash_columns=["id", "s", "v"])
    rows = landed.orderBy("id").collect()
    assert {r._batch_id for r in rows} == {"2023_01"}
    assert all(r._source_file.endswith(".parquet") for r in rows)
    assert rows[0]._row_hash == spark.sql("select md5('1|x|2.5') h").first().h
    # nulls are skipped by the plain hash, kept apart with a marker
    safe = M.land(readers.read_files(spark, path), "b", "2024-01-01 00:00:00",
                  hash_columns=["id", "s", "v"], null_marker="<null>").orderBy("id").collect()
    assert safe[1]._row_hash == spark.sql("select md5('2|<null>|3.0') h").first().h


def test_routed_write_is_one_pass(spark):
    path = scratch_path(spark, "t-routed")
    df = spark.range(10).withColumn("bad", F.col("id") % 3 == 0)
    sinks.write_routed(df, path, "_q", F.col("bad"))
    back = spark.read.parquet(path)
    assert back.filter(F.col("_q").cast("string") == "true").count() == 4
    assert back.count() == 10


def test_bronze_batch_rerun_is_idempotent(spark):
    path = scratch_path(spark, "t-bronze-batches")
    raw = spark.createDataFrame(ROWS, "trip_id string, zone string, fare double, distance double")
    M.write_bronze(raw, path, "2023_01", "2024-01-01 00:00:00")
    M.write_bronze(raw.limit(2), path, "2023_02", "2024-02-01 00:00:00")
    back = M.write_bronze(raw, path, "2023_01", "2024-03-01 00:00:00")
    got = {r._batch_id: r["count"] for r in back.groupBy("_batch_id").count().collect()}
    assert got == {"2023_01": 3, "2023_02": 2}


def test_silver_write_observes_stage_counts(spark, sf_small):
    from strata.plans import adapter
    from strata.operators import rules
    limits = M.Limits(max_fare=50_000.0)
    raw = adapter.trips(spark, sf_small)
    path = scratch_path(spark, "t-silver")
    counts = M.write_silver(raw, adapter.zones(spark, sf_small), path, limits)
    want = rules.stage_counts(raw, M.quality_rules(limits)).first().asDict()
    assert counts == want
    assert spark.read.parquet(path).count() == want["kept_rows"]


def test_run_layers_twice_is_idempotent(spark, sf_small):
    from strata.plans import adapter
    base = scratch_path(spark, "t-layers")
    raw = adapter.trips(spark, sf_small).filter(F.col("tpep_pickup_datetime") < "1996-01-01")
    zones = adapter.zones(spark, sf_small)
    order = ("_ingestion_ts", "l_orderkey", "l_linenumber", "l_partkey")
    lim = M.Limits(max_fare=50_000.0)
    db = "t_taxi_" + base.rsplit("-", 1)[-1]
    first = M.run_layers(raw, zones, base, "b1", "2024-01-01 00:00:00", lim, order=order,
                         database=db)
    assert spark.table(f"{db}.gold_daily_revenue").count() == first["tables"]["daily_revenue"]
    assert spark.table(f"{db}.silver_trips").count() == first["tables"]["silver"]
    again = M.run_layers(raw, zones, base, "b1", "2024-01-02 00:00:00", lim, order=order)
    assert first["tables"] == again["tables"]
    assert first["stage_counts"]["raw_rows"] == raw.count()
    keys = spark.read.parquet(f"{base}/silver").groupBy(*M.SILVER_KEYS).count()
    assert keys.filter("count > 1").count() == 0
