"""Inputs that once lost rows or changed values."""

import pytest
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import aggregate, upsert
from strata.plans import medallion
from strata.session import ensure_checkpoint_dir, scale_conf


def test_merge_keeps_rows_of_the_null_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    target = [(1, "a", "p1"), (2, "a", None), (3, "a", None), (9, "a", "p9")]
    spark.createDataFrame(target, "k int, v string, p string").write.partitionBy("p").parquet(path)
    source = spark.createDataFrame([(1, "b", "p1"), (4, "b", None)], "k int, v string, p string")
    upsert.upsert_into_path(source, path, ["k"], partition_col="p")
    got = {(r.k, r.v, r.p) for r in spark.read.parquet(path).collect()}
    assert got == {(1, "b", "p1"), (2, "a", None), (3, "a", None), (4, "b", None), (9, "a", "p9")}


def test_merge_prunes_partitions_by_range(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(40).select("id", (F.col("id") % 10).cast("int").alias("p")).write.partitionBy("p").parquet(path)
    source = spark.createDataFrame([(3, 3), (4, 4)], "id long, p int")
    scoped = upsert.touched_partitions(spark.read.parquet(path), source, "p")
    plan = scoped._jdf.queryExecution().executedPlan().toString()
    assert ">= 3" in plan and "<= 4" in plan and "PartitionFilters: [" in plan
    assert {r.p for r in scoped.collect()} == {3, 4}


def test_small_amounts_are_not_rounded_away(spark):
    total = spark.range(100_000).select(F.lit(0.00004).alias("x")).agg(C.money_sum("x", 10)).first()[0]
    assert float(total) == pytest.approx(4.0)


def test_median_of_integers_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (None, float("nan"))], "i int, d double")
    filled, medians = aggregate.impute_median(df, ["i", "d"])
    assert medians == {"i": 1.5, "d": 1.5}
    assert sorted(tuple(r) for r in filled.collect()) == [(1.0, 1.0), (1.5, 1.5), (2.0, 2.0)]


def test_each_row_gets_its_file_and_batch_ids_stay_text(spark, tmp_path):
    raw = tmp_path / "raw"
    for i, name in enumerate(["yellow_01", "yellow_02"]):
        spark.range(i * 5, i * 5 + 5).toPandas().to_parquet(_made(raw) / f"{name}.parquet")
    df = spark.read.parquet(str(raw))
    for batch in ("001", "2023_02"):
        landed = medallion.write_bronze(df, str(tmp_path / "bronze"), batch, "2024-01-01 00:00:00")
    rows = landed.collect()
    assert {r._batch_id for r in rows} == {"001", "2023_02"}
    assert all(f"yellow_0{1 + r.id // 5}.parquet" in r._source_file for r in rows)


def _made(path):
    path.mkdir(exist_ok=True)
    return path


def test_scratch_folder_and_partitions(spark):
    assert ensure_checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert int(scale_conf(10 ** 15, 1000)["spark.sql.shuffle.partitions"]) > 3_000_000
