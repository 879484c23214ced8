"""Stream parsing, running counts, stream = batch, idempotent batches."""

from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.streaming import monitor, publish

# Own bad inputs: non-JSON text, blank line, empty object, array, null,
# missing status, lower-case status, repeated transaction id.
LINES = [
    '{"transaction_id": "a1", "status": "SUCCESS", "amount_inr": 100.0, "merchant": "M", "city": "C"}',
    '{"transaction_id": "a2", "status": "FAILED", "amount_inr": 50.5}',
    '{"transaction_id": "a3", "status": "pending", "amount_inr": 10.0}',
    '{"transaction_id": "a4", "amount_inr": 1.0}',
    '{"transaction_id": "a1", "status": "SUCCESS", "amount_inr": 100.0}',
    'not json at all',
    '',
    '{}',
    '[1]',
    'null',
]


def _write(spark, lines, path):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def test_parse_good_and_bad_batch(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    good, bad = monitor.parse_events(df)
    assert good.count() == 6          # 5 objects with fields + '{}'
    assert sorted(r.raw for r in bad.collect()) == sorted(["not json at all", "", "[1]", "null"])
    counts = {r.status: r.messages for r in monitor.status_counts(good).collect()}
    assert counts == {"success": 2, "failed": 1, "pending": 1, "unknown": 2}
    s = monitor.failure_summary(good).first()
    assert (s.total_messages, s.success_messages, s.failed_messages, s.pending_messages) == \
        (6, 2, 1, 1)
    assert s.failure_rate_pct == 16.7


def test_stream_equals_batch_and_resumes(spark):
    src = scratch_path(spark, "t-stream")
    _write(spark, LINES[:5], f"{src}/d1")
    ckpt, out = scratch_path(spark, "t-ckpt"), scratch_path(spark, "t-out")
    good, _ = monitor.parse_events(monitor.text_source(spark, src + "/*"))
    monitor.run_complete(monitor.status_counts(good), out, ckpt)
    first = {r.status: r.messages for r in spark.read.parquet(out).collect()}
    assert first == {"success": 2, "failed": 1, "pending": 1, "unknown": 1}
    # more input later: the same checkpoint resumes with the running state
    _write(spark, LINES[5:], f"{src}/d2")
    good, _ = monitor.parse_events(monitor.text_source(spark, src + "/*"))
    monitor.run_complete(monitor.status_counts(good), out, ckpt)
    second = {r.status: r.messages for r in spark.read.parquet(out).collect()}
    batch_good, _ = monitor.parse_events(spark.createDataFrame([(x,) for x in LINES],
                                                               "value string"))
    batch = {r.status: r.messages for r in monitor.status_counts(batch_good).collect()}
    assert second == batch


def test_append_log_and_latest(spark):
    src = scratch_path(spark, "t-up")
    _write(spark, LINES[:5], f"{src}/d1")
    ckpt, log = scratch_path(spark, "t-ckpt"), scratch_path(spark, "t-log")
    good, _ = monitor.parse_events(monitor.text_source(spark, src + "/*", 1))
    monitor.run_append(good.select("transaction_id", "status"), log, ckpt)
    _write(spark, ['{"transaction_id": "a2", "status": "SUCCESS"}'], f"{src}/d2")
    good, _ = monitor.parse_events(monitor.text_source(spark, src + "/*", 1))
    monitor.run_append(good.select("transaction_id", "status"), log, ckpt)
    latest = monitor.latest_events(spark.read.parquet(log), "transaction_id", [])
    got = {r.transaction_id: r.status for r in latest.collect()}
    assert got["a2"] == "SUCCESS" and got["a1"] == "SUCCESS" and len(got) == 4


def test_messages_keep_key_together(spark):
    df = spark.range(200).selectExpr("cast(id % 7 as string) as customer_id", "id")
    placed = publish.partition_of_keys(publish.to_messages(df, "customer_id"), 3)
    per_key = placed.groupBy("key").agg(F.countDistinct("partition").alias("p"))
    assert per_key.filter("p > 1").count() == 0


def test_first_messages_and_compaction(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    good, _ = monitor.parse_events(df)
    first = monitor.first_messages(good.filter("transaction_id is not null"), 2,
                                   ["transaction_id"]).collect()
    assert [r.transaction_id for r in first] == ["a1", "a1"]
    log = good.filter("transaction_id is not null").select(
        "transaction_id", "status").withColumn("_batch_id", F.lit(0))
    state = monitor.compact_log(log, "transaction_id", ["status"], scratch_path(spark, "t-state"))
    assert state.count() == 4
