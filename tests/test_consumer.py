"""Topics, start positions, portions of an exact size, versions, and landing of new files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import ordered
from strata.session import scratch_path
from strata.streaming import consumer, landing, monitor, publish

SCHEMA = "event_id long, ts string, user_id long, status string, amount double, props string"


def events(spark, ids, hot=True):
    rng = random.Random(4)
    rows = [(i, f"2024-01-01 00:{rng.randrange(60):02d}:00", 7 if hot and i % 3 == 0 else rng.randrange(20) if i % 17 else None,
             "SUCCESS", 1.0, None) for i in ids]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_topic_places_keys_and_orders_by_time(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BUCKET_ROWS", 40)
    df = events(spark, range(900))
    got = publish.place_in_topic(df, "user_id", 4, ["ts", "event_id"]).collect()
    assert len(got) == 900
    where = {}
    for r in got:
        where.setdefault(r.key, set()).add(r.partition)
    assert all(len(p) == 1 for p in where.values()) and where[None] == {0}
    for p in range(4):
        own = sorted((r for r in got if r.partition == p), key=lambda r: r.offset)
        assert [r.offset for r in own] == list(range(len(own)))
        times = [(v["ts"], v["event_id"]) for v in (json.loads(r.value) for r in own)]
        assert times == sorted(times)


def test_offsets_go_on_after_a_delivery(spark):
    path = scratch_path(spark, "t-topic")
    for ids in (range(50), range(50, 80)):
        there = monitor.read_messages(spark, path) if ids.start else None
        publish.publish_topic(events(spark, ids), "user_id", path, 3, ["ts", "event_id"],
                              after=consumer.end_positions(there) if there else None)
    rows = monitor.read_messages(spark, path).collect()
    for p in {r.partition for r in rows}:
        own = sorted((r.offset, json.loads(r.value)["event_id"] >= 50) for r in rows if r.partition == p)
        assert [o for o, _ in own] == list(range(len(own))) and [b for _, b in own] == sorted(b for _, b in own)


def streamed(spark, path, ckpt, out, starting):
    rows = consumer.positioned_source(spark, path, ckpt, starting, max_files_per_trigger=1)
    monitor.run_append(rows.select("partition", "offset"), out, ckpt)
    return sorted((r.partition, r.offset) for r in spark.read.schema("partition int, offset long").parquet(out).collect())


@pytest.mark.parametrize("starting", ["earliest", "latest", {0: 5, 1: 10 ** 6}])
def test_start_positions_are_kept_over_restarts(spark, starting):
    path, ckpt, out = (scratch_path(spark, x) for x in ("t-topic", "t-ckpt", "t-out"))
    publish.publish_topic(events(spark, range(60)), "user_id", path, 3, ["event_id"])
    ends = consumer.end_positions(monitor.read_messages(spark, path))
    streamed(spark, path, ckpt, out, starting)
    publish.publish_topic(events(spark, range(60, 90)), "user_id", path, 3, ["event_id"], after=ends)
    got = streamed(spark, path, ckpt, out, "earliest")      # what is stored holds
    positions = {"earliest": {}, "latest": ends}.get(starting, starting) if isinstance(starting, str) else starting
    want = [(r.partition, r.offset) for r in monitor.read_messages(spark, path).collect()
            if r.offset >= positions.get(r.partition, 0)]
    assert got == sorted(want)


def test_latest_of_an_empty_topic_and_bad_starts(spark):
    path, ckpt = scratch_path(spark, "t-topic"), scratch_path(spark, "t-ckpt")
    spark.createDataFrame([], monitor.MESSAGE).write.json(path)
    assert consumer.resolve_start(spark, path, ckpt, "latest") == {}
    publish.publish_topic(events(spark, range(9)), "user_id", path, 2, ["event_id"])
    assert consumer.resolve_start(spark, path, ckpt, "latest") == {}       # not moved to the new end
    with pytest.raises(ValueError):
        consumer.resolve_start(spark, path, scratch_path(spark, "t-ckpt"), "tomorrow")
    assert json.loads(consumer.kafka_offsets("pay", {1: 5, 0: -2})) == {"pay": {"0": -2, "1": 5}}


def good_stream(spark, path, files=1):
    source = monitor.message_source(spark, path, max_files_per_trigger=files)
    return monitor.parse_events(source, monitor.TABLE_EVENT, keep=monitor.POSITION)[0].select("event_id", *monitor.POSITION)


def test_portions_of_exact_size_over_several_micro_batches(spark):
    path, out, ckpt = (scratch_path(spark, x) for x in ("t-topic", "t-taken", "t-ckpt"))
    for k in range(5):          # five files or more, a micro-batch each
        part = publish.place_in_topic(events(spark, range(20 * k, 20 * k + 20)), "user_id", 2, ["event_id"])
        bad = F.when(F.col("offset") == 1, F.lit("{broken")).otherwise(F.col("value"))
        part.withColumn("value", bad).coalesce(1).write.mode("append").json(path)
    total = monitor.parse_events(monitor.read_messages(spark, path), monitor.TABLE_EVENT)[0].count()
    assert 80 < total < 100
    seen, numbers = [], []
    for i, n in enumerate((7, 30, 1, 25, 1000, 5)):
        taker = consumer.Taker(spark, out, ckpt)
        got = taker.take(good_stream(spark, path), n).collect()
        assert len(got) == min(n, total - len(seen))
        assert taker.taken() == (i + 1, len(seen) + len(got))
        if i == 0:
            assert taker.logged() < total       # the stream stopped when it had enough
        seen += [r.event_id for r in got]
        numbers += sorted(r.seq for r in got)
    assert numbers == list(range(1, total + 1)) and len(set(seen)) == total
    log = spark.read.parquet(f"{out}/log").collect()
    by_seq = sorted(log, key=lambda r: r.seq)
    assert [(r._batch_id, r.partition, r.offset) for r in by_seq] == sorted((r._batch_id, r.partition, r.offset) for r in log)


def test_a_micro_batch_that_runs_again_is_counted_once(spark):
    path, out, ckpt = (scratch_path(spark, x) for x in ("t-topic", "t-taken", "t-ckpt"))
    taker = consumer.Taker(spark, out, ckpt)
    rows = publish.place_in_topic(events(spark, range(30)), "user_id", 2, ["event_id"])
    for _ in range(2):
        assert taker._log(rows, 0) == 30
    assert taker._log(rows.limit(0), 1) == 30 and taker._log(rows.limit(4), 2) == 34 and taker.logged() == 34
    spark.createDataFrame([], monitor.MESSAGE).write.json(path)
    assert taker.take(good_stream(spark, path).withColumn("key", F.lit("")).withColumn("value", F.lit("")), 12).count() == 12
    with pytest.raises(ValueError):
        taker.take(good_stream(spark, path).withColumn("seq", F.lit(1)), 1)


def test_readers_see_whole_versions(spark):
    src, out, ckpt = (scratch_path(spark, x) for x in ("t-in", "t-versions", "t-ckpt"))
    assert monitor.current_version(spark, out) is None
    lines = [['{"status": "SUCCESS"}', '{"status": "FAILED"}'], ['{"status": "FAILED"}', "{}"], ["broken"]]
    seen = []
    for k, part in enumerate(lines):
        spark.createDataFrame([(x,) for x in part], "value string").coalesce(1).write.mode("append").text(f"{src}/d{k}")
        good, _ = monitor.parse_events(monitor.text_source(spark, src + "/*", 1))
        monitor.run_update(monitor.status_counts(good), ["status"], out, ckpt)
        seen.append({r.status: r.messages for r in monitor.current_version(spark, out).collect()})
    assert seen == [{"success": 1, "failed": 1}, {"success": 1, "failed": 2, "unknown": 1}, {"success": 1, "failed": 2, "unknown": 1}]
    # a version that is written but not committed is not seen
    spark.range(3).write.parquet(f"{out}/versions/v99")
    assert {r.status: r.messages for r in monitor.current_version(spark, out).collect()} == seen[-1]


def test_new_files_land_once(spark):
    src, bronze, ckpt = (scratch_path(spark, x) for x in ("t-drop", "t-bronze", "t-ckpt"))
    rows = spark.range(10).selectExpr("id", "cast(id % 3 as string) as s")
    counts = []
    for k in range(3):
        if k < 2:
            rows.where(F.col("id") % 2 == k).coalesce(1).write.parquet(f"{src}/d{k}")
        landing.land_new_files(spark, src + "/*", bronze, ckpt, rows.schema, "2024-01-01 00:00:00")
        counts.append(spark.read.parquet(bronze).count())
    assert counts == [5, 10, 10]
    got = spark.read.parquet(bronze).collect()
    assert sorted(r.id for r in got) == list(range(10))
    assert all(f"/d{r.id % 2}/" in r._source_file and r._batch_id == f"files-{r.id % 2}" for r in got)
    assert {r._row_hash for r in got if r.id == 4} == {spark.sql("select md5('4|1') h").first().h}
