"""Keyed JSON event stream: parse, count by status, failure rate, upsert.

Sources are Structured Streaming sources: a Kafka topic (when the Kafka
connector is on the classpath) or a folder of JSON-lines text files. Offsets
and aggregation state live in the query checkpoint, so a restarted query
resumes where it stopped; sinks are idempotent per micro-batch, so a retried
batch rewrites exactly what it wrote before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, LongType, StringType,
                               StructField, StructType)

from strata.functions.columns import percent
from strata.operators.windows import latest_per_key
from strata.sources.readers import read_optional

# Fixed value: fields of one payment event message.
PAYMENT_EVENT = StructType([
    StructField("transaction_id", StringType()),
    StructField("timestamp", StringType()),
    StructField("customer_id", StringType()),
    StructField("customer_name", StringType()),
    StructField("merchant", StringType()),
    StructField("category", StringType()),
    StructField("amount_inr", DoubleType()),
    StructField("city", StringType()),
    StructField("card_type", StringType()),
    StructField("card_last4", StringType()),
    StructField("status", StringType()),
    StructField("is_international", BooleanType()),
    StructField("device", StringType()),
])

# Fields of the test-table events published as messages (see publish.py).
TABLE_EVENT = StructType([
    StructField("event_id", LongType()),
    StructField("ts", StringType()),
    StructField("user_id", LongType()),
    StructField("status", StringType()),
    StructField("amount", DoubleType()),
    StructField("props", StringType()),
])

CORRUPT = "_corrupt_record"
# The statuses the summary always reports (0 when absent).
SUMMARY_STATUSES = ("success", "failed", "pending")


# ------------------------------------------------------------------ sources

def text_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                ) -> DataFrame:
    """Folder of JSON-lines files as a stream of ``value`` strings."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


# A published message as it lies in a file (see publish.py).
MESSAGE = "key string, value string, partition int, offset long"


def message_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                   starting: str = "earliest") -> DataFrame:
    """Folder of published messages as a stream of (key, value, partition, offset).

    ``starting`` is ``earliest`` or a timestamp: messages of files last written
    before it are left out (the file stand-in for a topic's start offset)."""
    r = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = r.json(path)
    if starting != "earliest":
        rows = rows.filter(F.col("_metadata.file_modification_time")
                           >= F.lit(starting).cast("timestamp"))
    return rows


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """The same messages as a batch."""
    return spark.read.schema(MESSAGE).json(path)


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting: str = "earliest", max_offsets: int | None = None) -> DataFrame:
    """Kafka topic as a stream of (key, value, partition, offset) with text
    key and value. ``starting``: ``earliest``, ``latest`` or the offsets of each partition
    as ``consumer.kafka_offsets`` writes them. Needs the Kafka connector on the classpath."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets))
    return r.load().select(F.col("key").cast("string").alias("key"),
                           F.col("value").cast("string").alias("value"),
                           "partition", "offset", "timestamp")


# ------------------------------------------------------------------ parsing

def parse_events(lines: DataFrame, schema: StructType = PAYMENT_EVENT,
                 value_col: str = "value", keep: Sequence[str] = ()
                 ) -> tuple[DataFrame, DataFrame]:
    """(good, bad) from JSON text.

    Bad: text that is not a JSON object (``[1]``, ``null``, broken text) or
    a blank line; bad rows keep the raw text in ``raw``. Good rows are the
    parsed fields (missing fields are null; ``{}`` is a good, empty event),
    plus the ``keep`` columns of the source (e.g. partition and offset)."""
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])
    parsed = lines.withColumn("__j", F.from_json(
        F.col(value_col), full,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    is_bad = F.col("__j").isNull() | F.col(f"__j.{CORRUPT}").isNotNull()
    good = parsed.filter(~is_bad).select(*keep, *[F.col(f"__j.{f.name}") for f in schema.fields])
    bad = parsed.filter(is_bad).select(*keep, F.col(value_col).alias("raw"))
    return good, bad


def normalized_status(status: str = "status") -> F.Column:
    """Lower-case status; a missing status counts as ``unknown``."""
    return F.lower(F.coalesce(F.col(status), F.lit("UNKNOWN")))


def status_counts(good: DataFrame, status: str = "status") -> DataFrame:
    """Running count per status (a stateful aggregate in complete mode)."""
    return good.groupBy(normalized_status(status).alias("status")).agg(
        F.count(F.lit(1)).alias("messages"))


def failure_summary(good: DataFrame, status: str = "status") -> DataFrame:
    """Running totals: messages, one count per summary status, failure %."""
    s = normalized_status(status)
    aggs = [F.count(F.lit(1)).alias("total_messages")]
    aggs += [F.count_if(s == F.lit(x)).alias(f"{x}_messages") for x in SUMMARY_STATUSES]
    return good.agg(*aggs).withColumn(
        "failure_rate_pct", percent("failed_messages", "total_messages", 1))


# -------------------------------------------------------------------- sinks

def run_complete(agg: DataFrame, out_path: str, checkpoint: str) -> None:
    """Drive a complete-mode aggregate over everything available, then stop.

    Each micro-batch overwrites ``out_path`` with the whole current result,
    so a replayed batch writes the same table again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    q = (agg.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def run_update(agg: DataFrame, keys: Sequence[str], out_path: str, checkpoint: str) -> None:
    """Drive a running aggregate in update mode: only the groups that a micro-batch
    changed leave the query.

    They replace the groups of the same ``keys`` (null-safe; none: the one row) in
    the version before, which is written as a version of its own and committed by a
    small record afterwards. A reader (:func:`current_version`) sees whole versions
    only, at any time; a replayed micro-batch writes its version again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _version(spark, out_path, batch_id)
        changed = batch
        if before is not None:
            old = spark.read.parquet(f"{out_path}/versions/v{before}")
            if keys:
                new = batch.select(*[F.col(k).alias(f"__new_{k}") for k in keys])
                same = [F.col(k).eqNullSafe(F.col(f"__new_{k}")) for k in keys]
                changed = batch.unionByName(old.join(new, same, "left_anti"))
            elif batch.isEmpty():
                changed = old
        changed.write.mode("overwrite").parquet(f"{out_path}/versions/v{batch_id}")
        (spark.range(1).select(F.lit(batch_id).cast("long").alias("version")).coalesce(1)
              .write.mode("overwrite").parquet(f"{out_path}/commits/c{batch_id}"))

    q = (agg.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def _version(spark: SparkSession, out_path: str, below: int | None = None) -> int | None:
    """The newest committed version (below a number)."""
    commits = read_optional(spark, f"{out_path}/commits/*", "parquet")
    if commits is None:
        return None
    rows = commits if below is None else commits.where(F.col("version") < below)
    return rows.agg(F.max("version")).first()[0]


def current_version(spark: SparkSession, out_path: str) -> DataFrame | None:
    """The newest whole result of :func:`run_update`; None before the first."""
    version = _version(spark, out_path)
    return None if version is None else spark.read.parquet(f"{out_path}/versions/v{version}")


def run_append(rows: DataFrame, out_path: str, checkpoint: str,
               batch_col: str = "_batch_id") -> None:
    """Drive an append stream: each micro-batch lands in its own
    ``batch_col=<id>`` partition (dynamic overwrite: a retried batch
    replaces only itself)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn(batch_col, F.lit(batch_id)).write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic")
              .partitionBy(batch_col).parquet(out_path))

    q = (rows.writeStream.outputMode("append").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


# Where a message lies in its topic or folder: the last tie-break.
POSITION = ("partition", "offset")


def _delivery(log: DataFrame, order: Sequence[str], batch_col: str) -> list[str]:
    return [*order, batch_col, *[c for c in POSITION if c in log.columns and c not in order]]


def latest_events(log: DataFrame, key: str, order: Sequence[str],
                  batch_col: str = "_batch_id") -> DataFrame:
    """Merge-on-read upsert: one row per key, the latest by ``order`` (event
    time), then by micro-batch, then by partition and offset where the log has
    them: a later delivery wins, also inside one micro-batch."""
    return latest_per_key(log, [key], _delivery(log, order, batch_col), rn_col=None).drop(batch_col)


def compact_log(log: DataFrame, key: str, order: Sequence[str], out_path: str,
                batch_col: str = "_batch_id", state: DataFrame | None = None,
                after: int = -1) -> DataFrame:
    """Next version of the state table, written to ``out_path``: one row per key,
    the latest of ``state`` (the version before) and of the log's micro-batches
    later than ``after``. Older micro-batches are not read (a partition filter)
    and may be deleted. Returns the written state, ``batch_col`` included."""
    new = log.filter(F.col(batch_col) > after)
    rows = new if state is None else state.unionByName(new)
    (latest_per_key(rows, [key], _delivery(rows, order, batch_col), rn_col=None)
        .write.mode("errorifexists").parquet(out_path))
    return log.sparkSession.read.parquet(out_path)


def last_batch(log: DataFrame, batch_col: str = "_batch_id") -> int:
    """The newest micro-batch of the log (-1: none): ``after`` of the next compaction."""
    return log.agg(F.coalesce(F.max(batch_col), F.lit(-1))).first()[0]


def first_messages(good: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Exactly the first ``n`` good messages in ``order`` (e.g. partition,
    offset) from a batch read of the topic or folder — the bounded
    counterpart of a consumer that stops after ``n`` messages. A stream is
    paced instead with ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``."""
    return good.orderBy(*order).limit(n)
