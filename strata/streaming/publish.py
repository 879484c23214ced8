"""Keyed JSON publisher: any table -> (key, value) messages.

The message key decides placement. On Kafka the producer hashes the key to
a topic partition itself, so per-key order holds whatever Spark's
partitioning. For files, messages are *rebalanced* by key: each key's
messages share a file, except that AQE splits a key holding a large share
of the data over several files (a hot key never becomes one giant task).

With ``topic_partitions`` the files are a topic: a message's partition is the
hash of its key, so a key lies in one partition, and its offset is its place there
by event time. Offsets come from one order over (partition, event time), cut into
buckets: a partition that a hot key makes large is written by several tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators import ordered


def to_messages(df: DataFrame, key_col: str, fields: Sequence[str] | None = None) -> DataFrame:
    """(key, value): key = ``key_col`` as text, value = the row as JSON text."""
    fields = list(fields or df.columns)
    return df.select(F.col(key_col).cast("string").alias("key"),
                     F.to_json(F.struct(*fields)).alias("value"))


def place_by_key(messages: DataFrame, partitions: int | None = None) -> DataFrame:
    """Hash-place messages by key (REBALANCE: skewed keys may be split;
    without ``partitions`` AQE picks the count from the data size)."""
    if partitions:
        return messages.hint("rebalance", partitions, "key")
    return messages.hint("rebalance", "key")


def partition_of(key: str, partitions: int) -> Column:
    """The topic partition of a key; messages without key go to partition 0."""
    return F.coalesce(F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(F.col(key)), F.lit(partitions))), F.lit(0)).cast("int")


def place_in_topic(df: DataFrame, key_col: str, partitions: int, time_order: Sequence[str],
                   fields: Sequence[str] | None = None, partition: Column | None = None,
                   after: Mapping[int, int] | None = None) -> DataFrame:
    """(key, value, partition, offset) of every row of ``df``.

    Offsets count from 0, or from where ``after`` says that a partition ends, without
    gaps, by the ``time_order`` columns (event time and what settles ties). ``partition``
    is given where the producer chooses it itself instead of by the key's hash."""
    keyed = df.select(F.col(key_col).cast("string").alias("key"), F.to_json(F.struct(*(fields or df.columns))).alias("value"),
                      *[F.col(c).alias(f"__t{i}") for i, c in enumerate(time_order)],
                      *([partition.cast("int").alias("partition")] if partition is not None else []))
    if partition is None:
        keyed = keyed.withColumn("partition", partition_of("key", partitions))
    times = [f"__t{i}" for i in range(len(time_order))]
    placed = ordered.stored(ordered.positions(keyed, ["partition", *times], col="__pos"), "placed")
    first = placed.groupBy("partition").agg(F.min("__pos").alias("__first"))          # a row per partition
    ends = F.lit(0)
    if after:
        ends = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p, o in sorted(after.items()) for x in (p, o)]),
                                           F.col("partition")), F.lit(0))
    return placed.join(F.broadcast(first), "partition").select(
        "key", "value", "partition", (F.col("__pos") - F.col("__first") + ends).cast("long").alias("offset"))


def publish_topic(df: DataFrame, key_col: str, path: str, partitions: int, time_order: Sequence[str],
                  fields: Sequence[str] | None = None, partition: Column | None = None,
                  after: Mapping[int, int] | None = None) -> None:
    """Adds the rows of ``df`` to a folder of messages (see :func:`place_in_topic`)."""
    place_in_topic(df, key_col, partitions, time_order, fields, partition, after).write.mode("append").json(path)


def publish_files(df: DataFrame, key_col: str, path: str, partitions: int | None = None,
                  fields: Sequence[str] | None = None) -> None:
    """Write messages as JSON lines with key, value, partition and offset, placed
    by key (``partitions`` target files; by default AQE sizes them).

    The partition is the writing task's number and the offset the message's
    place in it, what a broker would assign on arrival. A null key is left out
    of its line and read back as null."""
    placed = place_by_key(to_messages(df, key_col, fields), partitions)
    row = F.monotonically_increasing_id()        # the lower 33 bits count a task's rows
    (placed.withColumns({"partition": F.spark_partition_id(),
                         "offset": row.bitwiseAND(F.lit((1 << 33) - 1))})
           .write.mode("overwrite").json(path))


def publish_kafka(df: DataFrame, key_col: str, servers: str, topic: str,
                  fields: Sequence[str] | None = None) -> None:
    """Write messages to a Kafka topic (acks from all replicas, 3 retries,
    500 ms back-off). Needs the Kafka connector on the classpath."""
    (to_messages(df, key_col, fields).write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("kafka.acks", "all").option("kafka.retries", "3")
        .option("kafka.retry.backoff.ms", "500").save())


def partition_of_keys(messages: DataFrame, partitions: int) -> DataFrame:
    """(key, partition) after :func:`place_by_key` — placement is by key."""
    placed = place_by_key(messages, partitions)
    return placed.select("key", F.spark_partition_id().alias("partition"))
