"""A consumer's positions: where it starts, and taking an exact number of messages.

Start positions are a map from a topic's partition to an offset. They are resolved
once, when a consumer first starts, and kept below its checkpoint, so a restarted
consumer goes by the same ones.

:class:`Taker` numbers good messages in the order in which they arrive (micro-batch,
then partition and offset) and commits the running count with each micro-batch. A
portion ends at an exact number, also within a micro-batch: what is left of it is
already logged and is the beginning of the next portion.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import ordered
from strata.sources.readers import read_optional
from strata.streaming.monitor import MESSAGE, POSITION, read_messages

Positions = Mapping[int, int]


# ---------------------------------------------------------------- starting

def end_positions(messages: DataFrame) -> dict[int, int]:
    """The next offset of each partition (one row per partition reaches the driver)."""
    ends = messages.groupBy("partition").agg((F.max("offset") + 1).alias("next"))
    return {r["partition"]: r["next"] for r in ends.collect()}


def kafka_offsets(topic: str, positions: Positions) -> str:
    """The map as a Kafka source's ``startingOffsets``; a partition that is not in it
    has to be added by the caller (Kafka wants all of them; -2 is the earliest, -1 the latest)."""
    return json.dumps({topic: {str(p): o for p, o in sorted(positions.items())}})


def resolve_start(spark: SparkSession, path: str, checkpoint: str, starting: str | Positions) -> dict[int, int]:
    """Positions of a consumer with this checkpoint.

    The first call turns ``earliest``, ``latest`` (the end of what is published now) or a
    map into positions and stores them; later calls return the stored ones, whatever
    ``starting`` says. A partition without position is read from its beginning."""
    stored = f"{checkpoint}/start_positions"
    known = read_optional(spark, stored, "parquet")
    if known is None:
        if starting == "earliest":
            found = {}
        elif starting == "latest":
            found = end_positions(read_messages(spark, path))
        elif isinstance(starting, Mapping):
            found = {int(p): int(o) for p, o in starting.items()}
        else:
            raise ValueError(f"start at earliest, latest or a map of offsets, not {starting!r}")
        (spark.createDataFrame(list(found.items()), "partition int, offset long").coalesce(1)
              .write.mode("overwrite").parquet(stored))
        return found
    return {r["partition"]: r["offset"] for r in known.collect()}


def at_or_after(positions: Positions) -> Column:
    """Messages that a consumer with these positions reads."""
    if not positions:
        return F.lit(True)
    start = F.create_map(*[F.lit(x) for p, o in sorted(positions.items()) for x in (p, o)])
    return F.col("offset") >= F.coalesce(F.try_element_at(start, F.col("partition")), F.lit(0))


def positioned_source(spark: SparkSession, path: str, checkpoint: str, starting: str | Positions = "earliest",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Folder of published messages as a stream from the consumer's start positions."""
    positions = resolve_start(spark, path, checkpoint, starting)
    r = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.json(path).where(at_or_after(positions))


# ---------------------------------------------------------------- taking

class Taker:
    """Takes messages of a stream in portions of an exact size.

    ``path`` holds the numbered log (a folder per micro-batch), the count of each micro-batch
    and the portions taken; ``checkpoint`` is the stream's. All are written by
    number, the count of a micro-batch last, so one that runs again is counted once.
    A new object over the same folders goes on behind the last portion."""

    def __init__(self, spark: SparkSession, path: str, checkpoint: str, order: Sequence[str] = POSITION):
        self.spark, self.path, self.checkpoint, self.order = spark, path, checkpoint, list(order)

    def _counts(self) -> DataFrame:
        """``(_batch_id, messages)`` of the committed micro-batches."""
        schema = "messages long, _batch_id long"
        there = read_optional(self.spark, f"{self.path}/counts", "parquet") is not None
        return self.spark.read.schema(schema).parquet(f"{self.path}/counts") if there else self.spark.createDataFrame([], schema)

    def logged(self) -> int:
        """Messages of all committed micro-batches."""
        return self._counts().agg(F.coalesce(F.sum("messages"), F.lit(0))).first()[0]

    def taken(self) -> tuple[int, int]:
        """Portions taken and the number of the last message in them."""
        done = read_optional(self.spark, f"{self.path}/taken", "parquet")
        row = done.agg(F.count(F.lit(1)), F.max("upto")).first() if done is not None else (0, 0)
        return row[0], row[1] or 0

    def _overwrite(self, df: DataFrame, name: str, key: str, number: int) -> None:
        (df.withColumn(key, F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(key).parquet(f"{self.path}/{name}"))

    def _log(self, batch: DataFrame, batch_id: int) -> int:
        """Numbers and logs a micro-batch; returns the messages logged so far.

        One whose count is committed runs again only if the stream was stopped before its own
        commit: it is left as it is, as portions of it may be in use."""
        own = F.col("_batch_id") == batch_id
        before, done, known = self._counts().agg(
            F.coalesce(F.sum(F.when(F.col("_batch_id") < batch_id, F.col("messages"))), F.lit(0)),
            F.sum(F.when(own, F.col("messages"))), F.count_if(own)).first()
        if known:
            return before + done
        arrived = ordered.stored(batch, "micro-batch")
        n = arrived.count()
        rows = ordered.positions(arrived, self.order, col="__seq")
        numbered = rows.withColumn("seq", F.col("__seq") + F.lit(before)).drop("__seq")
        self._overwrite(numbered, "log", "_batch_id", batch_id)
        self._overwrite(self.spark.range(1).select(F.lit(n).cast("long").alias("messages")), "counts", "_batch_id", batch_id)
        return before + n

    def take(self, good: DataFrame, n: int) -> DataFrame:
        """The next ``n`` messages (fewer if the stream has no more), with their number ``seq``.

        ``good`` is a stream of messages with the ``order`` columns. It runs only until
        enough messages are logged: the micro-batch that reaches the number is the last one. Columns named
        ``seq``, ``__seq`` or ``_batch_id`` are not allowed in it."""
        if clash := {"seq", "__seq", "_batch_id"} & set(good.columns):
            raise ValueError(f"columns {sorted(clash)} are the consumer's own")
        portion, before = self.taken()
        goal, reached = before + n, threading.Event()
        if self.logged() < goal:
            def write(batch: DataFrame, batch_id: int) -> None:
                if not reached.is_set() and self._log(batch, batch_id) >= goal:
                    reached.set()
                elif reached.is_set():
                    raise _Enough       # a micro-batch begun meanwhile is left for the next run
            q = (good.writeStream.outputMode("append").foreachBatch(write)
                 .option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start())
            try:
                while not q.awaitTermination(0.1):
                    if reached.is_set():
                        q.stop()
            except Exception:
                if not reached.is_set():
                    raise
        upto = min(goal, self.logged())
        self._overwrite(self.spark.range(1).select(F.lit(upto).cast("long").alias("upto")), "taken", "portion", portion)
        return self.between(before, upto, good)

    def between(self, after: int, upto: int, like: DataFrame) -> DataFrame:
        """Logged messages numbered ``after + 1`` to ``upto``; only the micro-batches that hold them are read."""
        batches, end = [], 0
        for r in self._counts().orderBy("_batch_id").collect():      # a row per micro-batch
            if end < upto and end + r["messages"] > after:
                batches.append(r["_batch_id"])
            end += r["messages"]
        schema = like.schema.add("seq", "long").add("_batch_id", "long")
        if not batches:
            return self.spark.createDataFrame([], schema).drop("_batch_id")
        log = self.spark.read.schema(schema).parquet(f"{self.path}/log")
        return log.where(F.col("_batch_id").isin(batches) & (F.col("seq") > after) & (F.col("seq") <= upto)).drop("_batch_id")


class _Enough(Exception):
    """The portion is full."""


__all__ = ["Positions", "Taker", "at_or_after", "end_positions", "kafka_offsets", "positioned_source", "resolve_start"]
