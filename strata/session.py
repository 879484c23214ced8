"""Session construction and shared scratch locations.

Scratch data that outlives one task (stream inputs, checkpoints, upsert
versions) always goes below ``spark.checkpoint.dir``: on a cluster that is
the shared folder the platform names; we only fill it in when it is unset
(local runs and tests).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that every strata job relies on. AQE re-plans joins and shuffle
# partition counts at run time; skew-join splits oversized join partitions.
# Spark's own broadcast decision trusts file-size estimates (compressed
# parquet is several times smaller in memory), so it is kept to ~1 MB;
# larger dimensions are broadcast only through ``enrich.maybe_broadcast``,
# which counts rows first.
BASE_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": str(1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(app: str = "strata", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Get or create a session with the strata defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(shuffle_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Settings sized for a large cluster run.

    ``shuffle_bytes`` is the expected size of the largest shuffle (after
    pruning and filtering, usually well below the input size). The initial
    shuffle partition count makes each partition about
    ``target_partition_bytes`` so none has to spill; AQE then coalesces the
    small ones and splits skewed join partitions. Scan tasks read up to
    256 MB each."""
    parts = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    }


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_go(spark: SparkSession):
    """The shuffle files of queries run within go as each ends, not when the driver happens to collect garbage.

    It holds for tables made or written within; one that is gathered again makes its shuffles again."""
    return _set(spark, SHUFFLES_GO, "true")


def small_batches(spark: SparkSession):
    """Rows go to Python workers some 4 MB at a time in queries run within, however long their texts are."""
    return _set(spark, BATCH_BYTES, str(4 << 20))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the setting, else the context's own folder.

    Only a local session gets a temporary folder of its own."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
        root = context.getCheckpointDir()       # a running session's own setting cannot be changed
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/strata-{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so a path can be tested with ``os``."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path",
           "local_path", "scale_conf", "shuffles_go", "small_batches", "BASE_CONF"]
