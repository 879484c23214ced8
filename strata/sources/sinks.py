"""Sinks: table overwrite / append, empty-table creation, files, audit
history, view-or-table materialization, quarantine output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def by_partition(df: DataFrame, cols) -> DataFrame:
    """Group rows by the folder they are written to before a partitioned
    write (REBALANCE hint): each partition value gets a few files of about
    the advisory size instead of one small file per task, and AQE splits a
    value holding a large share of the rows over several tasks."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.hint("rebalance", *cols)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database of two-level table names (``db.table``) if absent."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def register_path(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                  partitioned: bool = False) -> DataFrame:
    """(Re)point catalog table ``name`` at files already written to ``path``
    (an external table: dropping it never deletes the files). Partition
    folders are recovered into the catalog when ``partitioned``."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.catalog.createTable(name, path=path, source=fmt)
    if partitioned:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def overwrite_table(df: DataFrame, name: str, path: str | None = None,
                    partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Replace table ``name`` (schema included); ``path`` makes it external."""
    if partition_by:
        df = by_partition(df, partition_by)
    w = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int,
                   path: str | None = None, fmt: str = "parquet") -> None:
    """Table bucketed (and sorted) on its join key. Two tables bucketed the
    same way on the same key join without shuffling either side, so the
    bronze facts that are always joined on one key pay that shuffle once, at
    write time, instead of in every downstream query."""
    w = (df.write.format(fmt).mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys))
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Rewrite only the partitions present in ``df`` (re-running one batch
    replaces that batch and leaves the others)."""
    (by_partition(df, partition_by).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def append_table(df: DataFrame, name: str, fmt: str = "parquet",
                 path: str | None = None) -> None:
    """Append to table ``name`` (created on first use; ``path`` makes it
    external, otherwise it lives in the catalog's warehouse folder)."""
    w = df.write.format(fmt).mode("append")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def ensure_table(spark: SparkSession, like: DataFrame, name: str,
                 path: str | None = None, fmt: str = "parquet") -> bool:
    """Create an empty table with ``like``'s schema if absent; True if created."""
    if spark.catalog.tableExists(name):
        return False
    w = like.limit(0).write.format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return True


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    if partition_by:
        df = by_partition(df, partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_quarantine(bad: DataFrame, path: str) -> None:
    """Append rejected rows to the bad-records folder."""
    bad.write.mode("append").parquet(path)


def write_routed(tagged: DataFrame, path: str, flag_col: str, flag: Column) -> None:
    """One pass over a tagged frame: rows land under ``flag_col=true/false``
    sub-folders (e.g. quarantined or not), readable alone by partition
    pruning."""
    tagged.withColumn(flag_col, flag).write.mode("overwrite").partitionBy(flag_col).parquet(path)


def persist(df: DataFrame, path: str) -> DataFrame:
    """Write a layer once and read it back: later plans start from the
    written columns (pruned, pushed down) instead of recomputing joins, and
    the lineage is cut, so a lost executor re-reads files instead of
    replaying the upstream shuffles."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize(df: DataFrame, name: str, as_table: bool = False,
                path: str | None = None) -> DataFrame:
    """A model as a view (inlined by later plans) or as a table (a cut point)."""
    if as_table:
        overwrite_table(df, name, path)
        return df.sparkSession.table(name)
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def run_history(audit: DataFrame, n: int = 5, ts_col: str = "run_ts") -> DataFrame:
    """The latest ``n`` audit records (top-n: a limit is the feature here)."""
    return audit.orderBy(F.col(ts_col).desc(), F.col("batch_id").desc()).limit(n)
