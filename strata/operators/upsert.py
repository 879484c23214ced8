"""Upsert (MERGE: matched -> update all, not matched -> insert all) for
tables without row-level operations.

Result = source rows  ∪  target rows that no source row matches.
Keys compare with ``=``, so a null key never matches and such rows are kept
from both sides, as MERGE does. A source holding two rows for one key would
make MERGE ambiguous; we keep the latest by ``order`` or refuse.

Writing back: a plain table cannot be overwritten while it is read, so
:func:`upsert_into_path` either writes a new version folder (small tables),
or rewrites only the partitions the source touches with dynamic partition
overwrite (large tables partitioned by a function of the key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.windows import latest_per_key
from strata.session import scratch_path


class AmbiguousSource(ValueError):
    """The source has several rows for one key and no order was given."""


def dedupe_source(source: DataFrame, keys: Sequence[str],
                  order: Sequence[str] | None = None) -> DataFrame:
    """One row per non-null key (latest by ``order``); null-key rows all kept."""
    keys = list(keys)
    has_null = None
    for k in keys:
        c = F.col(k).isNull()
        has_null = c if has_null is None else has_null | c
    keyed = source.filter(~has_null)
    nulls = source.filter(has_null)
    if order:
        keyed = latest_per_key(keyed, keys, order, rn_col=None)
    else:
        dup = (keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                    .filter(F.col("n") > 1).limit(1).count())
        if dup:
            raise AmbiguousSource(f"source has repeated keys {keys}; pass order=")
    return keyed.unionByName(nulls)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           order: Sequence[str] | None = None, deduped: bool = False) -> DataFrame:
    """Merged table as a DataFrame (columns of ``target``, in its order).

    The anti join shuffles on the keys; the optimizer broadcasts a source it
    finds small. ``deduped`` tells that the source has one row per key already.
    """
    keys = list(keys)
    src = (source if deduped else dedupe_source(source, keys, order)).select(*target.columns)
    kept = target.join(src.select(*keys), keys, "left_anti")
    return kept.unionByName(src)


def touched_partitions(target: DataFrame, source: DataFrame, partition_col: str) -> DataFrame:
    """Rows of ``target`` in partitions that ``source`` has rows for, the null one too.

    The static range prunes the target's partitions at planning; the null-safe
    semi join then leaves out those between that the source does not touch."""
    p = F.col(partition_col)
    seen = source.agg(F.min(p).alias("lo"), F.max(p).alias("hi"), F.count_if(p.isNull()).alias("nulls")).first()
    near = p.between(F.lit(seen.lo), F.lit(seen.hi)) if seen.lo is not None else F.lit(False)
    near = near | p.isNull() if seen.nulls else near
    touched = source.select(p.alias("__touched")).distinct()
    return target.where(near).join(touched, p.eqNullSafe(F.col("__touched")), "left_semi")


def upsert_into_path(source: DataFrame, path: str, keys: Sequence[str],
                     order: Sequence[str] | None = None,
                     partition_col: str | None = None,
                     new_path: str | None = None, staged: bool = False) -> str:
    """Merge ``source`` into the parquet table at ``path``; returns the path
    holding the merged table.

    * ``partition_col`` given (a column that is a function of the key, e.g.
      the pickup date): only the partitions present in the source are read,
      merged and rewritten with dynamic partition overwrite, in place.
    * otherwise: the merged table is written to ``new_path`` (a new version
      folder) and that path is returned; the caller switches its pointer.

    The source is deduplicated once, into the shared scratch folder; with ``staged``
    it has one row per key already and is read from files.
    """
    spark = source.sparkSession
    target = spark.read.parquet(path)
    if not partition_col and not new_path:
        raise ValueError("new_path is required for an unpartitioned table")
    src = (source if staged else dedupe_source(source, keys, order)).select(*target.columns)
    if not staged:
        path_of = scratch_path(spark, "upsert")
        src.write.parquet(path_of)
        src = spark.read.schema(src.schema).parquet(path_of)
    if partition_col:
        merged = upsert(touched_partitions(target, src, partition_col), src, keys, deduped=True)
        (merged.hint("rebalance", partition_col).write.mode("overwrite")
               .option("partitionOverwriteMode", "dynamic")
               .partitionBy(partition_col).parquet(path))
        return path
    upsert(target, src, keys, deduped=True).write.mode("errorifexists").parquet(new_path)
    return new_path
