"""Window operators: rolling rows, change vs previous, rank, latest per key.

Frames without ``partition_by`` run in one task; use them only on inputs
whose size is bounded by a calendar or a dimension (one row per day, per
zone), i.e. after aggregation — never on raw facts. ``latest_per_key`` is
limited per task before its shuffle (WindowGroupLimit), so a key holding a
third of all rows does not land whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _spec(order: str | Column | Sequence, partition_by: Sequence[str] | None = None):
    order = [order] if isinstance(order, (str, Column)) else list(order)
    w = Window.orderBy(*order)
    if partition_by:
        w = Window.partitionBy(*partition_by).orderBy(*order)
    return w


def rolling_mean(value: str, order, rows: int = 7,
                 partition_by: Sequence[str] | None = None) -> Column:
    """Mean over the current row and the ``rows - 1`` rows before it."""
    return F.avg(value).over(_spec(order, partition_by).rowsBetween(-(rows - 1), 0))


def change(value: str, order, partition_by: Sequence[str] | None = None) -> Column:
    """value - previous value (null on the first row)."""
    return F.col(value) - F.lag(value, 1).over(_spec(order, partition_by))


def rank_desc(value: str, partition_by: Sequence[str] | None = None,
              dense: bool = False) -> Column:
    """Rank by ``value`` descending; ties share a rank (gaps unless ``dense``)."""
    fn = F.dense_rank if dense else F.rank
    return fn().over(_spec(F.col(value).desc(), partition_by))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   rn_col: str | None = "rn") -> DataFrame:
    """Keep one row per key: the one with the largest ``order`` tuple
    (``row_number() over (partition by keys order by order desc) = 1``).

    Spark plans this as a *partial* WindowGroupLimit before the shuffle: each
    task keeps only its best row per key, so a key holding a third of all
    rows ships one row per task, not all of them. ``order`` should break all
    ties; ``rn_col`` keeps the row-number column (always 1), or drops it.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    name = rn_col or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) == 1)
    return out if rn_col else out.drop(name)


def row_ids(df: DataFrame, order: Sequence[str], col: str = "row_id",
            partitions: int | None = None) -> DataFrame:
    """Consecutive 1-based ids following ``order`` (make it a total order).

    A plain ``row_number()`` without ``partitionBy`` sorts everything in one
    task. Instead the rows are shuffled once into ranges of ``order``, sorted
    there and frozen by a reliable checkpoint together with the number that Spark gives
    a task's rows as they come (the task above, the row below 33 bits). Ids add the
    rows of earlier tasks; only these counts are broadcast, one row per task.
    """
    order = list(order)
    # without an explicit count AQE sizes the ranges from the data
    ranged = df.repartitionByRange(partitions, *order) if partitions \
        else df.repartitionByRange(*order)
    staged = (ranged.sortWithinPartitions(*order)
              .withColumn("__m", F.monotonically_increasing_id()).checkpoint(eager=True))
    task, row = F.shiftright("__m", 33), F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    counts = staged.groupBy(task.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__p", F.coalesce(F.sum("__n").over(
            Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("__off"))
    return (staged.withColumn("__p", task).join(F.broadcast(offsets), "__p")
                  .withColumn(col, F.col("__off") + row + 1)
                  .drop("__p", "__m", "__off"))


def sparse_ids(df: DataFrame, col: str = "row_id") -> DataFrame:
    """Unique, increasing (not consecutive) ids without a shuffle."""
    return df.withColumn(col, F.monotonically_increasing_id())
