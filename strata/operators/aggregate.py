"""Aggregates: frequency, global stats, distinct / duplicate counts, null
profile, exact median fill, metric rows (the "aggregator" family).

Everything is a ``groupBy().agg`` or a global ``agg``, so Spark combines
partially in every task before the shuffle; no group is gathered whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import half_up
from strata.operators import selection


def frequency(df: DataFrame, col: str, count_col: str = "count") -> DataFrame:
    """Rows per value of ``col``, most frequent first (ties by value)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
              .orderBy(F.col(count_col).desc(), F.col(col).asc_nulls_last()))


def global_stats(df: DataFrame, col: str, prefix: str = "") -> DataFrame:
    """One row: count of values, sum, mean, max, min of ``col``."""
    c = F.col(col)
    return df.agg(F.count(c).alias(f"{prefix}n"), F.sum(c).alias(f"{prefix}total"),
                  F.avg(c).alias(f"{prefix}mean"), F.max(c).alias(f"{prefix}max"),
                  F.min(c).alias(f"{prefix}min"))


def distinct_report(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """(column_name, rows, distinct_values, duplicate_rows) per column: distinct
    values count null as one value; duplicate rows are the rows beyond the first
    of each value (nulls equal).

    A group-by per column: each reads its own column only and is combined in the
    tasks, where distinct counts side by side would copy every row per column."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    out = None
    for c in cols:
        groups = df.groupBy(F.col(c)).agg(F.count(F.lit(1)).alias("__n"))
        one = groups.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_values")).select(
            F.lit(c).alias("column_name"), "rows", "distinct_values",
            (F.col("rows") - F.col("distinct_values")).alias("duplicate_rows"))
        out = one if out is None else out.unionByName(one)
    return out


def all_true(pred: Column) -> Column:
    """Aggregate: the predicate holds on every row (a null fails it)."""
    return F.coalesce(F.bool_and(F.coalesce(pred, F.lit(False))), F.lit(True))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None,
                 only_nonzero: bool = True, completeness_digits: int | None = None
                 ) -> DataFrame:
    """(column_name, null_count) in one pass; by default only columns that
    hold nulls. One ``count_if`` per column, then an ``unpivot`` of the single
    result row. With ``completeness_digits`` every row also carries
    ``completeness_pct``: the share of non-null cells over all columns,
    from the same pass."""
    columns = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    ids = []
    if completeness_digits is not None:
        total = sum((F.col(c) for c in columns), F.lit(0))
        counts = counts.withColumn("completeness_pct", half_up(
            (F.lit(1.0) - total / (F.col("__rows") * F.lit(len(columns)))) * 100,
            completeness_digits))
        ids = ["completeness_pct"]
    long = counts.unpivot(ids, columns, "column_name", "null_count")
    return long.filter(F.col("null_count") > 0) if only_nonzero else long


def completeness(df: DataFrame, columns: Sequence[str] | None = None,
                 digits: int = 1) -> DataFrame:
    """One row: rows, cells, null cells and completeness % of all cells."""
    columns = list(columns or df.columns)
    nulls = sum((F.count_if(F.col(c).isNull()) for c in columns), F.lit(0))
    return (df.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("null_cells"))
              .withColumn("cells", F.col("rows") * F.lit(len(columns)))
              .withColumn("completeness_pct", half_up(
                  (F.lit(1.0) - F.try_divide(F.col("null_cells"), F.col("cells"))) * 100,
                  digits)))


# --------------------------------------------------------------------------
# exact medians


def _present(df: DataFrame, col: str) -> Column:
    """The column with NaN as null."""
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), F.col(col))
    return F.col(col)


def exact_median(df: DataFrame, col: str, partitions: int | None = None) -> float | None:
    """Exact median of the values that are neither null nor NaN (mean of the two middle values).

    Found by counting around a sketch's guess (:mod:`strata.operators.selection`): no value
    is shuffled. ``partitions`` is accepted for older callers and has no effect."""
    return selection.exact_medians(df, {col: F.col(col)})[col]


def impute_median(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict]:
    """Fill nulls in ``columns`` with each column's exact median.

    NaN is filled like null; an integer column whose median is no integer
    becomes double. Returns (filled frame, {column: median}). The medians of all columns
    come from the same scans; the fill itself is a plain projection.
    """
    medians = selection.exact_medians(df, {c: F.col(c) for c in columns})
    fill = {}
    for c, v in medians.items():
        if v is not None:
            whole = isinstance(df.schema[c].dataType, T.IntegralType)
            kept = F.col(c).cast("double") if whole and not v.is_integer() else _present(df, c)
            fill[c] = F.coalesce(kept, F.lit(v).cast("long") if whole and v.is_integer() else F.lit(v))
    return (df.withColumns(fill) if fill else df), medians


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill nulls with constants (``fillna``)."""
    return df.fillna(dict(values))


# --------------------------------------------------------------------------
# metric rows


def metric_rows(df: DataFrame, metrics: Mapping[str, Column],
                name_col: str = "metric", value_col: str = "value") -> DataFrame:
    """(metric, value) rows from one aggregate pass over ``df``.

    ``metrics`` maps a metric name to an aggregate expression producing text.
    Equivalent to a UNION ALL of one-row selects, but scans ``df`` once.
    """
    names = list(metrics)
    one = df.agg(*[metrics[n].cast("string").alias(f"__m{i}") for i, n in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(n).alias(name_col), F.col(f"__m{i}").alias(value_col))
                      for i, n in enumerate(names)])
    return one.select(F.inline(pairs))
