"""Row rules: filters, clean / quarantine split, router, safe casts.

A rule is a ``(name, predicate)`` pair where the predicate says what a *good*
row looks like. Spark's three-valued logic would drop a row whose predicate is
null from both a ``filter(p)`` and a ``filter(~p)``; here a null predicate
counts as a failure, so ``clean`` and ``bad`` always partition the input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import percent

Rule = tuple[str, Column]


def _holds(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


def keep(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows for which every rule holds (null counts as failing).

    One conjunction, so Catalyst pushes the single-column parts into the scan.
    """
    if not rules:
        return df
    cond = rules[0][1]
    for _, p in rules[1:]:
        cond = cond & p
    return df.filter(cond)


def failed_rules(rules: Sequence[Rule]) -> Column:
    """array<string> of the names of the rules a row breaks."""
    flags = [F.when(~_holds(p), F.lit(name)) for name, p in rules]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def tag_failures(df: DataFrame, rules: Sequence[Rule], col: str = "_failed") -> DataFrame:
    """Adds ``col``: the names of all broken rules (empty when clean)."""
    return df.withColumn(col, failed_rules(rules))


def tag(df: DataFrame, rules: Sequence[Rule], reason: str | None = None,
        reason_col: str = "_quarantine_reason") -> DataFrame:
    """One pass: ``reason_col`` is null for clean rows, else a fixed text
    (``reason``) or the broken rule names joined by ', '. Write the tagged
    frame once (e.g. partitioned by ``reason_col is null``) instead of
    filtering the source twice."""
    fails = failed_rules(rules)
    text = F.lit(reason) if reason is not None else F.array_join(fails, ", ")
    return df.withColumn(reason_col, F.when(~_conj(rules), text))


def split(df: DataFrame, rules: Sequence[Rule], reason: str | None = None,
          reason_col: str = "_quarantine_reason",
          failed_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined). Quarantined rows carry ``reason_col`` (a fixed
    text when ``reason`` is given, else the broken rule names joined by ', ').
    With ``failed_col`` the array of broken rules is kept as well."""
    bad_pred = ~_holds(_conj(rules))
    clean = df.filter(~bad_pred)
    bad = df.filter(bad_pred)
    fails = failed_rules(rules)
    if failed_col:
        bad = bad.withColumn(failed_col, fails)
    bad = bad.withColumn(
        reason_col, F.lit(reason) if reason is not None else F.array_join(fails, ", "))
    return clean, bad


def _conj(rules: Sequence[Rule]) -> Column:
    cond = F.lit(True)
    for _, p in rules:
        cond = cond & _holds(p)
    return cond


def stage_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One pass: raw rows, rows kept by all rules, rejected rows, reject %."""
    ok = _conj(rules)
    return (df.agg(F.count(F.lit(1)).alias("raw_rows"),
                   F.count_if(ok).alias("kept_rows"))
              .withColumn("rejected_rows", F.col("raw_rows") - F.col("kept_rows"))
              .withColumn("rejected_pct", percent("rejected_rows", "raw_rows", 1)))


def route(df: DataFrame, branches: Mapping[str, Column], default: str | None = None,
          col: str = "_route") -> DataFrame:
    """Router: tag each row with the first branch whose condition holds.

    Downstream code filters on the tag, or writes ``partitionBy(col)`` so one
    pass serves every branch."""
    out = None
    for name, cond in branches.items():
        out = F.when(_holds(cond), F.lit(name)) if out is None \
            else out.when(_holds(cond), F.lit(name))
    tag = F.lit(default) if out is None else out.otherwise(F.lit(default))
    return df.withColumn(col, tag)


def branch(routed: DataFrame, name: str, col: str = "_route") -> DataFrame:
    return routed.filter(F.col(col) == name)


def safe_cast(df: DataFrame, col: str, data_type: str = "double",
              out: str | None = None, reject_non_finite: bool = True
              ) -> tuple[DataFrame, DataFrame]:
    """Cast text to ``data_type`` without failing.

    Returns (parsed, rejected). A row is rejected when its text does not
    parse; null input text is rejected too. NaN and infinities are rejected
    for fractional types unless ``reject_non_finite=False``.
    """
    out = out or col
    parsed = F.col(col).try_cast(data_type)
    good = parsed.isNotNull()
    if reject_non_finite and data_type in ("double", "float"):
        good = good & ~F.isnan(parsed) & (F.abs(parsed) != F.lit(float("inf")))
    tagged = df.withColumn("__parsed", parsed).withColumn("__ok", _holds(good))
    clean = tagged.filter("__ok").withColumn(out, F.col("__parsed")).drop("__parsed", "__ok")
    rejected = tagged.filter(~F.col("__ok")).drop("__parsed", "__ok")
    return clean, rejected


def cast_report(df: DataFrame, col: str, data_type: str = "double",
                reject_non_finite: bool = True, sum_col: str | None = None) -> DataFrame:
    """One row: total, parsed, rejected, rejection % (one pass); with
    ``sum_col`` also the sum of the parsed values."""
    parsed = F.col(col).try_cast(data_type)
    good = parsed.isNotNull()
    if reject_non_finite and data_type in ("double", "float"):
        good = good & ~F.isnan(parsed) & (F.abs(parsed) != F.lit(float("inf")))
    aggs = [F.count(F.lit(1)).alias("total_rows"), F.count_if(_holds(good)).alias("parsed_rows")]
    if sum_col:
        aggs.append(F.sum(F.when(_holds(good), parsed)).alias(sum_col))
    return (df.agg(*aggs)
              .withColumn("rejected_rows", F.col("total_rows") - F.col("parsed_rows"))
              .withColumn("rejected_pct", percent("rejected_rows", "total_rows", 1)))
