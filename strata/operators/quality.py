"""Data-quality checks, score and decision; column tests; batch audit.

All row-level checks of a suite are evaluated in ONE aggregate pass: each
check contributes one aggregate expression to a single ``agg``; the one
result row is then turned into ``(check_id, check, status, detail)`` rows with
``inline``. A uniqueness check is an aggregate of its own over the key column
alone: a distinct count in the common pass would shuffle every row. A check
whose columns are missing fails and names them.
Only :func:`decide` (one row) is meant to reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import half_up

PASS, FAIL = "PASS", "FAIL"


@dataclass(frozen=True)
class Check:
    """One check. ``metric`` is an aggregate expression (None for checks
    decided from the schema, which set ``static``); ``ok`` maps the metric to
    a boolean, ``detail`` to text. ``needs`` names the columns it reads;
    ``apart`` (frame -> one row, one column ``m``) replaces ``metric`` where
    the check must not share the common pass."""
    name: str
    metric: Column | None
    ok: Callable[[Column], Column]
    detail: Callable[[Column], Column] = lambda m: F.lit("")
    static: bool | None = None
    needs: tuple[str, ...] = ()
    apart: Callable[[DataFrame], DataFrame] | None = None


def _n(m: Column, text: str) -> Column:
    return F.concat(m.cast("string"), F.lit(text))


def _bad(pred: Column) -> Column:
    """count of rows where ``pred`` does not hold (null counts as not holding)."""
    return F.count_if(~F.coalesce(pred, F.lit(False)))


def _fixed(m: Column, digits: int) -> Column:
    return m.cast("decimal(38,10)").cast(f"decimal(38,{digits})").cast("string") \
        if digits >= 0 else m.cast("string")


# ----------------------------------------------------------------- builders

def columns_present(df: DataFrame, required: Sequence[str],
                    name: str = "All required columns present") -> Check:
    present = all(c in df.columns for c in required)
    listed = "[" + ", ".join(f"'{c}'" for c in required) + "]"
    return Check(name, None, lambda m: F.lit(present),
                 lambda m: F.lit(f"Required: {listed}"), static=present)


def no_nulls(col: str, name: str | None = None, what: str = " nulls found") -> Check:
    return Check(name or f"No nulls in [{col}]", F.count_if(F.col(col).isNull()),
                 lambda m: m == 0, lambda m: _n(m, what), needs=(col,))


def unique(col: str, name: str | None = None, what: str = " duplicates found") -> Check:
    """Rows beyond the first per value; nulls are equal to each other."""
    def repeats(df: DataFrame) -> DataFrame:
        per_value = df.groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
        return per_value.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("m"))
    return Check(name or f"{col} is unique", None, lambda m: m == 0,
                 lambda m: _n(m, what), needs=(col,), apart=repeats)


def count_where(pred: Column, name: str, what: str, needs: Sequence[str] = ()) -> Check:
    """Passes when no row satisfies ``pred`` (null does not count)."""
    return Check(name, F.count_if(pred), lambda m: m == 0, lambda m: _n(m, what),
                 needs=tuple(needs))


def all_rows(pred: Column, name: str, needs: Sequence[str] = ()) -> Check:
    """Passes when ``pred`` holds on every row; a null fails it."""
    return Check(name, _bad(pred), lambda m: m == 0, lambda m: F.lit(""), needs=tuple(needs))


def in_range(col: str, lo, hi, name: str | None = None,
             what: str = " invalid rows") -> Check:
    """lo <= col <= hi on every row (a null fails the check); the detail
    counts the rows outside the range, nulls not included."""
    c = F.col(col)
    metric = F.struct(F.count_if((c < lo) | (c > hi)).alias("outside"),
                      F.count_if(c.isNull()).alias("nulls"))
    return Check(name or f"{col} between {lo} and {hi}", metric,
                 lambda m: (m["outside"] + m["nulls"]) == 0,
                 lambda m: _n(m["outside"], what), needs=(col,))


def accepted(col: str, values: Sequence, name: str | None = None,
             what: str = " invalid codes found") -> Check:
    """Every value in ``values``; a null counts as invalid."""
    listed = ",".join(str(v) for v in values)
    return Check(name or f"{col} in [{listed}]", _bad(F.col(col).isin(*values)),
                 lambda m: m == 0, lambda m: _n(m, what), needs=(col,))


def mean_between(col: str, lo: float, hi: float, name: str,
                 label: str = "avg", symbol: str = "$") -> Check:
    return Check(name, F.avg(col),
                 lambda m: F.coalesce((m >= lo) & (m <= hi), F.lit(False)),
                 lambda m: F.concat(F.lit(f"{label} = {symbol}"), _fixed(half_up(m, 2), 2)),
                 needs=(col,))


def completeness_at_least(columns: Sequence[str], pct: float,
                          name: str | None = None) -> Check:
    nulls = sum((F.count_if(F.col(c).isNull()) for c in columns), F.lit(0))
    metric = half_up((F.lit(1.0) - F.try_divide(
        nulls, F.count(F.lit(1)) * F.lit(len(columns)))) * 100, 1)
    return Check(name or f"Overall completeness >= {pct:g}%", metric,
                 lambda m: F.coalesce(m >= pct, F.lit(False)),
                 lambda m: F.concat(F.lit("completeness = "), _fixed(m, 1), F.lit("%")),
                 needs=tuple(columns))


def row_count_between(lo: int, hi: int | None = None, name: str | None = None) -> Check:
    ok = (lambda m: m >= lo) if hi is None else (lambda m: (m >= lo) & (m <= hi))
    return Check(name or (f"Row count >= {lo}" if hi is None else f"Row count in [{lo},{hi}]"),
                 F.count(F.lit(1)), ok, lambda m: _n(m, " rows"))


# ------------------------------------------------------------------ running

def run_checks(df: DataFrame, checks: Sequence[Check], overall: str | None = None) -> DataFrame:
    """(check_id, check, status, detail) for every check.

    One pass of ``df`` for all checks with a ``metric``, one over its key column
    for each that runs apart; the one-row results are unioned and folded into
    one row. With ``overall`` a last row of that name passes when every check
    passes (from that same row)."""
    lacks = [[c for c in check.needs if c not in df.columns] for check in checks]
    shared = [c.metric.alias(f"__m{i}") for i, c in enumerate(checks)
              if c.metric is not None and not lacks[i]]
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *shared)
    apart = [c.apart(df).withColumnRenamed("m", f"__m{i}") for i, c in enumerate(checks)
             if c.apart and not lacks[i]]
    for part in apart:
        one = one.unionByName(part, allowMissingColumns=True)
    if apart:
        one = one.agg(*[F.any_value(c, F.lit(True)).alias(c) for c in one.columns])
    rows, oks = [], []
    for i, c in enumerate(checks):
        if lacks[i]:
            ok, detail = F.lit(False), F.lit("missing column: " + ", ".join(lacks[i]))
        elif c.metric is None and not c.apart:
            ok, detail = F.lit(bool(c.static)), c.detail(F.lit(None))
        else:
            m = F.col(f"__m{i}")
            ok, detail = F.coalesce(c.ok(m), F.lit(False)), c.detail(m)
        oks.append(ok)
        rows.append(_row(i + 1, c.name, ok, F.coalesce(detail, F.lit(""))))
    if overall is not None:
        all_ok = F.lit(True)
        for ok in oks:
            all_ok = all_ok & ok
        rows.append(_row(len(checks) + 1, overall, all_ok, F.lit("")))
    return one.select(F.inline(F.array(*rows)))


def _row(i: int, name: str, ok: Column, detail: Column) -> Column:
    return F.struct(F.lit(i).alias("check_id"), F.lit(name).alias("check"),
                    F.when(ok, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
                    detail.alias("detail"))


def score(results: DataFrame) -> DataFrame:
    """One row: total, passed, failed checks and the pass percentage."""
    return (results.agg(F.count(F.lit(1)).alias("total_checks"),
                        F.count_if(F.col("status") == PASS).alias("passed_checks"),
                        F.count_if(F.col("status") == FAIL).alias("failed_checks"))
                   .withColumn("score_pct", half_up(F.try_divide(
                       F.col("passed_checks") * 100.0, F.col("total_checks")), 1)))


# The three outcomes of the gate and the number of failed
# checks that still lets the pipeline go on (with bad rows left out).
PROCEED = "PROCEED"
PROCEED_WITH_QUARANTINE = "PROCEED_WITH_QUARANTINE"
HALT = "HALT"
SOFT_FAILURES = 2


def decide(scored: DataFrame, soft_failures: int = SOFT_FAILURES) -> DataFrame:
    """Adds ``decision``: 0 failed -> PROCEED; <= soft -> PROCEED_WITH_QUARANTINE;
    else HALT."""
    f = F.col("failed_checks")
    return scored.withColumn(
        "decision", F.when(f == 0, F.lit(PROCEED))
                     .when(f <= soft_failures, F.lit(PROCEED_WITH_QUARANTINE))
                     .otherwise(F.lit(HALT)))


def all_passed(results: DataFrame) -> DataFrame:
    """One row: ``all_passed`` = every check has status PASS."""
    return results.agg(F.coalesce(F.bool_and(F.col("status") == PASS),
                                  F.lit(True)).alias("all_passed"))


# ------------------------------------------------- column tests (rows that fail)

def failing_not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is null (a passing test returns nothing)."""
    return df.filter(F.col(col).isNull())


def failing_unique(df: DataFrame, col: str) -> DataFrame:
    """(value, n_records) for non-null values that occur more than once."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def failing_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """(value, n_records) for values outside ``values``; nulls are ignored."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))
              .groupBy(col).agg(F.count(F.lit(1)).alias("n_records")))


def column_tests(df: DataFrame, model: str, not_null: Sequence[str] = (),
                 unique_keys: Sequence[str] = (),
                 values: dict[str, Sequence] | None = None) -> DataFrame:
    """(model, test, column_name, failures, status) of a model's declared tests.

    not_null counts null rows; unique counts repeated non-null values; accepted
    values counts the non-null rows outside the list. One scan for all of these;
    one aggregate over the key column per unique test."""
    values = dict(values or {})
    tests = [("not_null", c, F.count_if(F.col(c).isNull())) for c in not_null]
    tests += [("accepted_values", c, F.count_if(~F.col(c).isin(*v))) for c, v in values.items()]
    one = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[m.alias(f"__m{i}") for i, (_, _, m) in enumerate(tests)])
    out = one.select(F.inline(F.array(*[
        F.struct(F.lit(test).alias("test"), F.lit(c).alias("column_name"),
                 F.col(f"__m{i}").alias("failures")) for i, (test, c, _) in enumerate(tests)])))
    for c in unique_keys:
        out = out.unionByName(failing_unique(df, c).agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit("unique").alias("test"), F.lit(c).alias("column_name"), "failures"))
    return out.select(F.lit(model).alias("model"), "test", "column_name", "failures",
                      F.when(F.col("failures") == 0, PASS).otherwise(FAIL).alias("status"))


# ------------------------------------------------------------------- audit

def batch_audits(df: DataFrame, layer: str, batch_id: str, keys: dict,
                 warn_ratio: float = 0.01) -> DataFrame:
    """Several audit rows from ONE scan: ``keys`` maps an audited table name
    to its key expression (e.g. the same rows seen with different keys)."""
    names = list(keys)
    one = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(keys[n].isNull()).alias(f"__nk{i}") for i, n in enumerate(names)])
    rows = [F.struct(F.lit(layer).alias("layer"), F.lit(n).alias("table_name"),
                     F.lit(batch_id).alias("batch_id"), F.col("__rows").alias("rows_written"),
                     F.col(f"__nk{i}").alias("null_keys")) for i, n in enumerate(names)]
    return one.select(F.inline(F.array(*rows))).withColumn(
        "status", F.when(F.col("null_keys") < F.col("rows_written") * F.lit(warn_ratio),
                         F.lit("SUCCESS")).otherwise(F.lit("WARNING")))


def batch_audit(df: DataFrame, layer: str, table: str, batch_id: str,
                key_col: str, run_ts: str | None = None,
                warn_ratio: float = 0.01, extra: dict | None = None) -> DataFrame:
    """One audit row: rows written, null keys, SUCCESS when null keys are
    below ``warn_ratio`` of the rows, else WARNING (0 rows -> WARNING).
    ``extra`` adds more aggregates (name -> expression) to the same pass."""
    extra = dict(extra or {})
    out = (df.agg(F.count(F.lit(1)).alias("rows_written"),
                  F.count_if(F.col(key_col).isNull()).alias("null_keys"),
                  *[e.alias(n) for n, e in extra.items()])
             .select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"),
                     F.lit(batch_id).alias("batch_id"), "rows_written", "null_keys",
                     *extra)
             .withColumn("status", F.when(
                 F.col("null_keys") < F.col("rows_written") * F.lit(warn_ratio),
                 F.lit("SUCCESS")).otherwise(F.lit("WARNING"))))
    if run_ts is not None:
        out = out.withColumn("run_ts", F.lit(run_ts))
    return out
