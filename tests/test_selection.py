"""Exact order statistics against sorting, also where the sketch is of little use."""

import random

import pytest
from planutil import plan_text
from pyspark.sql import functions as F

from strata.operators import aggregate, selection as S


def plain(values, n):
    v = sorted(x for x in values if x is not None and x == x)
    return (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2 if v else None


def columns():
    rng = random.Random(9)
    n = 6000
    return {
        "spread": [rng.uniform(-1e6, 1e6) for _ in range(n)],
        "hot": [5.0 if i % 3 else rng.choice([1.0, 9.0, None]) for i in range(n)],
        "two": [float(i % 2) for i in range(n)],
        "gap": [None if i % 4 else float("nan") if i % 8 else float(i) for i in range(n)],
        "ends": [rng.choice([float("inf"), float("-inf"), -0.0, 0.0]) for _ in range(n)],
        "one": [3.25] + [None] * (n - 1),
        "none": [None] * n,
    }


@pytest.mark.parametrize("opened", [200_000, 50, 1])
def test_medians_equal_sorting(spark, monkeypatch, opened):
    monkeypatch.setattr(S, "OPEN_VALUES", opened)
    cols = columns()
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = S.exact_medians(df, {c: F.col(c) for c in cols})
    assert got == {c: plain(v, 0) for c, v in cols.items()}


def test_positions_at_both_ends_and_everywhere(spark, monkeypatch):
    monkeypatch.setattr(S, "OPEN_VALUES", 20)
    values = [float(i // 3) for i in range(900)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    places = [1, 2, 3, 4, 449, 450, 451, 899, 900]
    n, at = S.select_positions(df, {"v": F.col("v")}, lambda n: places)["v"]
    assert n == 900 and at == {p: sorted(values)[p - 1] for p in places}
    with pytest.raises(ValueError):
        S.select_positions(df, {"v": F.col("v")}, lambda n: [n + 1])


def test_a_guess_off_the_mark_is_put_right_by_the_counts(spark, monkeypatch):
    """With a sketch that points to the wrong place every time, the counts still lead there."""
    monkeypatch.setattr(S, "OPEN_VALUES", 45)
    df = spark.createDataFrame([(float(i),) for i in range(400)], "v double").coalesce(2)
    calls = []
    real = S._chosen

    def wrong(spark, searches):
        calls.append(1)
        got = real(spark, searches)
        if len(calls) % 2:      # the lowest or highest tenth instead
            return [None if g is None else (s.low + 1 if s.low is not None else 0.0, s.low + 2 if s.low is not None else 30.0)
                    if s.position > 200 else (350.0, 390.0) if s.high is None else g
                    for g, s in zip(got, searches)]
        return got
    monkeypatch.setattr(S, "_chosen", wrong)
    assert S.exact_medians(df, {"v": F.col("v")}) == {"v": 199.5}
    assert len(calls) > 2


def test_quantiles_integers_decimals(spark):
    df = spark.range(1001).selectExpr("id", "cast(id as decimal(10,2)) / 4 as d")
    got = S.exact_quantiles(df, {"id": F.col("id"), "d": F.col("d")}, [0, 0.5, 0.999, 1])
    assert got == {"id": [0, 500, 999, 1000], "d": [0, 125.0, 249.75, 250.0]}


def test_no_value_is_shuffled(spark):
    df = spark.range(1000).selectExpr("cast(id as double) as v0")
    s = S._Search("v0", 500, inside=1000)
    plan = plan_text(df.agg(*S._counts(0, s, (400.0, 600.0))), "simple")
    assert plan.count("Exchange") == 1 and "partial_kll_sketch_agg_double" in plan.replace("kllsketchaggdouble", "kll_sketch_agg_double")


def test_distinct_report_copies_no_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, None)], "x int, y string")
    got = {r.column_name: (r.rows, r.distinct_values, r.duplicate_rows) for r in aggregate.distinct_report(df, ["x", "y"]).collect()}
    assert got == {"x": (3, 2, 1), "y": (3, 2, 1)}
    assert "Expand" not in plan_text(aggregate.distinct_report(df, ["x", "y"]), "simple")
    assert aggregate.distinct_report(df.limit(0), ["x"]).first().asDict() == {
        "column_name": "x", "rows": 0, "distinct_values": 0, "duplicate_rows": 0}
