"""Whitening against numpy's own eigenvectors and whole numbers of any size."""

import random

import numpy as np
import pytest

from strata.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k):
    """Rows (id, x) and what must come out, by numpy and Python's whole numbers."""
    fine = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(np.float32(c)) for c in v)]
    d = max((len(v) for _, v in fine), default=0)
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in v] + [100000] * (d - len(v)) for _, v in fine]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    y = np.array(x, float) - np.array(sums) / max(n, 1) if n else np.zeros((0, 0))
    cov = y.T @ y / max(n, 1)
    e, u = np.linalg.eigh(cov) if d else (np.zeros(0), np.zeros((0, 0)))
    return [i for i, _ in fine], n, dev, y, e[::-1][:k], u[:, ::-1][:, :k], np.trace(cov)


def check(found, rows, k=8):
    ids, n, dev, y, e, u, trace = plain(rows, k)
    got = {}
    for r in found.collect():
        got.setdefault(r.vec_id, []).append(r)
    assert set(got) == set(ids)
    for i, d, row in zip(ids, dev, y):
        own = sorted(got[i], key=lambda r: r.component)
        assert [r.component for r in own] == list(range(1, len(e) + 1))
        assert {r.n for r in own} == {n} and {int(r.deviation) for r in own} == {d}
        assert [r.explained for r in own] == pytest.approx(list(e / trace), rel=1e-10, abs=1e-14)
    w = np.array([[r.whitened for r in sorted(got[i], key=lambda r: r.component)] for i in ids])
    want = y @ u / np.sqrt(e)
    for j in range(len(e)):
        sign = np.sign(w[:, j] @ want[:, j])
        assert np.abs(w[:, j] - sign * want[:, j]).max() < 1e-8
    assert max(r[0].identity_error for r in got.values()) < 1e-9


def vectors(n, d, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.linspace(0.3, 0.02, d) + rng.normal(size=d) * 0.1
    return [[float(np.float32(c)) for c in r] for r in x]


def test_components_are_numpys(spark):
    rows = list(enumerate(vectors(400, 20, 1)))
    rows += [(900, None), (901, [float("nan")] + [0.0] * 19), (902, [float("-inf")] + [0.0] * 19), (903, [None] + [0.0] * 19)]
    rows += [(904, []), (905, [0.5, -0.5])]                     # filled up with zeros
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(7)
    check(W.whiten(df), rows)


def test_fewer_dimensions_than_components_and_clashing_names(spark):
    rows = list(enumerate(vectors(60, 3, 4)))
    df = spark.createDataFrame([(i, v, 1.0, "x", 2, 3) for i, v in rows],
                               "vec_id long, embedding array<float>, v double, id string, w int, component int")
    found = W.whiten(df)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(found, rows)


def test_no_variance_no_rows_one_row_repeats_null_ids(spark):
    def of(rows):
        return W.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()
    assert of([]) == [] and of([(1, None), (2, [float("nan")])]) == [] and of([(1, [])]) == []
    for rows in ([(1, [0.5, 0.25])], [(i, [0.5, 0.25]) for i in range(9)]):
        got = of(rows)
        assert len(got) == 2 * len(rows)
        assert all((r.whitened, r.explained, r.identity_error, int(r.deviation)) == (None, None, None, 0) for r in got)
    line = of([(i // 2 if i else None, [float(i), 2.0 * i]) for i in range(10)])       # one component has no variance
    assert {r.whitened is None for r in line if r.component == 2} == {True}
    assert sorted({round(r.explained, 12) for r in line}) == [0.0, 1.0]
    assert len(line) == 20 and {r.vec_id for r in line} == {None, 0, 1, 2, 3, 4} and line[0].identity_error < 1e-12


def test_large_entries_stay_exact(spark):
    rng = random.Random(6)
    rows = [(i, [float(np.float32(rng.uniform(-1, 1) * 10 ** rng.randrange(0, 9))) for _ in range(4)]) for i in range(50)]
    ids, _, dev, *_ = plain(rows, 4)
    got = {r.vec_id: int(r.deviation) for r in W.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()}
    assert got == dict(zip(ids, dev))
    over = W.whiten(spark.createDataFrame([(1, [3e38, 0.0], 0), (2, [-3e38, 1.0], 0)], SCHEMA)).collect()
    assert {int(r.deviation) for r in over} == {(2 << 40) ** 2 + 1024 ** 2}
    assert over[0].n == 2


@pytest.mark.parametrize("values", [[5, 5, 5, 1, 1, 0, 0, 2], [1] * 8, [3, 3 - 1e-12, 3 - 2e-12, 1, .5, .5, 1e-9, 0]])
def test_equal_and_close_eigenvalues(values):
    q = np.linalg.qr(np.random.default_rng(0).normal(size=(8, 8)))[0]
    a = q @ np.diag(np.array(values, float)) @ q.T
    a = (a + a.T) / 2
    e, u = W.leading_components(a, 8)
    assert np.abs(e - np.sort(values)[::-1]).max() < 1e-13
    assert np.abs(a @ u - u * e).max() < 1e-13 and np.abs(u.T @ u - np.eye(8)).max() < 1e-13


def test_sturm_counts_are_the_numbers_of_eigenvalues_below():
    rng = np.random.default_rng(3)
    d, o = rng.normal(size=12), rng.normal(size=11)
    w = np.linalg.eigvalsh(np.diag(d) + np.diag(o, 1) + np.diag(o, -1))
    x = np.linspace(-5, 5, 41)
    assert (W.sturm_count(d, o, x) == [(w < v).sum() for v in x]).all()
