"""The network's gradients against differences, training from joined labels, and odd inputs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from planutil import plan_text
from pyspark.sql import functions as F

from strata.llm import toxicity as X


def prose(rng, bad):
    w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(5, 90))]
    if bad:
        w[rng.randrange(len(w))] = "zorg" + rng.choice(["", "en", "ish"])
    return " ".join(w)


def test_gradients_are_the_slopes_of_the_logits():
    rng = np.random.default_rng(5)
    texts = pa.array(["alpha beta gamma delta " * 12, "one", "beta beta zorg", "x y z " * 30])
    f = X.Features(texts)
    windows, _ = f.windows()
    model, _ = X._start(f, np.array([0.0, 1.0, 1.0, 0.0]), rng)
    slopes = rng.normal(size=len(windows))
    _, grad = X._gradients(model, f, windows, lambda logits: slopes)

    def total(changed):
        return float((X._logits(changed, f, windows).astype(np.float64) * slopes).sum())
    for name in model:
        g = np.asarray(grad[name], np.float64)
        places = [()] if g.ndim == 0 else [np.unravel_index(i, g.shape) for i in np.argsort(-np.abs(g).ravel())[:6]]
        for at in places:
            step, ends = 5e-3, []
            for way in (step, -step):
                moved = {k: np.array(v) for k, v in model.items()}
                moved[name][at] += np.float32(way)
                ends.append(total(moved))
            assert (ends[0] - ends[1]) / (2 * step) == pytest.approx(g[at], rel=0.03, abs=2e-3), name


def test_training_without_the_first_evidence_learns_too(monkeypatch):
    rng = random.Random(2)
    rows = [(prose(rng, i % 2), i % 2) for i in range(700)]
    real = X._start

    def plain(f, labels, rng):
        model, evidence = real(f, labels, rng)
        model["gram"][:, 0] = rng.normal(0, 0.02, X.BUCKETS)
        return model, evidence
    monkeypatch.setattr(X, "_start", plain)
    labels = np.array([float(y) for _, y in rows])
    model = X.train(pa.array([t for t, _ in rows[:600]]), labels[:600], np.ones(600), epochs=30)
    f = X.Features(pa.array([t for t, _ in rows[600:]]))
    windows, text = f.windows()
    logits = np.maximum.reduceat(X._logits(model, f, windows), np.searchsorted(text, np.arange(100)))
    assert ((logits > 0) == (labels[600:] == 1)).mean() >= 0.85


def test_joined_labels_train_the_same_network(spark):
    rng = random.Random(3)
    docs = [(i, prose(rng, i % 3 == 0)) for i in range(90)] + [(90, None), (91, ""), (None, "no id"), (5, "a second row")]
    labels = [(i, int(i % 3 == 0)) for i in range(0, 92, 2)] + [(91, None), (None, 1), (500, 1), (4, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    y = spark.createDataFrame(labels, "doc_id long, label int")
    one, two = X.fit(d.join(y, "doc_id")), X.fit_joined(d, y)
    assert one.keys() == two.keys() and all(np.array_equal(one[k], two[k]) for k in one)
    assert X.fit_joined(d, y.where("label = 0")) == {"share": 0.0} and X.fit_joined(d, y.limit(0)) == {"share": 0.0}


def test_a_very_long_text_and_many_windows(spark):
    rng = random.Random(4)
    rows = [(prose(rng, i % 2), i % 2) for i in range(80)]
    model = X.fit(spark.createDataFrame(rows, "text string, label int"))
    long = " ".join(prose(rng, False) for _ in range(1500))
    docs = spark.createDataFrame([(1, long), (2, long + " zorgen " + long), (3, "a b")], "doc_id long, text string")
    got = {r.doc_id: r for r in X.score(docs, model).collect()}
    assert got[2].n_windows > 4000 and got[2].toxicity >= got[1].toxicity and got[3].n_windows == 1


def test_no_text_is_shuffled_with_the_labels(spark):
    d = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    y = spark.createDataFrame([(1, 1)], "doc_id long, label int")
    hashed = d.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash")).join(y.withColumnRenamed("doc_id", "id"), "id")
    plan = plan_text(hashed, "simple")
    assert "xxhash64" in plan.split("Exchange", 1)[-1] or "Broadcast" in plan
