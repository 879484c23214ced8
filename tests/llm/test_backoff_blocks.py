"""Sequences of words counted in packed blocks, with frequent words and pairs dealt by what follows them."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import words

from strata.llm import backoff_lm


def corpus() -> list[tuple]:
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdef") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    texts = [" ".join(rng.choice(["the", "the", "of", "of the", *rng.choices(vocabulary, k=4)]) for _ in range(rng.randint(1, 150))) for _ in range(60)]
    return list(enumerate([*texts, texts[0], None, "", "one", "The of"]))


def probabilities(rows: list[tuple], known: set) -> dict:
    tokens = {i: [*words(t), None] for i, t in rows}
    c = [Counter(tuple(t[k:k + n]) for i, t in tokens.items() if i in known for k in range(len(t) - n + 1)) for n in (1, 2, 3)]
    after, total = [Counter(s[:-1] for s in x) for x in c], sum(c[0].values())
    once, twice = (sum(v == k for v in c[0].values()) for k in (1, 2))
    off = (once + 1) / (once + 2 * twice + 2)

    def p(s):
        if len(s) == 1:
            return (c[0][s] - off if c[0][s] else off * len(c[0])) / total
        h, low = s[:-1], p(s[1:])
        if not after[len(h)][h]:
            return low
        seen = c[len(h) - 1][h]
        return max(c[len(h)][s] - 0.75, 0) / seen + 0.75 * after[len(h)][h] / seen * low
    return {i: sum(math.log10(p(tuple(t[max(0, k - 2):k + 1]))) for k in range(len(t))) for i, t in tokens.items()}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("split, table", [(1 << 22, 1 << 19), (50, 20), (5, 1)])
def test_words_and_pairs_seen_often_are_dealt_by_what_follows(docs, monkeypatch, split, table):
    monkeypatch.setattr(backoff_lm, "SPLIT", split)
    monkeypatch.setattr(backoff_lm, "TABLE", table)
    learnt = docs.doc_id % 5 != 2
    model, counts = backoff_lm.train(docs.where(learnt).select("text"))
    assert bool(len(model.often.keys)) == bool(len(model.often_pairs.keys)) == (split < 100)
    want = probabilities(corpus(), {i for i, _ in corpus() if i % 5 != 2})
    for training in (None, learnt):
        got = {r.doc_id: r.score for r in backoff_lm.score(docs, model, counts, training=training).collect()}
        assert got == pytest.approx(want)


def test_rows_are_kept_and_dealt_by_block_not_by_token(docs, monkeypatch):
    sizes, whole = {}, backoff_lm.saved
    monkeypatch.setattr(backoff_lm, "saved", lambda df, name: sizes.update({name: (out := whole(df, name)).count()}) or out)
    model, counts = backoff_lm.train(docs.select("text"))
    rows = backoff_lm.score(docs, model, counts).collect()
    assert sum(n for name, n in sizes.items() if name != "words") < sum(r.n_tokens for r in rows) / 100  # a row a token and sequence before


def test_packed_columns_are_read_back():
    columns = [np.array(x, np.uint64) for x in ([], [0, 0], [1, 255, 256, 1 << 40, (1 << 64) - 1], [7])]
    got = backoff_lm._unpacked(backoff_lm._packed(*columns))
    assert [x.tolist() for x in got] == [x.tolist() for x in columns]


def test_sequences_of_more_distinct_words_are_the_same(monkeypatch):
    flat, offsets = backoff_lm.tokens(pa.array([t for _, t in corpus()]))
    keys, n = np.unique(flat, return_counts=True)
    model = backoff_lm.Automaton(keys[::3], n[::3], int(n.sum()), len(keys), 1, 1)
    code, others = model.pack(flat)
    few = backoff_lm.Sequences(model, code, others, offsets, np.ones(len(offsets) - 1), 64)
    monkeypatch.setattr(backoff_lm, "FEW", 4)
    many = backoff_lm.Sequences(model, code, others, offsets, np.ones(len(offsets) - 1), 64)
    assert [*few.dealt()] == [*many.dealt()] and (few.of == many.of).all()
    assert (few.words[few.first].repeat(few.seconds).repeat(few.thirds)[few.of] == flat[few.at]).all()
