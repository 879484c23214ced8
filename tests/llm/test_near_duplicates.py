"""Groups that grow by rounds and portions: exact for any of them, with pairs in proportion to the documents."""

import random

import pytest
from brute import groups

from strata.llm import graph, jaccard_join as J

SCHEMA = "doc_id long, text string"


def family(n, seed, length=120, edits=(0, 9)):
    """Copies of one text with some words changed: many pairs on either side of the threshold."""
    rng = random.Random(seed)
    text = [rng.choice("abcdefgh") + str(rng.randrange(300)) for _ in range(length)]
    out = []
    for _ in range(n):
        own = list(text)
        for _ in range(rng.randrange(*edits)):
            own[rng.randrange(length)] = f"new{rng.randrange(10 ** 6)}"
        out.append(" ".join(own))
    return out


def check(spark, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicate_groups(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert got == groups(rows)


@pytest.mark.parametrize(("probes", "rounds"), [(32, 2), (2, 0), (3, 3)])
def test_families_near_the_threshold(spark, monkeypatch, probes, rounds):
    monkeypatch.setattr(J, "PROBES", probes)
    monkeypatch.setattr(J, "ROUNDS", rounds)
    texts = family(150, 1) + family(60, 2, 40, (0, 5)) + [None, "", "one two"] * 2 + family(1, 3)
    random.Random(5).shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_candidate_pairs_grow_in_proportion(spark, monkeypatch):
    """Near copies of one text: three times the documents, about three times the pairs that are compared."""
    real, pairs = J.verify, []

    def counted(texts, found, num, den):
        pairs[-1] += found.count()
        return real(texts, found, num, den)
    monkeypatch.setattr(J, "verify", counted)
    for n in (400, 1200):
        pairs.append(0)
        docs = spark.createDataFrame(list(enumerate(family(n, 4, 150, (0, 8)))), SCHEMA).repartition(4)
        assert J.near_duplicate_groups(docs).count() == n
    assert pairs[1] <= 4.5 * pairs[0], pairs


def test_merging_equals_components_of_all_edges(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(60), rng.randrange(60, 90)) for _ in range(25)]
    more = [(rng.randrange(120), rng.randrange(120)) for _ in range(25)] + [(5, 5)]
    frame = lambda e: spark.createDataFrame(e, "a long, b long")
    got = graph.merged(graph.saved(graph.components(frame(edges)), "t"), frame(more))
    want = graph.components(frame(edges + more))
    assert {tuple(r) for r in got.collect()} >= {tuple(r) for r in want.collect()}
    assert len({r.node for r in got.collect()}) == got.count()
    none = graph.merged(graph.saved(graph.components(frame(edges)), "t"), frame(more).limit(0))
    assert {tuple(r) for r in none.collect()} == {tuple(r) for r in graph.components(frame(edges)).collect()}
