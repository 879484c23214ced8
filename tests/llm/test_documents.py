"""Document operators against brute force, with nulls, blanks, repeats and empty tables."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import groups, repeated_words, words

from strata.llm import backoff_lm, toxicity, wavelet
from strata.llm.jaccard_join import near_duplicate_groups
from strata.llm.packing import best_fit_decreasing, pack_documents
from strata.llm.passages import remove_repeats
from strata.llm.piece_lattice import Lattice, default_model, encode_pieces
from strata.llm.subword import default_vocabulary
from strata.llm.wavelet import WaveletMatrix, read_shards, write_shards

SCHEMA = "doc_id long, text string, n long, token string, key string"


def corpus() -> list[tuple]:
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", ",\n"]) for _ in range(n))
    shared = prose(60)
    rows = [prose(rng.randint(1, 120)) for _ in range(40)]
    rows += [prose(50) + "\n" + shared + "\n" + prose(50) for _ in range(12)]
    for i in range(10):  # near copies of each other, in chains
        w = rows[i].split(" ")
        w[len(w) // 2] = f"changed{i}"
        rows.append(" ".join(w))
    long = prose(6000)
    rows += [rows[0], rows[0].upper(), None, "", " \n\t ", "one", "one", "a b c", "é A ß", long, "x" * 3000,
             "tab\tand  double\r\nspace", "<|endoftext|> in text", "日本語 ١٢", " wide space"]
    return [(i, t, 1, "clash", "clash") for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_vocabulary())


def test_jaccard_groups_match_brute_force(docs, nothing):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicate_groups(docs).collect()}
    assert got == groups([(r[0], r[1]) for r in corpus()])
    assert near_duplicate_groups(nothing).collect() == []


def test_jaccard_null_ids_and_repeated_rows(spark):
    rows = [(None, "a b c d e f", 0, "", ""), (3, "a b c d e f", 0, "", ""), (3, "a b c d e f", 0, "", "")]
    got = near_duplicate_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in got) == [(False, 3), (False, 3), (True, 3)]


def test_shards_hold_the_library_ids_in_order(docs, nothing, library):
    got = {r.id: r for r in read_shards(write_shards(docs, shard_tokens=500)).collect()}
    start = 0
    for i, text, *_ in corpus():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (got[i].start, got[i].n_tokens, bytes(got[i].ids)) == (start, len(ids), ids.tobytes())
        start += len(ids)
    assert read_shards(write_shards(nothing)).collect() == []


def test_ids_read_from_shards_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, "some words of a text " * (i % 7)) for i in range(60)], "doc_id long, text string")
    found = read_shards(write_shards(docs, shard_tokens=100))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # files as large as no guess would broadcast
    try:
        plan = found.select("id", "start", "n_tokens", "ids")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    top = plan[:plan.index("MapInArrow")]
    assert "Exchange" not in top and "BroadcastHashJoin" in top    # a sort-merge join of all ids before


def test_wavelet_planes_split_and_merge_in_any_portions(monkeypatch):
    x = np.random.default_rng(6).integers(0, 1 << 16, 1000).astype("<u4")
    want = wavelet.WaveletMatrix.build(x, 16).to_bytes()
    for size in (1, 7, 1000):
        monkeypatch.setattr(wavelet, "AT_ONCE", size)
        got = wavelet.WaveletMatrix.build(x, 16)
        assert got.to_bytes() == want and (got.decode() == x).all()
    wide = x.astype(np.uint32) << np.uint32(4)
    assert (wavelet.WaveletMatrix.build(wide, 20).decode() == wide).all()


def test_wavelet_matrix_answers_without_unpacking():
    x = np.random.default_rng(1).integers(0, 40, 3000)
    m = WaveletMatrix.from_bytes(WaveletMatrix.build(x, 6).to_bytes())
    assert (m.decode() == x).all()
    assert [m.access(i) for i in range(0, 3000, 17)] == x[::17].tolist()
    assert m.count(7, 100, 900) == (x[100:900] == 7).sum()
    assert m.occurrences(7) == np.flatnonzero(x == 7).tolist()
    assert WaveletMatrix.from_bytes(WaveletMatrix.build(x[:0], 6).to_bytes()).decode().tolist() == []


def one_by_one(lengths: list[int], capacity: int) -> int:
    free: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= n]
        if fits:
            free[free.index(min(fits))] -= n
        else:
            free.append(capacity - n)
    return len(free)


def test_bulk_placement_equals_one_by_one():
    rng = random.Random(2)
    for _ in range(60):
        lengths = [rng.randint(1, 64) for _ in range(rng.randint(0, 200))]
        rows, used = best_fit_decreasing(Counter(lengths), 64)
        assert used == one_by_one(lengths, 64)
        held: dict[int, list] = {}
        for length, _, n, first, each, offset in rows:
            for i in range(n):
                held.setdefault(first + i // each, []).append((offset + i % each * length, length))
        for parts in held.values():
            parts.sort()
            assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False))
            assert parts[0][0] == 0 and sum(parts[-1]) <= 64


def test_pieces_are_the_library_ids(docs, nothing, library):
    got: dict = {}
    for r in pack_documents(docs, capacity=64).collect():
        got.setdefault(r.doc_id, {})[r.piece] = r
    places: dict[int, list] = {}
    for i, text, *_ in corpus():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        parts = [got[i][k] for k in range(len(got[i]))]
        assert b"".join(bytes(p.ids) for p in parts) == ids
        assert all(p.length == 64 for p in parts[1:])
        for p in parts:
            places.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert pack_documents(nothing).collect() == []


def test_repeated_passages_go_and_the_first_stays(docs, nothing):
    got = {r.doc_id: r for r in remove_repeats(docs).collect()}
    before = {r[0]: r[1] for r in corpus()}
    with_passage = range(40, 52)
    assert got[40].text == before[40] and got[40].removed_spans == []
    for i in list(with_passage)[1:]:
        (begin, end), = [(s.begin, s.end) for s in got[i].removed_spans]
        assert len(before[i].encode()[begin:end].split()) >= 40  # short units at its ends stay
        assert before[i].encode()[begin:end].decode() in before[40]
    for i in range(10, 40):
        assert got[i].text == before[i] and got[i].token == "clash"
    assert remove_repeats(nothing).collect() == []


def test_repeated_passages_match_brute_force(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(400)]

    def prose(n, stops=("",)):
        return " ".join(rng.choice(vocabulary) + rng.choice(stops) for _ in range(n))
    often, some = (".", "!!", "\n"), ("", "", "", "", "", "", "", ".")
    verse, inside, edges = prose(150, often), prose(55), prose(51, some)
    texts = [verse, prose(20) + " " + inside + " " + prose(20), prose(30, some) + " " + edges + " " + prose(30, some),
             verse, prose(40) + " " + inside + " " + prose(9), prose(33, some) + " " + edges + " " + prose(41, some),
             inside.replace(" ", "\n").upper(), verse + " " + verse, "a " * 200, "x. y! " * 50, prose(300, often),
             prose(4) + " " + " ".join(inside.split()[:29]), prose(4) + " " + " ".join(inside.split()[:30]), None, ""]
    rows = list(enumerate(texts))
    want = repeated_words(rows, 30)
    for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect():
        raw, at, got = (texts[r.doc_id] or "").encode(), 0, []
        for begin, end in [*((s.begin, s.end) for s in r.removed_spans), (len((texts[r.doc_id] or "").encode()),) * 2]:
            got += [False] * len(raw[at:begin].split()) + [True] * len(raw[begin:end].split())
            at = end
        assert got == want[r.doc_id]
    assert all(want[i][:150] == [True] * 150 for i in (3, 7)) and sum(want[4]) == 55 and sum(want[5]) == 51


def test_backoff_scores(docs, nothing):
    model, counts = backoff_lm.train(docs.where("doc_id % 7 <> 2").select("text"))
    got = {r.doc_id: r for r in backoff_lm.score(docs, model, counts).collect()}
    tokens = {i: [*words(t), None] for i, t, *_ in corpus()}
    c = Counter(w for i, t in tokens.items() if i % 7 != 2 for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in tokens.items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
        assert got[i].base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t))
        assert got[i].score < 0
    empty, none = backoff_lm.train(nothing.select("text"))
    assert {r.base_score for r in backoff_lm.score(docs, empty, none).collect()} == {0.0}
    assert backoff_lm.score(nothing, model, counts).collect() == []


@pytest.mark.parametrize("table, states", [(1 << 19, 2048), (40, 12)])
def test_backoff_counts_all_sequences_of_three_words(docs, monkeypatch, table, states):
    monkeypatch.setattr(backoff_lm, "TABLE", table)
    monkeypatch.setattr(backoff_lm, "STATES", states)
    model, counts = backoff_lm.train(docs.where("doc_id % 7 <> 2").select("text"))
    got = {r.doc_id: r.score for r in backoff_lm.score(docs, model, counts).collect()}
    tokens = {i: [*words(t), None] for i, t, *_ in corpus()}
    known = [t for i, t in tokens.items() if i % 7 != 2]
    c = [Counter(tuple(t[k:k + n]) for t in known for k in range(len(t) - n + 1)) for n in (1, 2, 3)]
    after = [Counter(s[:-1] for s in x) for x in c]
    total, d = sum(c[0].values()), 0.75
    once, twice = (sum(v == k for v in c[0].values()) for k in (1, 2))
    d0 = (once + 1) / (once + 2 * twice + 2)

    def p(s):
        if len(s) == 1:
            return (c[0][s] - d0 if c[0][s] else d0 * len(c[0])) / total
        h, low = s[:-1], p(s[1:])
        if not after[len(h)][h]:
            return low
        seen = c[len(h) - 1][h]
        return max(c[len(h)][s] - d, 0) / seen + d * after[len(h)][h] / seen * low
    for i, t in tokens.items():
        assert got[i] == pytest.approx(sum(math.log10(p(tuple(t[max(0, k - 2):k + 1]))) for k in range(len(t))))


def test_probabilities_of_a_state_sum_to_one(docs):
    model, counts = backoff_lm.train(docs.select("text"))
    every = np.array([r.key for r in counts.collect()], np.int64).view(np.uint64)
    for first in every[:20]:
        if first == backoff_lm.END:
            continue
        flat = np.ravel(np.column_stack([np.full(len(every), first), every]))
        _, both, *_ = model.read(flat, np.arange(0, len(flat) + 1, 2))
        _, alone, *_ = model.read(np.array([first]), np.array([0, 1]))
        known = (10 ** (both - alone[0])).sum()
        state = model.state[model.find(np.array([first]))][0]
        unknown = 10 ** (model.fail[state] + model.root_log(np.zeros(1))[0])
        assert known + unknown == pytest.approx(1.0)


def test_toxicity_finds_planted_words(spark, nothing):
    rng = random.Random(1)

    def prose(n, bad):
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n)]
        if bad:
            w[rng.randrange(n)] = "zorg" + rng.choice(["", "en", "ish"])
        return " ".join(w)
    rows = [(i, prose(rng.randint(5, 150), i % 3 == 0), i % 3 == 0) for i in range(500)]
    known = spark.createDataFrame([(t, int(y)) for i, t, y in rows if i < 400], "text string, label int")
    model = toxicity.fit(known)
    odd = [(1000, None, False), (1001, "", False), (1002, " ", False)]
    docs = spark.createDataFrame([(i, t, 9.0) for i, t, _ in rows + odd], "doc_id long, text string, toxicity double")
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    right = sum((got[i].toxicity >= 0.5) == y for i, _, y in rows[400:])
    assert right >= 95 and all(0 <= r.toxicity <= 1 for r in got.values())
    assert got[1000].toxicity == got[1001].toxicity == got[1002].toxicity
    assert toxicity.score(nothing, model).collect() == []
    assert toxicity.fit(known.where("label = 1")) == {"share": 1.0}


def test_toxicity_learns_from_distinct_texts(spark, monkeypatch):
    from pyspark.sql import functions as F
    seen = {}
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, weights: seen.update(t=texts.to_pylist(), y=labels, w=weights) or {})
    texts = spark.createDataFrame([(f"text number {i}", i % 2) for i in range(80)], "text string, label int")
    first = texts.orderBy(F.xxhash64("text")).limit(1).first()  # its copies come before all others
    toxicity.fit(texts.unionByName(texts.where(F.col("text") == first.text).crossJoin(spark.range(49)).drop("id")), sample=30)
    assert len(set(seen["t"])) == len(seen["t"]) == 60 and sorted(seen["y"]) == [0.0] * 30 + [1.0] * 30
    assert len(set(seen["w"])) == 1  # 40 distinct texts in each class


def test_piece_lattice_lists_the_best_segmentations(docs, nothing):
    own = Lattice(default_model())

    def brute(unit, n):
        found = []

        def go(at, score, path):
            if at == len(unit):
                found.append((score, path))
            for end in range(at + 1, min(len(unit), at + own.longest) + 1):
                piece = own.pieces.get(unit[at:end])
                if piece is not None:
                    go(end, score + own.scores[piece], (*path, piece))
                elif end == at + 1:
                    go(end, score + own.unknown, path + own.spelled(unit[at]))
        go(0, 0.0, ())
        return sorted((s for s, _ in found), reverse=True)[:n]
    for unit in ["▁hello", "▁banana", "x", "▁١x", "▁"]:
        assert [s for s, _ in own.nbest(unit, 5)] == brute(unit, 5)
    texts = {r[0]: r[1] for r in corpus()}
    for r in encode_pieces(docs).collect():
        assert r.decoded == (texts[r.doc_id] or "")
        assert r.nbest_scores[:1] == ([r.score] if texts[r.doc_id] else [])
        assert r.nbest_scores == sorted(r.nbest_scores, reverse=True)
    assert encode_pieces(nothing).collect() == []


def test_all_best_segmentations_come_as_ids(docs):
    own = Lattice(default_model())
    texts = {r[0]: r[1] for r in corpus()}
    several = 0
    for r in encode_pieces(docs).collect():
        assert len(r.nbest_ids) == len(r.nbest_scores) == len({bytes(x) for x in r.nbest_ids})
        assert not texts[r.doc_id] or r.nbest_ids[0] == r.ids
        for ids, score in zip(r.nbest_ids, r.nbest_scores, strict=True):
            ids = np.frombuffer(ids, "<u4")
            assert own.decode(ids) == texts[r.doc_id]
            assert own.cost[ids].sum() == pytest.approx(score)
        several += len(r.nbest_ids) == 4
    assert several > 40


def test_crc_of_ids(spark):
    from pyspark.sql import functions as F
    ids = np.array([1, 70000, 2], "<u4").tobytes()
    assert spark.range(1).select(F.crc32(F.lit(bytearray(ids)))).first()[0] == zlib.crc32(ids)
