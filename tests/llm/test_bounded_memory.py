"""Hashing and features of many texts at once in bounded memory, with unchanged values."""

import tracemalloc

import numpy as np
import pyarrow as pa

from strata.llm import jaccard_join, subword, toxicity, words


def test_spans_hashed_some_at_a_time_have_the_hashes_of_all_at_once(monkeypatch):
    rng = np.random.default_rng(3)
    column = pa.array([" ".join("x" * n for n in rng.integers(1, 40, 30)) for _ in range(20)] + ["", None, "y" * 500, " z "])
    bounds, data = words.bounds_and_bytes(column)
    starts, ends, _ = words.word_spans(bounds, data)
    want = words.run_hashes(data.astype(np.uint64) + np.uint64(1), starts, ends)
    for size in (1, 64, 1 << 18):
        monkeypatch.setattr(words, "SPAN_BYTES", size)
        assert (words.span_hashes(data, starts, ends) == want).all()


def test_features_of_many_texts_need_memory_by_words_not_by_bytes(monkeypatch):
    rng = np.random.default_rng(4)
    vocabulary = np.array(["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(3000)])
    texts = pa.array([" ".join(rng.choice(vocabulary, 400)) for _ in range(1500)])
    tracemalloc.start()
    f = toxicity.Features(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * texts.nbytes          # eight bytes for each byte, several times, before
    monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", 7)
    few = toxicity.Features(texts)
    assert (few.grams == f.grams).all() and (few.gram_starts == f.gram_starts).all() and (few.gram_count == f.gram_count).all()


def test_new_words_go_to_the_library_some_at_a_time(monkeypatch):
    rng = np.random.default_rng(5)
    texts = pa.array([" ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(500)) for _ in range(40)] + ["a  b", None])
    own = subword.Encoder(subword.default_vocabulary())
    sizes, ids_of = [], own._ids_of
    monkeypatch.setattr(own, "_ids_of", lambda w: sizes.append(len(w)) or ids_of(w))
    bounds, flat = own(texts)
    assert sum(sizes) > 1 << 14 and max(sizes) <= 1 << 13      # all of them at once before
    for i, text in enumerate(texts.to_pylist()):
        assert flat[bounds[i]:bounds[i + 1]].tolist() == own.whole(text or "")
    monkeypatch.setattr(subword, "LEARNT_AT_ONCE", 3)
    monkeypatch.setattr(subword, "STORE", 64)                  # learnt words push each other out
    few = subword.Encoder(subword.default_vocabulary())
    bounds, flat = few(texts.slice(0, 2))
    assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [own.whole(t) for t in texts.to_pylist()[:2]]


def test_scoring_gets_a_carried_text_once_and_drops_the_tables_of_earlier_tasks(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "some text", "en"), (2, None, "de")], "doc_id long, text string, lang string")
    seen = []
    kind, whole = type(docs), type(docs).mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, fn, *a, **k: seen.append((self, fn)) or whole(self, fn, *a, **k))
    scored = toxicity.score(docs, {"share": 0.25})
    assert scored.columns == ["doc_id", "text", "lang", "toxicity", "n_windows"]
    assert [tuple(r) for r in scored.orderBy("doc_id").collect()] == [(1, "some text", "en", 0.25, 1), (2, None, "de", 0.25, 1)]
    assert len(seen[0][0].columns) == 3                        # the text twice before
    named = toxicity.score(docs, {"share": 0.25}, ["doc_id"])
    assert named.columns == ["doc_id", "toxicity", "n_windows"] and named.count() == 2
    subword.encoder(subword.default_vocabulary())
    list(seen[0][1](iter(seen[0][0].toArrow().to_batches())))
    assert subword.encoder.cache_info().currsize == 0


def test_compared_texts_are_copied_some_at_a_time(spark, monkeypatch):
    rows = 300
    texts = spark.createDataFrame([(0, "a b")], "mark long, text string")
    marks = spark.createDataFrame([(bytes([i // 256, i % 256]), i) for i in range(rows)], "key binary, mark long")
    pairs = marks.select(marks.key.alias("a"), marks.key.alias("b"))
    seen, kind, whole = [], type(texts), type(texts).mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, fn, *a, **k: seen.append(fn) or whole(self, fn, *a, **k))
    jaccard_join.verify(jaccard_join.Marked(texts, marks), pairs, 4, 5)
    batch = pa.RecordBatch.from_arrays([pa.array(range(rows)), pa.array([f"word{i} and more " * 2500 for i in range(rows)])], names=["mark", "text"])
    before, found = pa.total_allocated_bytes(), seen[-1](iter([batch]))
    first = next(found)
    assert pa.total_allocated_bytes() - before < batch.nbytes / 2      # all the texts before
    assert first.num_rows + sum(b.num_rows for b in found) == rows
