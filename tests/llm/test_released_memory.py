"""Memory of worker processes between texts."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from strata.llm import packing, words


def test_free_memory_is_given_back_before_each_batch(monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["a b", None, "c"])], names=["id", "text"])
    words.release()
    calls, whole = [], words.release
    monkeypatch.setattr(words, "release", lambda: calls.append(1) or whole())
    assert sum(p.num_rows for p in words.slices(batch, limit=2)) == 3
    assert len(calls) == 1 and list(words.slices(batch.slice(0, 0))) == []


def test_texts_are_encoded_half_a_megabyte_at_a_time(spark, monkeypatch):
    sizes, seen = [], []
    texts = ["word " * 2000] * 300 + [None, "x" * (1 << 20)]
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    kind, whole = type(docs), type(docs).mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, fn, *a, **k: seen.append(fn) or whole(self, fn, *a, **k))
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))

    def encode(column):
        sizes.append([len(t or "") for t in column.to_pylist()])
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, "<u4")
    monkeypatch.setattr(packing, "encoder", lambda path: encode)
    packing.token_pieces(docs, vocabulary="none")
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    assert sum(b.num_rows for b in seen[-1](iter([batch]))) == len(texts)
    assert sum(map(len, sizes)) == len(texts)
    assert all(sum(s) <= 1 << 19 or len(s) == 1 for s in sizes)     # two megabytes before
