"""Alignment of two tokenizers against a plain version over whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from strata.llm import alignment as A

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def tools():
    return A.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def plain(tools, rows):
    docs, counts = [], Counter()
    for i, text in rows:
        raw = (" " + (text or "")).encode()
        a = tools.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tools.b.encode(text) if text else []
        a_raw, b_raw = [tools.a_bytes[x] for x in a], [tools.b_bytes[x] for x in b]
        if b"".join(a_raw) != raw or b"".join(b_raw) != raw:
            a, b, a_raw, b_raw = [], [], [], []
        a_end, b_end = np.cumsum([len(x) for x in a_raw]).tolist(), np.cumsum([len(x) for x in b_raw]).tolist()
        parts, pairs, at_a, at_b = [], Counter(), 0, 0
        for end in sorted(set(a_end) & set(b_end)):
            to_a, to_b = a_end.index(end, at_a) + 1, b_end.index(end, at_b) + 1
            parts.append(",".join(map(str, a[at_a:to_a])) + "|" + ",".join(map(str, b[at_b:to_b])))
            at_a, at_b = to_a, to_b
        j = 0
        for x, e in zip(a, a_end):
            start = e - len(tools.a_bytes[x])
            while b_end[j] <= start:
                j += 1
            k = j
            while k < len(b) and b_end[k] - len(b_raw[k]) < e:
                pairs[x, b[k]] += 1
                k += 1
        counts.update(pairs.keys())
        docs.append((i, len(a), len(b), len(parts), pairs, hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""))
    high = {}
    for (a, _), n in counts.items():
        high[a] = max(n, high.get(a, 0))
    return counts, [(i, na, nb, g, sum(p.values()), sum(m for q, m in p.items() if counts[q] == high[q[0]]),
                     sum(m * counts[q] for q, m in p.items()), s) for i, na, nb, g, p, s in docs]


ODD = [None, "", " ", "  ", "a", " a", "a ", "\n", "a\n", "\na", "a\n\nb", "a  b   c", "x \n y", "a  b", "é   ü　ö ", "ﬁ x", "a▁b c",
       "<s> <unk> <0x41> <|endoftext|>x", "\t x\ty", "é f", "\x00a\x1f b\x7f c\x85d", "日本語 テキスト\n漢字", "🙂🙂 👩‍👩‍👧", "it's we'll 'tis 12345 1,000.5",
       "y" * 3000, "x  \n z", "don't  stop\r\nnow", "а б в где ёж", "a  b  c"]


def texts(seed, n):
    rng = random.Random(seed)
    pool = ["the", "Straße", "naïve", "ёлка", "one", "two,", "running", "xq9zz", "'s", "日本", "…", "a b", "12", "foo_bar", "\t"]
    gaps = [" "] * 12 + ["\n", "\n\n", "  ", " \n", "\n ", " ", "  ", "\r\n"]
    return ["".join(rng.choice(pool) + rng.choice(gaps) for _ in range(rng.randrange(1, 80))) for _ in range(n)]


def check(spark, tools, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    key = lambda r: (r[0] is not None, r[0], *r[1:])
    assert sorted((tuple(r) for r in A.align_tokenizers(df).collect()), key=key) == sorted(plain(tools, rows)[1], key=key)


def test_numbers_are_those_of_the_plain_version(spark, tools):
    rows = list(enumerate(ODD + texts(1, 150) + texts(1, 20)))
    check(spark, tools, rows + [(None, "no id"), (3, "a b"), (3, "a b")])


def test_dense_bitmaps_and_planes(spark, tools):
    rows = [(i, "the the cat " * (1 + i % 37) + f"x{i}") for i in range(1500)]
    check(spark, tools, rows, 1)


def test_long_text_and_many_blocks(spark, tools):
    rng = random.Random(4)
    long = " ".join(rng.choice(["alpha", "beta,", "Gamma", "δέλτα"]) + str(rng.randrange(50)) for _ in range(20_000))
    rows = [(0, long), *((i, t) for i, t in enumerate(texts(7, 30), 1)), (99, "z" * 50_000)]
    check(spark, tools, rows, 2)


def test_empty_table_and_extra_columns(spark, tools):
    none = A.align_tokenizers(spark.createDataFrame([], SCHEMA))
    assert none.collect() == []
    df = spark.createDataFrame([(1, "a b", 3, "x", 4)], SCHEMA + ", id int, block string, n_a int")
    assert A.align_tokenizers(df).schema == none.schema and A.align_tokenizers(df).count() == 1


def test_postings_and_pair_counts(spark, tools):
    rows = list(enumerate(texts(2, 60)))
    docs, postings = A.index(spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = {(r.a, r.b): (r.docs, r.best) for r in A.pair_counts(postings).collect()}
    counts, _ = plain(tools, rows)
    assert {k: v[0] for k, v in got.items()} == dict(counts)
    id_of = {(r.block, r.row): r.id for r in docs.collect()}
    held = Counter()
    for r in postings.collect():
        at, links = A.unpack(r.n_docs, r.bits, r.planes)
        assert len(at) == r.n_docs and list(at) == sorted(set(at.tolist())) and links.min() >= 1
        for d, m in zip(at.tolist(), links.tolist()):
            held[id_of[r.block, d], r.a, r.b] += m
    per_doc = Counter()
    for (i, _, _), m in held.items():
        per_doc[i] += m
    assert dict(per_doc) == {r.id: r.n_links for r in docs.collect() if r.n_links}


def test_words_are_forgotten_between_blocks_only(spark, tools, monkeypatch):
    own = A.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    monkeypatch.setattr(A, "REMEMBERED", 5)
    import pyarrow as pa
    for k in range(3):
        block = A._Block(k, own)
        rows = block.add(pa.array([1, 2]), pa.array([f"one two three four five six{k}", "one two"])).to_pylist()
        assert [r["n_a"] for r in rows] == [len(tools.a.encode(f" one two three four five six{k}", add_special_tokens=False).ids), 2]
        assert sum(p["n_docs"] for p in block.postings().to_pylist()) >= 6
