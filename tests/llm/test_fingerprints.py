"""One-permutation fingerprints against a plain version, and their likeness against exact Jaccard."""

import hashlib
import random

import pytest
import xxhash
from brute import shingles
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import bin_sketch as B

SCHEMA = "doc_id long, text string"


def h64(values, seed=42):
    """The hash of a list of integers and bytes, one after the other."""
    for v in values:
        raw = v if isinstance(v, bytes) else v.to_bytes(8 if kind(v) else 4, "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def kind(v):
    return not -(1 << 31) <= v < 1 << 31


def plain_print(text, bins=B.BINS, bits=B.BITS):
    words = (text or "").lower().split()
    if not words:
        return []
    runs = [[w.encode() for w in words[i:i + 5]] for i in range(len(words) - 4)] or [[" ".join(words).encode()]]
    least = {}
    for x in map(h64, runs):
        b = x >> 56
        least[b + 128] = min(x, least.get(b + 128, x))
    out = []
    for i in range(bins):
        tries = [i] + [h64([k, i]) % bins for k in range(B.TRIES)]
        found = next((j for j in tries if j in least), None)
        if found is None:
            found = min(sorted(least), key=lambda j: h64([i, (j - 128).to_bytes(8, "little", signed=True)]) & -bins)
        out.append(least[found] & (1 << bits) - 1)
    lanes = 64 // bits
    return [sum(v << bits * k for k, v in enumerate(out[i:i + lanes])) for i in range(0, bins, lanes)]


def words_of(rng, n):
    return [rng.choice("abcdefghij") + str(rng.randrange(4000)) for _ in range(n)]


TEXTS = [None, "", " \n\t", "one", "One two  three", "a b c d e", "Ä b\nc d e f", " ".join(f"w{i}" for i in range(60)),
         " ".join(f"w{i % 7}" for i in range(5000)), "x" * 50_000, "a b c d e"]


def test_fingerprint_is_that_of_the_plain_version(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), SCHEMA)
    got = {r.doc_id: [x % (1 << 64) for x in r.p] for r in rows.select("doc_id", B.fingerprint(F.col("text")).alias("p")).collect()}
    assert got == {i: plain_print(t) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize(("bins", "bits"), [(256, 8), (256, 4), (128, 16), (64, 1)])
def test_likeness_is_near_the_exact_similarity(spark, bins, bits):
    rng, rows = random.Random(5), []
    for k in range(120):
        a = words_of(rng, 40 + 5 * k)
        b = list(a)
        b[rng.randrange(len(b)):] = words_of(rng, rng.randrange(1, 200))
        rows.append((" ".join(a), " ".join(b)))
    rows += [(rows[0][0], rows[0][0]), ("", ""), ("a b", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    p = [B.fingerprint(F.col(c), bins, bits).alias(c) for c in "ab"]
    got = [r.x for r in df.select("*", *[x.alias(f"p{i}") for i, x in enumerate(p)])
           .select(B.likeness(F.col("p0"), F.col("p1"), bins, bits).alias("x")).collect()]
    assert got[-3:] == [1.0, 1.0, 0.0]
    true = [len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for a, b in rows[:-3]]
    errors = [x - t for x, t in zip(got, true)]
    assert all(0 <= x <= 1 for x in got)
    spread = 1 / (bins ** 0.5 * (1 - 2.0 ** -bits))
    assert sum(map(abs, errors)) / len(errors) < 0.6 * spread
    assert abs(sum(errors)) / len(errors) < 0.25 * spread          # no bias left


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0]))
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), plain_print(text), plain_print(edited), plain_print(after)))
    return out


def check(found, rows):
    def text(p):
        return "".join(f"{x:016x}" for x in p)

    def alike(a, b):
        if a == b or not a or not b:
            return float(a == b)
        same = sum(x == y for x, y in zip(bytes.fromhex(text(a)), bytes.fromhex(text(b)))) / B.BINS
        return max(0.0, (same - 2.0 ** -8) / (1 - 2.0 ** -8))
    want = [(i, n, s, text(p), text(e), alike(p, e), alike(p, a)) for i, n, s, p, e, a in expected(rows)]
    got = [tuple(r) for r in found.collect()]
    key = lambda r: (r[0] is not None, r[0], *r[1:4])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], abs=1e-12)


def test_edited_texts_and_next_documents(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(7 * k - 900, " ".join(words_of(rng, rng.randrange(0, 60)))) for k in range(300)]
    rows += [(5000, None), (5001, ""), (5002, "é" * 9), (None, "no id"), (6000, "y " * 20_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for every in (256, 1):        # few buckets, and every document its own
        monkeypatch.setattr(B, "BUCKET_ROWS", every)
        monkeypatch.setattr(B, "_OVERSAMPLE", 2)
        check(B.edited_fingerprints(df), rows)


def test_bounds_are_limited(spark, monkeypatch):
    monkeypatch.setattr(B, "BUCKET_ROWS", 1)
    monkeypatch.setattr(B, "MOST_BOUNDS", 3)
    monkeypatch.setattr(B, "_OVERSAMPLE", 1)
    rows = [(k, f"text {k}") for k in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert len(B._bounds(df.select(F.col("doc_id").alias("__key"), F.xxhash64("text").alias("__mark")))[0]) < 20
    check(B.edited_fingerprints(df), rows)


def test_one_row_no_row_repeats_and_clashing_names(spark):
    check(B.edited_fingerprints(spark.createDataFrame([(1, "a b c d")], SCHEMA)), [(1, "a b c d")])
    none = B.edited_fingerprints(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0
    rows = [(1, "a b"), (1, "a b"), (1, "a b"), (2, "c"), (None, "n"), (None, "n")]
    df = spark.createDataFrame([(*r, 1, "x", "y", 0) for r in rows],
                               SCHEMA + ", __bucket int, print string, next_text string, n_chars int")
    got = B.edited_fingerprints(df)
    assert got.schema == none.schema
    check(got, rows)


def test_only_sql_functions(spark):
    df = B.edited_fingerprints(spark.createDataFrame([(1, "a")], SCHEMA))
    assert isinstance(df.schema["near_edited"].dataType, T.DoubleType)
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "MapPartitions"))
