"""Repeated passages from packed runs: few rows to shuffle, odd ids, chunks of any size."""

import random

from pyspark.sql import functions as F

from strata.llm import passages as P

LEAST = -(1 << 63)


def texts():
    rng = random.Random(11)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))
    shared = [prose(45) for _ in range(4)]
    return [f"{prose(20)} {shared[i % 4]} {prose(20)}" for i in range(24)]


def removed(spark, rows, kind="long"):
    """Per row, in order of id and hash of the text: id, whole text, spans removed."""
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(3)
    return [(r.doc_id, r.whole, [(s.begin, s.end) for s in r.removed_spans])
            for r in P.remove_repeats(docs.withColumn("whole", F.col("text"))).orderBy("doc_id", F.xxhash64("whole")).collect()]


def test_runs_are_shuffled_packed_and_not_one_row_each(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "k long, text string").select("k", F.xxhash64("text").alias("mark"), "text").coalesce(1)
    dealt = P._run_rows(docs, P.UNIT_WORDS, P.MIN_WORDS, 4).collect()
    runs = sum(len(r.runs) // 32 for r in dealt)
    assert len(dealt) <= 8 and runs >= 4 * 16 and sum(len(r.known) for r in dealt)


def test_chunks_and_kinds_of_id_do_not_change_what_goes(spark, monkeypatch):
    whole = texts()
    by_id = removed(spark, [(i, t) for i, t in enumerate(whole)])
    assert [bool(s) for *_, s in by_id] == [i >= 4 for i in range(24)]
    monkeypatch.setattr(P, "HELD", 200)
    for name, kind in ((lambda i: f"d{i:03d}", "string"), (lambda i: LEAST + i, "long")):
        got = removed(spark, [(name(i), t) for i, t in enumerate(whole)], kind)
        assert [x[1:] for x in got] == [x[1:] for x in by_id]


def test_repeated_and_null_ids_rank_by_text_and_first(spark):
    one, two = texts()[0], texts()[4]
    for rows in ([(5, one), (5, one), (5, two)], [(None, one), (None, one), (LEAST, two)]):
        got = removed(spark, rows)
        assert len({bool(s) for _, t, s in got if t == one}) == 1
        assert {bool(s) for *_, s in got} == {True, False}
        if rows[0][0] is None:
            assert all((i is None) == (not s) for i, _, s in got)
