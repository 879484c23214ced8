"""Sets are made again only of the texts that are compared."""

from strata.llm import jaccard_join as J


def test_texts_outside_all_pairs_are_not_hashed_again(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(30)]
    rows += [(100 + i, " ".join(f"s{k}" for k in range(60 + i))) for i in range(3)] + [(200, rows[0][1]), (201, None)]
    spread, real = [], J.verify

    def counted(texts, pairs, num, den):
        tokens = texts.rows.join(texts.marks, "mark")
        spread.append((tokens.count(), texts.marks.count()))
        return real(texts, pairs, num, den)
    monkeypatch.setattr(J, "verify", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in J.near_duplicate_groups(docs).collect()}
    assert got == {**{i: i for i, _ in rows}, 101: 100, 102: 100, 200: 0}
    assert set(spread) == {(34, 33)}            # one text of each key, with its copies

    keyed = J.describe(spark.createDataFrame(rows, "id long, text string").selectExpr("id", "xxhash64(text) AS mark", "text"),
                       J.frequent_tokens(docs), 4, 5).where("n > 0").select("key", "id", "mark").collect()
    key = {r.id: r.key for r in keyed}
    marks = spark.createDataFrame([(r.key, r.mark) for r in keyed if r.id != 200], "key binary, mark long")
    pairs = spark.createDataFrame([(key[100], key[101]), (key[1], key[2])], "a binary, b binary")
    texts = docs.selectExpr("xxhash64(text) AS mark", "text").coalesce(1)
    assert [tuple(map(bytes, r)) for r in real(J.Marked(texts, marks), pairs, 4, 5).collect()] == [(key[100], key[101])]
    other = marks.where(marks.key != bytearray(key[101]))      # its text is not looked at without its mark
    assert real(J.Marked(texts, other), pairs, 4, 5).collect() == []
