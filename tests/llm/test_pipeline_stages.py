"""Pipeline stages on rows with nulls, blanks, repeats and clashing columns, and on an empty table."""

import pytest

import corpus_pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, toxicity double, n_windows string, component_id long"


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"word{i}" for i in range(60))
    texts = [(1, None), (2, ""), (3, " \n"), (None, "no id " + long), (None, None), (4, long), (5, long), (5, long), (6, long + " end"), (7, "a b")]
    return spark.createDataFrame([(i, t, None, "s", len(t or ""), 9.0, "w", 77) for i, t in texts], SCHEMA).repartition(2)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_clean_keeps_rows_and_foreign_columns(spark, odd, sf_small):
    kept = P.clean(spark, odd, sf_small)
    assert kept.columns == odd.columns
    assert rows(kept) == rows(odd)          # nothing toxic among them; their own scores are untouched
    assert P.clean(spark, odd.limit(0), sf_small).collect() == []


def test_one_document_of_each_group_stays(spark, odd, sf_small):
    kept = P.distinct_documents(spark, odd, sf_small)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.collect() if r.doc_id is not None))
    assert ids == [1, 2, 3, 4, 7]
    assert sum(r.doc_id is None for r in kept.collect()) == 2      # without id: kept, linked or not
    assert P.distinct_documents(spark, odd.limit(0), sf_small).collect() == []
