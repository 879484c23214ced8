"""Shuffle files of tables that are written or gathered go at once, and texts without a match are not shuffled."""

import re
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from strata.llm.bitmap import bitmap, may_be_in
from strata.llm.graph import saved
from strata.llm.passages import remove_repeats
from strata.session import BATCH_BYTES, SHUFFLES_GO, shuffles_go, small_batches

SCHEMA = "doc_id long, text string, n_chars long"


def shuffle_files(spark) -> set:
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


@pytest.mark.parametrize("end", [lambda t: saved(t, "counts"), lambda t: bitmap(t.select(F.col("g").alias("cell")))])
def test_shuffle_files_go_with_the_query(spark, end):
    table = spark.range(1000).withColumn("g", F.col("id") % 10).groupBy("g").count()
    before, kept = shuffle_files(spark), end(table)
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert kept is not None and not shuffle_files(spark) - before


@pytest.mark.parametrize(("key", "context"), [(SHUFFLES_GO, shuffles_go), (BATCH_BYTES, small_batches)])
def test_setting_is_as_before_after_errors_too(spark, key, context):
    was = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), context(spark):
        assert spark.conf.get(key) != was
        1 / 0
    assert spark.conf.get(key) == was


def test_long_texts_go_to_workers_in_small_batches(spark):
    table = spark.range(0, 100, 1, 1).select(F.repeat(F.lit("x"), 1_000_000).alias("text"))

    def most(batches):
        yield pa.RecordBatch.from_arrays([pa.array([max(b.num_rows for b in batches)])], names=["n"])
    with small_batches(spark):
        assert table.mapInArrow(most, "n long").first().n < 10


def test_nothing_in_the_table_is_passed_over(spark):
    ids = spark.range(0, 300, 3, 3)
    asked = may_be_in(ids.select(F.xxhash64("id").alias("cell")))
    found = {r.id for r in spark.range(0, 300, 1, 2).where(asked(F.xxhash64("id"))).collect()}
    assert set(range(0, 300, 3)) <= found and len(found) < 150


@pytest.fixture(scope="module")
def docs(spark):
    own = [(i, " ".join(f"w{i}x{j}" for j in range(40)), i) for i in range(20)]
    long = " ".join(f"same{j}" for j in range(40))
    rows = own + [(20, long, 0), (21, long, 0), (22, own[3][1] + " tail of its own", 0), (None, long, 0), (None, None, 0), (23, None, 0), (24, "", 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def whole_arm(df) -> str:
    """Physical plan of the part that is passed on as it is."""
    plan = df._jdf.queryExecution().sparkPlan()
    assert plan.nodeName() in ("Union", "Project") or "Union" in plan.toString()
    while plan.nodeName() != "Union":
        plan = plan.children().apply(0)
    return plan.children().apply(0).toString()


def test_documents_no_one_links_with_are_not_joined(spark, docs):
    kept = P.distinct_documents(spark, docs, "")
    assert not re.search("Join|hashpartitioning", whole_arm(kept))
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [*range(21), 23, 24]
    assert kept.where("doc_id is null").count() == 2


def test_texts_without_repeats_are_not_joined(spark, docs):
    cut = remove_repeats(docs)
    assert not re.search("Join|hashpartitioning", whole_arm(cut))
    rows = {r.doc_id: r for r in cut.where("doc_id is not null").collect()}
    before = {r.doc_id: r.text for r in docs.where("doc_id is not null").collect()}
    assert rows.keys() == before.keys()
    assert [i for i in before if rows[i].text != before[i]] == [i for i in before if rows[i].removed_spans] and rows[23].text is None
    assert sorted(i for i in before if rows[i].removed_spans) == [20, 21, 22]     # null ids rank first, and have the long text
    assert rows[22].text == "tail of its own"
    assert sorted(r.text or "" for r in cut.where("doc_id is null").collect()) == ["", " ".join(f"same{j}" for j in range(40))]
