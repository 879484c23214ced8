"""A training corpus in four stages: toxic documents go, near-duplicates go, repeated
passages go, and what is left is tokenised and packed.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it
kept; its result is written and read again. All but the last return the columns of
``documents``. Null and blank texts are kept and never linked; rows that share an id
are one document and stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import suite, toxicity
from strata.llm.bitmap import may_be_in
from strata.llm.graph import saved
from strata.llm.jaccard_join import near_duplicate_groups
from strata.llm.passages import remove_repeats


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose highest window is likelier clean than toxic; columns of the scores' names stay as they are."""
    model = suite.toxicity_model(spark, sf_dir, docs)
    own = {c: f"__kept_{c}" for c in ("toxicity", "n_windows") if c in docs.columns}
    scored = toxicity.score(docs.withColumnsRenamed(own), model).where("toxicity < 0.5")
    return scored.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each near-duplicate group; only rows that a bitmap of the others lets through are joined with them."""
    others = saved(near_duplicate_groups(docs).where("doc_id <> component_id").select("doc_id").distinct(), "others")
    may_go = may_be_in(others.select(F.xxhash64("doc_id").alias("cell")))(F.xxhash64("doc_id"))
    asked = docs.where(may_go).join(others, "doc_id", "left_anti").select(*docs.columns)
    return docs.where(~may_go).unionByName(asked)


def distinct_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier one has."""
    cut = remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences of 2048."""
    return suite.packed(docs)


STAGES = [("toxicity", clean), ("near duplicates", distinct_documents),
          ("repeated passages", distinct_passages), ("packing", packed)]

ORACLE_SQL = None  # a trained network and a byte-pair vocabulary have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "stage")
    return docs
