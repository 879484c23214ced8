"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.alignment import align_tokenizers
from strata.llm.bin_sketch import edited_fingerprints
from strata.llm.graph import saved
from strata.llm.jaccard_join import near_duplicate_groups
from strata.llm.packing import place, token_pieces
from strata.llm import backoff_lm, main_text, toxicity
from strata.llm.passages import remove_repeats
from strata.llm.piece_lattice import encode_pieces
from strata.llm.top_k import top_k
from strata.llm.vector_links import vector_groups
from strata.llm.wavelet import read_shards, write_shards
from strata.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _folds(docs: DataFrame, folds: int):
    """Remainder of the unsigned crc32 of the id as text; null ids have none."""
    return F.crc32(docs["doc_id"].cast("string").cast("binary")) % folds


def op1_cover_tree_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_groups(_table(spark, sf_dir, "embeddings"))


def op3_dual_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> dict:
    """Network trained on the labelled rows that are not held out."""
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.fit_joined(docs.where(_folds(docs, 5) != 0).select("doc_id", "text"), labels)


def op2_gated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir, docs), ["doc_id"])
    return scored.select("doc_id", F.coalesce(_folds(scored, 5) == 0, F.lit(False)).alias("held_out"),
                         F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"), "n_windows")


def op4_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    training = F.coalesce(_folds(docs, 7) != 2, F.lit(True))
    model, words = backoff_lm.train(docs.where(training).select("text"))
    scored = backoff_lm.score(docs, model, words, training=training)
    return scored.select("doc_id", F.coalesce(_folds(scored, 7) == 2, F.lit(False)).alias("held_out"),
                         "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return (main_text.main_text(pages.select("page_id", "url", "html"), main_text.fit(pages))
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))


def op6_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_shards(write_shards(_table(spark, sf_dir, "documents")))
    return docs.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of all documents with the digest of their ids and their place."""
    pieces = token_pieces(docs)
    digests = saved(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return place(digests).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(_table(spark, sf_dir, "documents"))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", F.size("removed_spans").cast("long").alias("n_removed"),
                      F.aggregate("removed_spans", F.lit(0).cast("long"), lambda a, s: a + s.end - s.begin).alias("removed_bytes"),
                      F.length("text").cast("long").alias("kept_chars"), F.crc32(F.col("text").cast("binary")).alias("kept_crc32"),
                      F.col("removed_spans").cast("string").alias("removed_spans"))


def op10_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = encode_pieces(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), "score",
                        F.crc32("ids").alias("ids_crc32"), F.col("nbest_scores").cast("string").alias("nbest_scores"),
                        F.transform("nbest_ids", F.crc32).cast("string").alias("nbest_crc32"),
                        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"))


def op11_covariance_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where the exact number is beyond a long; ``exact_deviation`` always has it."""
    found = whiten(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", components=8)
    return found.select("vec_id", "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "whitened", "explained",
                        "identity_error", F.col("deviation").alias("exact_deviation"))


def op12_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(_table(spark, sf_dir, "documents"))


def op13_bin_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_cover_tree_groups": op1_cover_tree_groups,
    "op2_gated_toxicity": op2_gated_toxicity,
    "op3_dual_tree_top_k": op3_dual_tree_top_k,
    "op4_backoff_automaton": op4_backoff_automaton,
    "op5_main_text": op5_main_text,
    "op6_wavelet_matrix": op6_wavelet_matrix,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_nbest_pieces": op10_nbest_pieces,
    "op11_covariance_whitening": op11_covariance_whitening,
    "op12_pair_bitmaps": op12_pair_bitmaps,
    "op13_bin_sketch": op13_bin_sketch,
}

# Roots by following links from every row; a link table ``links(a, b)`` holds both directions.
_ROOTS = """reach AS (SELECT DISTINCT a AS node, a AS root FROM links UNION SELECT l.b, r.root FROM reach r JOIN links l ON r.node = l.a),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)"""

ORACLE_SQL: dict[str, str] = {
    "op1_cover_tree_groups": f"""
WITH RECURSIVE sound AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM sound p JOIN sound q ON p.label = q.label AND p.vec_id <> q.vec_id
  WHERE list_cosine_similarity(p.v, q.v) >= 0.93),
{_ROOTS},
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN counts ON a = vec_id LEFT JOIN roots ON node = vec_id""",
    "op8_jaccard_join": f"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (SELECT p.doc_id AS a, q.doc_id AS b FROM tokens p JOIN tokens q ON p.t = q.t AND p.doc_id <> q.doc_id
    AND 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
{_ROOTS}
SELECT doc_id, len(s) AS n_shingles, coalesce(root, doc_id) AS component_id
FROM sets LEFT JOIN roots ON node = doc_id""",
    "op3_dual_tree_top_k": """
WITH sound AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM sound q JOIN sound c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20""",
}
