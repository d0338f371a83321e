"""The registered queries of the operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm import byte_cnn, decision_list, lattice_lm, lengths, line_dedup
from monthwise.llm import packing, piece_bpe, pq_dedup, resample, simhash, spelling, toxicity
from monthwise.llm import vertical_topk
from monthwise.llm.common import remainder

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
SIZE = 2048


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Learned from the documents whose remainder by 5 is not 0."""
    return toxicity.fit(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"),
        remainder(F.col("_id"), 5) != 0,
    )


def quality_network(spark: SparkSession, sf_dir: str) -> byte_cnn.Network:
    """Learned from the documents whose remainder by 3 is not 1."""
    return byte_cnn.fit(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"),
        remainder(F.col("_id"), 3) != 1,
    )


def _predicted(docs: DataFrame, score, held) -> DataFrame:
    scored = docs.select("doc_id", held.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = toxicity_model(spark, sf_dir)
    docs = _table(spark, sf_dir, "documents")
    return _predicted(
        docs, toxicity.toxicity_score(F.col("text"), model), remainder(F.col("doc_id"), 5) == 0
    )


def packed(docs: DataFrame) -> DataFrame:
    """Pieces with their places in sequences of ``SIZE`` tokens."""
    pieces = packing.token_pieces(docs, public_tokenizers.path(BYTE_BPE), SIZE)
    return packing.pack(pieces, SIZE)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_common_lines(docs, min_docs=10).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_bpe.encode_and_decode(docs, public_tokenizers.path(PIECES))
    return coded.select(
        "doc_id", F.size("_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("_ids", ","), 256).alias("ids_sha256"),
        F.sha2("_decoded", 256).alias("decoded_sha256"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_component").alias("component_id"),
    )


def op6_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return lattice_lm.lattice_scores(docs, public_tokenizers.path(PIECES))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    sizes = lengths.encoded_lengths(docs, public_tokenizers.path(BYTE_BPE))
    return lengths.length_histogram(sizes)


def op8_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pq_dedup.vector_components(_table(spark, sf_dir, "embeddings"), threshold=0.93)
    return found.select(
        "vec_id", F.col("_n_links").alias("n_links"), F.col("_component").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.col("_component")).alias("kept"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = decision_list.quality_rules(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    network = quality_network(spark, sf_dir)
    docs = _table(spark, sf_dir, "documents")
    return _predicted(
        docs, byte_cnn.quality_score(F.col("text"), network), remainder(F.col("doc_id"), 3) == 1
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(_table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return vertical_topk.top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


LINE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
lines AS (
  SELECT rid, doc_id, unnest(string_split(body, chr(10))) AS line,
         generate_subscripts(string_split(body, chr(10)), 1) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= 10)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE common.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
              FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key)
GROUP BY rid, doc_id
"""

VECTOR_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links,
       r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = e.vec_id
"""

TOPK_SQL = """
WITH rows AS (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
items AS (SELECT rid, vec_id, len(v) AS dim, unnest(v) AS x, generate_subscripts(v, 1) AS at FROM rows),
scores AS (
  SELECT q.rid AS qid, q.vec_id AS query_id, c.rid, c.vec_id, sum(q.x * c.x) AS score
  FROM items q JOIN items c ON q.at = c.at AND q.dim = c.dim AND q.rid <> c.rid
  WHERE q.vec_id % 100 = 0 GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id NULLS LAST, rid) AS place
  FROM scores)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM ranked WHERE place <= 10
"""

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_line_dedup": op3_line_dedup,
    "op4_pieces": op4_pieces,
    "op5_simhash": op5_simhash,
    "op6_lattice_lm": op6_lattice_lm,
    "op7_token_counts": op7_token_counts,
    "op8_vector_dedup": op8_vector_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_byte_cnn": op10_byte_cnn,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_exact_topk": op13_exact_topk,
}

ORACLES = {
    "op3_line_dedup": LINE_SQL, "op8_vector_dedup": VECTOR_SQL, "op13_exact_topk": TOPK_SQL,
}
