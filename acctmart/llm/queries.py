"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctmart.llm import (
    byte_cnn,
    chunk_dedup,
    clause_grammar,
    crf_language,
    hard_negatives,
    html_text,
    id_files,
    license_scan,
    periodic_runs,
    piece_bpe,
    positional_index,
    token_counts,
    token_groups,
)
from acctmart.llm.common import read_table, shared_path


def op1_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_language.predict_language(read_table(spark, sf_dir, "documents"))


def op2_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "ids")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    docs = read_table(spark, sf_dir, "documents")
    id_files.write_id_files(docs, path, tokenizer, end_id=2, special_as_text=False)
    return id_files.read_id_files(spark, path, with_ids=False)


def op3_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = read_table(spark, sf_dir, "documents")
    return piece_bpe.encode_pieces(docs, ranks, public_tokenizers.PATTERN, with_ids=False)


def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op5_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_groups.jaccard_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op6_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    found = positional_index.contamination(docs, benchmark, shared_path(spark, "index"))
    return found.drop("text_key")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(read_table(spark, sf_dir, "pages"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


def op9_clause_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return clause_grammar.score_toxicity(docs, labels)


def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return byte_cnn.score_quality(docs, labels)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(read_table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), model)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read_table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mine(rows, anchors=F.col("vec_id") % 50 == 0)


_EXACT_GROUPS = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

_HARD_NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           list_inner_product(a.vec, b.vec)::BIGINT AS score
    FROM vectors a JOIN vectors b ON len(a.vec) = len(b.vec) AND a.vec_id <> b.vec_id
    WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 3
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_crf_language": op1_crf_language,
        "op2_id_files": op2_id_files,
        "op3_piece_bpe": op3_piece_bpe,
        "op4_chunk_dedup": op4_chunk_dedup,
        "op5_token_groups": op5_token_groups,
        "op6_positional_index": op6_positional_index,
        "op7_html_text": op7_html_text,
        "op8_license_scan": op8_license_scan,
        "op9_clause_grammar": op9_clause_grammar,
        "op10_byte_cnn": op10_byte_cnn,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_token_counts": op12_token_counts,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_chunk_dedup": _EXACT_GROUPS, "op13_hard_negatives": _HARD_NEGATIVES}
