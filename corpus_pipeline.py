"""From raw documents to token ids: filter, deduplicate, decontaminate, encode.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from acctmart.llm import byte_cnn, chunk_dedup, piece_bpe, positional_index, token_groups
from acctmart.llm.common import read_table, shared_path, write_table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return byte_cnn.without_rejected(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return chunk_dedup.keep_one_of_each(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that reach each other by near-duplicate links, that of the smallest doc_id.

    Links take five words and a similarity of 0.8.
    """
    return token_groups.one_of_each_component(docs, width=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not contain benchmark passages."""
    benchmark = read_table(spark, sf_dir, "benchmark")
    return positional_index.without_contaminated(docs, benchmark, shared_path(spark, "index"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the bytes decoded from them, and the ids."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return piece_bpe.encode_pieces(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("byte-level BPE", token_ids),
]

#: SQL can express neither the classifier nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs, _ = write_table(docs, "stage")
    return docs
