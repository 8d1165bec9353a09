"""The pipeline against a plain version of all its stages."""

from __future__ import annotations

import base64
import hashlib
import os

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from acctmart.llm import byte_cnn

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_against_plain_stages(spark):
    docs, labels, benchmark = (
        spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels", "benchmark")
    )
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    model = byte_cnn.train_on(docs, labels, "quality")
    ids = sorted(texts)
    scores = byte_cnn.score_texts(model, [texts[i] for i in ids])
    kept = [i for i, s in zip(ids, scores) if s >= 0.3]
    last = {texts[i]: i for i in kept}  # of equal texts the largest id
    kept = sorted(last.values())
    near = brute.components({i: texts[i] for i in kept}, width=5, percent=80)
    # Rows without words link with nothing and stand for themselves.
    kept = [i for i in kept if near[i][1] == i]
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    verdicts = brute.contamination([texts[i] for i in kept], items)
    kept = [i for i, v in zip(kept, verdicts) if not v[-1]]
    assert 0 < len(kept) < len(ids)

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert sorted(rows) == kept
    for i, r in rows.items():
        assert r["ids"] == library.encode_ordinary(texts[i])
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[i].encode()).hexdigest()


def test_stages_of_odd_and_empty_tables(spark, tmp_path):
    """Stages in turn over nulls, repeats and clashing columns, and over no rows."""
    folder = str(tmp_path)
    labels = "doc_id long, quality int, toxic int"
    spark.createDataFrame([(1, 1, 0)], labels).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "p q r s t")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [
        (1, None, "a"), (2, "", "b"), (3, "one two three four five six", "c"), (3, "one two three four five six", "c"),
        (4, "one two three four five six", "d"), (5, "so p q r s t it is", "e"), (None, "x y z", "f"), (6, "w " * 50_000, "g"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _score string")
    docs = docs.selectExpr("doc_id", "text", "_score", "_score AS _key", "_score AS _id", "1 AS n_words")
    for table in (docs, docs.where("doc_id > 99")):
        found = table
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            before = found.columns
            found = stage(spark, found, folder)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert found.columns == before
        ids = sorted(repr(r["doc_id"]) for r in found.collect())
        assert ids == (["2", "4", "6", "None"] if table is docs else [])
