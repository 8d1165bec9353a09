"""Exact groups by chunk recipes."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from acctmart.llm import chunk_dedup


def expected(pairs):
    best, size = {}, Counter()
    for i, t in pairs:
        t = t or ""
        size[t] += 1
        best[t] = max(best.get(t, -1), -1 if i is None else i)
    return best, size


LONG = " ".join(f"word{i % 977} other{i % 31}" for i in range(40_000))
PAIRS = [
    (1, "same text"), (2, "same text"), (5, None), (4, ""), (6, LONG), (7, LONG), (8, LONG + "."),
    (9, "x" + LONG), (None, "same text"), (10, "é" * 3000), (11, "é" * 2999), (3, "alone"),
    (2, "same text"),
]


@pytest.mark.parametrize("hash_of", [chunk_dedup.chunk_hash, lambda chunk: len(chunk) % 3])
def test_groups(spark, documents, hash_of):
    """Also with a hash that nearly all chunks share, so that contents decide."""
    rows = chunk_dedup.exact_groups(documents(*PAIRS), hash_of).collect()
    best, size = expected(PAIRS)
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in best}
    assert len(rows) == len(PAIRS)
    for r in rows:
        text = sha[r["text_sha256"]]
        assert (r["keep_id"], r["group_size"]) == (best[text], size[text])
    kept = Counter((r["doc_id"], r["text_sha256"]) for r in rows if r["kept"])
    assert kept == Counter({(best[t], s): 1 for s, t in sha.items()})


def test_stage_keeps_whole_rows(spark, documents):
    docs = documents(*PAIRS)
    kept = chunk_dedup.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    best, _ = expected(PAIRS)
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == sorted((i, t) for t, i in best.items())


def test_empty_table(spark, documents):
    docs = documents((1, "a")).where("doc_id > 1")
    assert chunk_dedup.exact_groups(docs).collect() == []
    assert chunk_dedup.keep_one_of_each(docs).collect() == []


def test_null_ids(spark, documents):
    rows = chunk_dedup.exact_groups(documents((None, "a"), (None, "a"))).collect()
    assert [r["keep_id"] for r in rows] == [None, None]
    assert sum(r["kept"] for r in rows) == 1


def test_chunks_make_up_the_text_and_shift_with_it():
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(60_000))
    (data, chunks), (_, moved) = chunk_dedup.chunks_of([text, "new start " + text])
    assert b"".join(chunks) == data
    assert max(map(len, chunks)) <= chunk_dedup.LARGEST
    assert min(map(len, chunks[:-1])) >= chunk_dedup.SMALLEST
    assert len(set(chunks) & set(moved)) >= len(chunks) - 3
