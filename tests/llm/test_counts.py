"""Token counts against the library itself."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

from acctmart.llm import piece_bpe, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def odd_texts(n=600):
    rng = random.Random(12)
    letters = "ab 'st\n\t\x1c\x1f\x85  é漢字0٣१ _-!.\0　😀ſK's're▁"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(n)]


TEXTS = [
    None, "", " ", "  ", "a ", "a  ", " a", "a▁ b", "</s> <unk><s>", "<0x0A>\n", "word " * 30_000,
    "x" * 9000, " " * 5000, "the cat sat on the mat", "the cat sat on the hat", *odd_texts(),
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("size", [1, 20, token_counts.FREQUENT])
def test_counts_equal_the_library(spark, documents, library, size):
    rows = [*enumerate(TEXTS), (3, "again"), (3, "again"), (None, "a null id")]
    found = token_counts.count_tokens(documents(*rows), MODEL, limit=4096, size=size).collect()
    wanted = []
    for i, t in rows:
        n = len(library.encode(t or ""))
        wanted.append((i, len((t or "").encode()), n, n > 4096))
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    assert any(r["over_limit"] for r in found)


def test_small_caches_change_nothing(library):
    with open(MODEL, "rb") as file:
        count = token_counts.PretokenCounter(file.read(), {"the": 1}, cached=5)
    texts = [t or "" for t in TEXTS]
    found = [n for i in range(0, len(texts), 7) for n in count(texts[i : i + 7])]
    assert found == [len(library.encode(t)) for t in texts]


def test_frequent_pretokens_are_found_in_rounds(spark, documents, monkeypatch):
    """Every pre-token of more than one in ``size`` is there, however many tasks and rounds."""
    monkeypatch.setattr(token_counts, "FAN_IN", 2)
    rng = random.Random(3)
    texts = [" ".join(["common"] * 3 + ["often"] * 2 + [f"w{rng.randrange(10**6)}" for _ in range(9)]) for _ in range(90)]
    docs = documents(*enumerate(texts)).repartition(9)
    found = token_counts.frequent_pretokens(docs, size=8)
    assert {"common", "often"} <= set(found) and len(found) <= 8


def test_models_whose_counts_do_not_add_up_encode_whole_texts(spark, documents, tmp_path, library):
    with open(MODEL, "rb") as file:
        model = file.read()
    assert token_counts.counts_add_up(model)
    ranks = piece_bpe.piece_model([bytes([b]) for b in range(256)] + [b"a b", b" a"])
    assert not token_counts.counts_add_up(ranks)
    path = tmp_path / "other.model"
    path.write_bytes(ranks)
    other = sentencepiece.SentencePieceProcessor(model_proto=ranks)
    texts = ["a a b", "", " a  b"]
    found = token_counts.count_tokens(documents(*enumerate(texts)), str(path)).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in found} == {i: len(other.encode(t)) for i, t in enumerate(texts)}


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_tokens int")
    assert token_counts.count_tokens(docs, MODEL).collect() == []
