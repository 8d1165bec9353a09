"""Id files and the sentencepiece encoding, against the libraries themselves."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from acctmart.llm import id_files, piece_bpe

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def odd_texts(n=400):
    rng = random.Random(1)
    letters = "ab 'st\n\t\x1c\x1f\x85  é漢字0٣१ _-!.\0　😀ſK's're"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(n)]


TEXTS = [None, "", " ", "  two  spaces ", "<|endoftext|> as text", "word " * 30_000, "\n\n a\n b", *odd_texts()]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ids") / "files")
    rows = [(None if i == 3 else 2 * i, t, 1) for i, t in enumerate(TEXTS)] + [(4, TEXTS[2], 2), (4, "again", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    id_files.write_id_files(docs, path, JSON, end_id=2)
    return path, sorted(rows, key=lambda r: (r[0] is not None, r[0]))


def test_ids_come_back(spark, written):
    path, rows = written
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    found = id_files.read_id_files(spark, path).collect()
    assert len(found) == len(rows)
    by_start = sorted(found, key=lambda r: r["start"])
    ids = [r["doc_id"] for r in by_start]
    assert ids == [r[0] for r in rows]
    start = 0
    wanted = sorted(
        (repr(i), [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t, _ in rows
    )
    assert sorted((repr(r["doc_id"]), r["ids"]) for r in found) == wanted
    for r in by_start:
        assert (r["start"], r["n_tokens"]) == (start, len(r["ids"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]


def test_special_names_are_ids_by_the_library_s_default(spark, tmp_path):
    mark = "<|endoftext|>"
    texts = [mark, f"a {mark} b", f"a{mark}b", f" {mark}{mark} ", f"one two {mark}", "<|endof text|> a", "plain words"]
    texts += [t.replace(" ", f" {mark}", 1) for t in odd_texts(60) if t]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    library = Tokenizer.from_file(JSON)
    for name, as_text in (("a", False), ("b", True)):
        library.encode_special_tokens = as_text
        id_files.write_id_files(docs, str(tmp_path / name), JSON, special_as_text=as_text)
        found = {r["doc_id"]: r["ids"] for r in id_files.read_id_files(spark, str(tmp_path / name)).collect()}
        assert found == {i: [*library.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
        assert (50256 in found[1]) != as_text


def test_one_document(spark, written):
    path, _ = written
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    assert id_files.read_document(spark, path, 10) == [[*library.encode(TEXTS[5], add_special_tokens=False).ids, 2]]
    assert len(id_files.read_document(spark, path, 4)) == 3
    assert id_files.read_document(spark, path, 5) == []


def test_another_dictionary_is_refused(spark, tmp_path):
    path = str(tmp_path / "files")
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    id_files.write_id_files(docs, path, JSON)
    spark.createDataFrame(
        [(hashlib.sha256(b"other").hexdigest(), b"other")], "hash string, dictionary binary"
    ).write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(Exception, match="dictionary"):
        id_files.read_id_files(spark, path).collect()


def test_no_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    id_files.write_id_files(docs, str(tmp_path / "files"), JSON)
    assert id_files.read_id_files(spark, str(tmp_path / "files")).collect() == []
    assert piece_bpe.encode_pieces(docs, RANKS, public_tokenizers.PATTERN).collect() == []


def test_pieces_equal_the_rank_library(spark, documents):
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = documents(*enumerate(TEXTS), (1, ""), (None, "a null id"))
    found = piece_bpe.encode_pieces(docs, RANKS, public_tokenizers.PATTERN, decoded=True).collect()
    assert len(found) == len(TEXTS) + 2
    for r in found:
        text = "a null id" if r["doc_id"] is None else TEXTS[r["doc_id"]] or ""
        assert r["ids"] == library.encode_ordinary(text)
        assert bytes(r["decoded"]) == library.decode_bytes(r["ids"])
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(bytes(r["decoded"])).hexdigest()


def test_every_token_is_itself():
    tokens = piece_bpe.read_ranks(RANKS)
    codec = piece_bpe.PieceCodec(piece_bpe.piece_model(tokens), public_tokenizers.PATTERN)
    assert codec.bytes_of == tokens
