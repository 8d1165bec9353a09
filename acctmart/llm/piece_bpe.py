"""Byte-level BPE through a sentencepiece model made from a rank file.

The model is written directly from the vocabulary: each token's bytes become characters of
their own, its score is its negative rank, and the normaliser changes nothing. Merging the
pair of best score then is merging the pair of lowest rank, leftmost first. Stretches that
the pattern matches are encoded one by one; one that is a token itself is that token. Ids are
decoded by the model's pieces mapped back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctmart.llm.chunk_cache import StretchEncoder
from acctmart.llm.common import give_back, slices

#: The character that stands for byte b in a piece is chr(FIRST + b).
FIRST = 0x100
_TO_CHARS = {b: FIRST + b for b in range(256)}
_TO_BYTES = {FIRST + b: b for b in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank. Ranks must be 0, 1, 2 and so on."""
    with open(path, "rb") as file:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, file)}
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protocol buffer field."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(int(value))


def piece_model(tokens: list[bytes]) -> bytes:
    """A serialized sentencepiece BPE model with these tokens as pieces 0, 1, 2 and so on."""
    normal, unknown, bpe = 1, 2, 2
    out = []
    for rank, token in enumerate(tokens):
        piece = token.decode("latin-1").translate(_TO_CHARS).encode()
        out.append(_field(1, _field(1, piece) + _field(2, float(-rank)) + _field(3, normal)))
    out.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)))
    absent = (1 << 64) - 1  # -1: no piece for begin, end and padding
    trainer = {3: bpe, 4: len(tokens) + 1, 40: len(tokens), 41: absent, 42: absent, 43: absent}
    out.append(_field(2, b"".join(_field(k, v) for k, v in trainer.items())))
    # Identity: no dummy prefix, white space neither removed nor escaped.
    out.append(_field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)))
    return b"".join(out)


class PieceCodec:
    """Encodes and decodes with a model of ``piece_model``."""

    def __init__(self, model: bytes, pattern: str) -> None:
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.processor.id_to_piece(i) for i in range(self.processor.vocab_size() - 1)]
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.bytes_of = [p.translate(_TO_BYTES).encode("latin-1") for p in pieces]
        self.split = regex.compile(pattern).findall
        self.encode = StretchEncoder(self._encode)

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = [[w.encode().decode("latin-1").translate(_TO_CHARS) for w in self.split(t)] for t in texts]
        merged = list({w for ws in found for w in ws if w not in self.ids})
        known = dict(zip(merged, self.processor.encode(merged, num_threads=1)))
        ids = self.ids
        return [
            np.array([i for w in ws for i in ((ids[w],) if w in ids else known[w])], "<u4").tobytes()
            for ws in found
        ]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_CODECS: dict[int, PieceCodec] = {}


def _codec(model: bytes, pattern: str) -> PieceCodec:
    """The task's codec; kept by the worker process."""
    key = hash((model, pattern))
    if key not in _CODECS:
        _CODECS[key] = PieceCodec(model, pattern)
    return _CODECS[key]


def encode_pieces(
    docs: DataFrame, ranks: str, pattern: str, with_ids: bool = True, decoded: bool = False
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded.

    One row per row of ``docs``; a null text counts as empty and has no ids. ``ranks`` is the
    path of a rank file on the driver and ``pattern`` what splits a text before merging; text
    that it does not match is left out, as by the rank file's own library. Digests are over
    the ids as little-endian unsigned 32-bit integers, and over the bytes decoded from them.
    Repeated rows and ids are each encoded; other columns are ignored.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(piece_model(read_ranks(ranks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        try:
            for batch in batches:
                for part in slices(batch, "text", 1 << 20):
                    counts, digests, back, all_ids, texts = [], [], [], [], []
                    for data in codec.encode(part.column("text").to_pylist()):
                        ids = np.frombuffer(data, "<u4")
                        text = codec.decode(ids.tolist())
                        counts.append(len(ids))
                        digests.append(hashlib.sha256(data).hexdigest())
                        back.append(hashlib.sha256(text).hexdigest())
                        if with_ids:
                            all_ids.append(ids.astype(np.int32))
                        if decoded:
                            texts.append(text)
                    columns = {
                        "doc_id": part.column("doc_id"),
                        "n_tokens": pa.array(counts, pa.int64()),
                        "ids_sha256": pa.array(digests, pa.string()),
                        "decoded_sha256": pa.array(back, pa.string()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array(all_ids, pa.list_(pa.int32()))
                    if decoded:
                        columns["decoded"] = pa.array(texts, pa.binary())
                    yield pa.RecordBatch.from_pydict(columns)
        finally:
            give_back(codec.encode.known)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids + ", decoded binary" * decoded
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, schema)
