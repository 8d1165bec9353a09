"""Token ids in files whose short documents can be read one at a time.

The files are a Parquet folder of blocks. A block holds some documents in ascending doc_id
order: each document's ids are one zstandard frame of their own, compressed with a dictionary
that all blocks share, and the block has the frames' end offsets as its index. A document is
read by finding its block by id (row groups are skipped by their statistics), its place in
the index, and decompressing one frame. Each block names the dictionary by its SHA-256; the
dictionary lies in a folder beside the blocks and is checked against it.

Spark's committed Parquet writer is used, so a lost executor leaves no broken files, and the
files can be in any store that Spark writes to.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from acctmart.llm.chunk_cache import StretchEncoder
from acctmart.llm.common import slices

#: Ids are stored in two bytes; the vocabularies in use are below 65,536.
STORED = np.dtype("<u2")
DICTIONARY_BYTES = 64 << 10
#: Documents, and characters of each, that the dictionary is trained on at most.
TRAIN_DOCUMENTS, TRAIN_LONGEST = 1000, 20_000
BLOCK_BYTES = 1 << 20
#: Encoded stretches a worker keeps at most.
CACHED = 1_000_000

_BLOCK = (
    "part int, block int, first_doc long, last_doc long, part_start long, block_tokens long, "
    "dictionary string, doc_ids array<long>, n_tokens array<long>, ends array<long>, frames binary"
)
_ENCODERS: dict[tuple[int, bool], StretchEncoder] = {}


def _space_starts(tokenizer: Tokenizer) -> np.ndarray:
    """Which ids stand for a token that begins with a space, in a byte-level vocabulary."""
    starts = np.zeros(tokenizer.get_vocab_size(), bool)
    starts[[i for token, i in tokenizer.get_vocab().items() if token.startswith("Ġ")]] = True
    return starts


def _encoder(definition: str, special_as_text: bool) -> StretchEncoder:
    """The task's encoder of a tokenizer definition; kept by the worker process."""
    key = hash(definition), special_as_text
    if key not in _ENCODERS:
        tokenizer = Tokenizer.from_str(definition)
        tokenizer.encode_special_tokens = special_as_text
        if tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids over two bytes")

        def encode(texts: list[str]) -> list[bytes]:
            found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(e.ids, STORED).tobytes() for e in found]

        space = _space_starts(tokenizer)

        def encode_joined(stretches: list[str]) -> list[bytes]:
            out = []
            for a in range(0, len(stretches), 8000):
                some = stretches[a : a + 8000]
                text = "".join(some)
                ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, STORED)
                # Each stretch's only space begins its first token.
                cuts = np.flatnonzero(space[ids])
                if len(cuts) != len(some) or cuts[0]:
                    out += encode(some)
                    continue
                cuts, data = (cuts * STORED.itemsize).tolist(), ids.tobytes()
                out += [data[x:y] for x, y in zip(cuts, [*cuts[1:], len(data)])]
            return out

        marks = tuple(token.content for token in tokenizer.get_added_tokens_decoder().values())
        # A mark with a space could also come about where stretches are joined.
        joined = None if any(" " in m for m in marks) else encode_joined
        _ENCODERS[key] = StretchEncoder(encode, joined, CACHED, marks)
    return _ENCODERS[key]


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary for ``samples``, empty if they are too few to train one."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _codec(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def sample_ids(docs: DataFrame, definition: str, special_as_text: bool) -> list[bytes]:
    """Serialized ids of a bounded sample of documents, chosen by a hash of their id."""
    total = max(1, docs.count())
    kept = docs.where(
        (F.pmod(F.xxhash64("doc_id"), F.lit(total)) < TRAIN_DOCUMENTS)
        & (F.length("text") <= TRAIN_LONGEST)
    )
    texts = [r["text"] for r in kept.select("text").limit(TRAIN_DOCUMENTS).collect()]
    return _encoder(definition, special_as_text)(texts)


def write_id_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, special_as_text: bool = True
) -> None:
    """Encode every whole text, with ``end_id`` after each, and write the files to ``path``.

    ``tokenizer`` is the path of a tokenizers definition on the driver. A null text counts as
    empty: it has the end id alone. Rows are ordered by doc_id, null first, and rows of the
    same doc_id by text; repeated rows are all written. Other columns are ignored. A special
    token's name in a text is text; without ``special_as_text`` it is that token's id, as the
    library has it unless told otherwise.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    dictionary = train_dictionary(sample_ids(docs, definition, special_as_text))
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, dictionary)], "hash string, dictionary binary").coalesce(
        1
    ).write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast((definition, dictionary))
    end = np.array([end_id], STORED).tobytes()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        definition, dictionary = shared.value
        encode = _encoder(definition, special_as_text)
        compress = zstandard.ZstdCompressor(level=3, **_codec(dictionary)).compress
        part, block, start = TaskContext.get().partitionId(), 0, 0
        ids, counts, ends, frames, size = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            row = {
                "part": part,
                "block": block,
                "first_doc": next((i for i in ids if i is not None), None),
                "last_doc": ids[-1],
                "part_start": start,
                "block_tokens": sum(counts),
                "dictionary": digest,
                "doc_ids": ids,
                "n_tokens": counts,
                "ends": ends,
                "frames": b"".join(frames),
            }
            return pa.RecordBatch.from_pylist([row], _block_schema())

        for batch in batches:
            for piece in slices(batch, "text"):
                encoded = encode(piece.column("text").to_pylist())
                for doc_id, data in zip(piece.column("doc_id").to_pylist(), encoded):
                    frames.append(compress(data + end))
                    size += len(frames[-1])
                    ids.append(doc_id)
                    counts.append(len(data) // STORED.itemsize + 1)
                    ends.append(size)
                    if size >= BLOCK_BYTES:
                        yield flush()
                        start += sum(counts)
                        block += 1
                        ids, counts, ends, frames, size = [], [], [], [], 0
        if ids:
            yield flush()

    # A hash of the text spreads an id that very many rows share.
    (
        docs.repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
        .mapInArrow(blocks, _BLOCK)
        .write.parquet(f"{path}/blocks")
    )


def _block_schema() -> pa.Schema:
    longs = pa.list_(pa.int64())
    return pa.schema(
        [
            ("part", pa.int32()),
            ("block", pa.int32()),
            ("first_doc", pa.int64()),
            ("last_doc", pa.int64()),
            ("part_start", pa.int64()),
            ("block_tokens", pa.int64()),
            ("dictionary", pa.string()),
            ("doc_ids", longs),
            ("n_tokens", longs),
            ("ends", longs),
            ("frames", pa.binary()),
        ]
    )


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    """The shared dictionary, checked against the hash kept beside it."""
    row = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(row["dictionary"]).hexdigest() != row["hash"]:
        raise ValueError(f"{path}: the dictionary does not match its hash")
    return bytes(row["dictionary"])


def read_id_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, unless left out, ids, of every document.

    ``start`` counts the ids of all documents before it in the files' order; ``ids_crc32`` is
    over the ids as little-endian unsigned 32-bit integers.
    """
    dictionary = read_dictionary(spark, path)
    digest = hashlib.sha256(dictionary).hexdigest()
    stored = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    # One row per part of the files, each part being what one task wrote.
    parts = stored.groupBy("part").agg(F.sum("block_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    shared = spark.sparkContext.broadcast(dictionary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor(**_codec(shared.value))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary"] != digest:
                    raise ValueError(f"{path}: a block was written with another dictionary")
                counts = np.array(row["n_tokens"])
                starts = row["offset"] + row["part_start"] + np.cumsum(counts) - counts
                frames, found, sums = row["frames"], [], []
                for a, b in zip([0, *row["ends"]], row["ends"]):
                    ids = np.frombuffer(plain.decompress(frames[a:b]), STORED).astype("<u4")
                    sums.append(zlib.crc32(ids.tobytes()))
                    if with_ids:
                        found.append(ids.astype(np.int32))
                columns = {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(found, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    blocks = stored.join(parts, "part").select(
        "offset", "part_start", "dictionary", "doc_ids", "n_tokens", "ends", "frames"
    )
    return blocks.mapInArrow(read, schema + ", ids array<int>" * with_ids)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of the document(s) with this id: one frame is decompressed for each."""
    dictionary = read_dictionary(spark, path)
    plain = zstandard.ZstdDecompressor(**_codec(dictionary))
    stored = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    place = F.col("doc_ids")[F.col("at")] == doc_id
    frames = (
        stored.where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
        .withColumn("at", F.explode(F.sequence(F.lit(0), F.size("doc_ids") - 1)))
        .where(place)
        .withColumn("from", F.when(F.col("at") > 0, F.col("ends")[F.col("at") - 1]).otherwise(0))
        .select(
            F.substring(
                "frames",
                (F.col("from") + 1).cast("int"),
                (F.col("ends")[F.col("at")] - F.col("from")).cast("int"),
            ).alias("frame")
        )
    )
    return [
        np.frombuffer(plain.decompress(bytes(r["frame"])), STORED).tolist() for r in frames.collect()
    ]
