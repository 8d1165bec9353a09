"""Exact deduplication by recipes of content-defined chunks.

A text is cut where the high bits of a rolling hash of its last 32 bytes are set. Equal
stretches of different documents so become equal chunks. A chunk's identifier is its 64-bit
hash, made certain by comparing contents: each distinct (hash, content) is moved once, and
where one hash has several contents, an ordinal tells them apart. A document is then its
ordered list of identifiers, and equal lists mean equal texts. Long texts are never moved:
the lists stand for them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctmart.llm.common import drop_table, keep_rows, slices, write_table
from acctmart.operators.joins import splittable_join

SMALLEST, LARGEST, MASK = 512, 8192, 2047
_GEAR = np.random.default_rng(4).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_points(data: bytes) -> np.ndarray:
    """Every place, counted from the start, at which the rolling hash asks for a cut."""
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):
        h[step:] += h[:-step] << np.uint32(step)
    return np.flatnonzero((h >> np.uint32(21)) == MASK) + 1


def chunk_ends(places: list[int], length: int) -> list[int]:
    """Ends of a text's chunks: cuts between the smallest and the largest size."""
    ends, start = [], 0
    for place in places:
        while place - start > LARGEST:
            start += LARGEST
            ends.append(start)
        if place - start >= SMALLEST:
            ends.append(place)
            start = place
    while length - start > LARGEST:
        start += LARGEST
        ends.append(start)
    if start < length:
        ends.append(length)
    return ends


def chunks_of(texts: list[str | None]) -> Iterator[tuple[bytes, list[bytes]]]:
    """Each text's bytes and chunks. The cuts of all texts are searched at once."""
    encoded = [(t or "").encode() for t in texts]
    places = cut_points(b"".join(encoded))
    base = 0
    for data in encoded:
        lo, hi = np.searchsorted(places, [base, base + len(data)], "right")
        ends = chunk_ends((places[lo:hi] - base).tolist(), len(data))
        yield data, [data[a:b] for a, b in zip([0, *ends], ends)]
        base += len(data)


def chunk_hash(chunk: bytes) -> int:
    return xxhash.xxh3_64_intdigest(chunk) - (1 << 63)


def _distinct_chunks(hash_of: Callable[[bytes], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                seen = list({c for _, cs in chunks_of(texts) for c in cs})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hash_of(c) for c in seen], pa.int64()), pa.array(seen, pa.binary())],
                    ["hash", "chunk"],
                )

    return run


def _recipes(hash_of: Callable[[bytes], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = list(chunks_of(part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("row"),
                        pa.array([hashlib.sha256(d).hexdigest() for d, _ in found]),
                        pa.array([[hash_of(c) for c in cs] for _, cs in found], pa.list_(pa.int64())),
                        pa.array([[0] * len(cs) for _, cs in found], pa.list_(pa.int32())),
                    ],
                    ["doc_id", "row", "text_sha256", "recipe", "ordinals"],
                )

    return run


def _chunk_places(hash_of: Callable[[bytes], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                rows = [
                    (sha, at, hash_of(c), c)
                    for sha, (_, cs) in zip(
                        part.column("text_sha256").to_pylist(),
                        chunks_of(part.column("text").to_pylist()),
                    )
                    for at, c in enumerate(cs)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.string()),
                        pa.array([r[1] for r in rows], pa.int32()),
                        pa.array([r[2] for r in rows], pa.int64()),
                        pa.array([r[3] for r in rows], pa.binary()),
                    ],
                    ["text_sha256", "at", "hash", "chunk"],
                )

    return run


_RECIPE = "doc_id long, row long, text_sha256 string, recipe array<long>, ordinals array<int>"


def recipes(docs: DataFrame, hash_of: Callable[[bytes], int] = chunk_hash) -> DataFrame:
    """doc_id, row, text_sha256, recipe, ordinals: one row per document.

    ``recipe`` lists the chunk hashes, and ``ordinals`` tells apart different chunks of the
    same hash. A null or empty text has an empty recipe.
    """
    texts = docs.select("text")
    chunks = texts.mapInArrow(_distinct_chunks(hash_of), "hash long, chunk binary").distinct()
    ambiguous, path = write_table(
        chunks.groupBy("hash").count().where("count > 1").select("hash"), "ambiguous"
    )
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    plain, _ = write_table(rows.mapInArrow(_recipes(hash_of), _RECIPE), "recipes")
    if ambiguous.isEmpty():
        drop_table(docs.sparkSession, path)
        return plain
    # Number the contents of each ambiguous hash, and put the numbers into the recipes.
    contents = splittable_join(chunks, ambiguous, ["hash"], "left_semi").withColumn(
        "ordinal", F.row_number().over(Window.partitionBy("hash").orderBy("chunk"))
    )
    affected = splittable_join(
        plain.select("text_sha256", F.explode(F.array_distinct("recipe")).alias("hash")),
        ambiguous,
        ["hash"],
        "left_semi",
    ).select("text_sha256").distinct()
    one_each = docs.select("text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    places = splittable_join(one_each, affected, ["text_sha256"], "left_semi").mapInArrow(
        _chunk_places(hash_of), "text_sha256 string, at int, hash long, chunk binary"
    )
    numbered = (
        splittable_join(places, contents, ["hash", "chunk"], "left")
        .select("text_sha256", "at", F.coalesce("ordinal", F.lit(0)).alias("ordinal"))
        .distinct()
        .groupBy("text_sha256")
        .agg(F.array_sort(F.collect_list(F.struct("at", "ordinal"))).alias("found"))
        .select("text_sha256", F.col("found.ordinal").alias("found"))
    )
    return splittable_join(plain, numbered, ["text_sha256"], "left").select(
        "doc_id", "row", "text_sha256", "recipe", F.coalesce("found", "ordinals").alias("ordinals")
    )


def exact_groups(docs: DataFrame, hash_of: Callable[[bytes], int] = chunk_hash) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``.

    Rows whose texts are identical form a group; null counts as the empty text. The row with
    the largest doc_id stays, a null id being smallest. Of rows that agree in id and text
    exactly one is marked as kept. An empty table gives no rows; further columns are ignored.
    """
    rows = recipes(docs, hash_of)
    groups = rows.groupBy("recipe", "ordinals").agg(
        F.max(F.struct("doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    return splittable_join(rows, groups, ["recipe", "ordinals"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns.

    Rows are found again by id and text digest. Of rows that agree in both, one stays.
    """
    kept = exact_groups(docs).where("kept").select("doc_id", F.col("text_sha256").alias("key"))
    return keep_rows(docs, kept, F.sha2(F.coalesce("text", F.lit("")), 256))
