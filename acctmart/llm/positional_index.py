"""A positional inverted index of a corpus, searched for phrases and for close terms.

The index is a Parquet folder of shards. A shard holds the postings of some documents: for
each term the places of its words, counted through the shard with one place left free after
each document, so that no run of places crosses documents. Shards are searched where they
lie: nothing is shuffled, and a lost executor costs its own shards' work only.

A phrase is found by its rarest term first: the term's places, less the term's offset in the
phrase, are candidate starts, and are intersected with the offset-adjusted places of the
other terms, from rare to frequent. Proximity matches take the shortest span of all terms
around each place of a document's rarest term.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctmart.llm.common import free_name, slices, text_key

#: Words and documents of a shard, about; a longer document has a shard of its own.
SHARD_WORDS = 500_000
#: Bytes of benchmark that are broadcast at most, and that a task searches for at a time beyond it.
BLOCK_BYTES = 8 << 20
#: Bytes that an item counts besides its text.
ITEM_BYTES = 64
#: Shards, about, that a task searches for one block of a benchmark beyond BLOCK_BYTES.
LANE_SHARDS = 8

#: A-Z in lower case; all other bytes up to 0x7F that are no digit or letter, as blanks.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text: runs of digits, letters and non-ASCII characters, A-Z lowered."""
    return (text or "").encode().translate(_FOLD).split()


class Numbering(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


_SHARD = (
    "shard long, doc_ids array<long>, text_keys array<long>, n_words array<long>, "
    "terms binary, n_places binary, places binary"
)


def _cut(batches: Iterator[pa.RecordBatch], shard_words: int) -> Iterator[pa.RecordBatch]:
    first, made = TaskContext.get().partitionId() << 33, 0
    ids: list[int | None] = []
    keys: list[int] = []
    counts: list[int] = []
    words: list[bytes] = []

    def flush() -> pa.RecordBatch:
        numbers = Numbering()
        terms = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
        gaps = np.repeat(np.arange(len(counts)), counts)
        order = np.argsort(terms, kind="stable")
        places = np.diff((np.arange(len(words)) + gaps)[order], prepend=0).astype("<i4")
        lengths = np.bincount(terms, minlength=len(numbers)).astype("<i4")
        return pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([first + made], pa.int64()),
                "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "text_keys": pa.array([keys], pa.list_(pa.int64())),
                "n_words": pa.array([counts], pa.list_(pa.int64())),
                "terms": pa.array([b" ".join(numbers)], pa.binary()),
                "n_places": pa.array([lengths.tobytes()], pa.binary()),
                "places": pa.array([places.tobytes()], pa.binary()),
            }
        )

    for batch in batches:
        for part in slices(batch, "text"):
            columns = (part.column(c).to_pylist() for c in ("doc_id", "text_key", "text"))
            for doc_id, key, text in zip(*columns):
                found = words_of(text)
                if ids and len(words) + len(ids) + len(found) > shard_words:
                    yield flush()
                    made += 1
                    ids, keys, counts, words = [], [], [], []
                ids.append(doc_id)
                keys.append(key)
                counts.append(len(found))
                words += found
    if ids:
        yield flush()


def write_index(docs: DataFrame, path: str) -> None:
    """Store the postings of every word of every document. A null text has no words.

    Rows with the same id, and repeated rows, stay separate documents; other columns are
    ignored.
    """
    rows = docs.select("doc_id", text_key().alias("text_key"), "text")
    shard_words = SHARD_WORDS
    rows.mapInArrow(lambda batches: _cut(batches, shard_words), _SHARD).write.option("compression", "zstd").parquet(path)


class Shard:
    """The postings of one shard, read as needed."""

    def __init__(self, terms: bytes, n_places: bytes, places: bytes, n_words: Sequence[int]) -> None:
        self.number = {t: i for i, t in enumerate(terms.split(b" "))} if terms else {}
        self.ends = np.cumsum(np.frombuffer(n_places, "<i4"))
        self.all = np.cumsum(np.frombuffer(places, "<i4"), dtype=np.int64)
        self.n_words = np.asarray(n_words, np.int64)
        #: First place of each document, and the places in all.
        self.first = np.cumsum(self.n_words + 1) - self.n_words - 1
        self.size = int((self.n_words + 1).sum())

    def places(self, term: bytes) -> np.ndarray:
        i = self.number.get(term)
        if i is None:
            return self.all[:0]
        return self.all[self.ends[i - 1] if i else 0 : self.ends[i]]

    def documents(self, places: np.ndarray) -> np.ndarray:
        """The document, counted in the shard, of each place."""
        return np.searchsorted(self.first, places, "right") - 1


def phrase_starts(lists: Sequence[np.ndarray]) -> np.ndarray:
    """Places at which terms stand one after the other, given each one's sorted places."""
    order = sorted(range(len(lists)), key=lambda i: len(lists[i]))
    starts = lists[order[0]] - order[0]
    for i in order[1:]:
        if not len(starts):
            break
        other = lists[i]
        at = np.searchsorted(other, starts + i)
        at[at == len(other)] = 0
        starts = starts[other[at] == starts + i]
    return starts


def near_spans(shard: Shard, lists: Sequence[np.ndarray], slop: int) -> list[tuple[int, int]]:
    """(first, last) of the places around each document's rarest term where all terms stand.

    Of each place of that term, the shortest span that holds it and all other terms in the
    same document, if its ends are less than ``slop`` apart; the earliest of equal ones. Order
    is free. ``lists`` are the places of different terms; of equally rare ones the first counts.
    """
    if slop < 1 or not lists or not all(len(x) for x in lists):
        return []
    slop = min(slop, shard.size)
    docs = [shard.documents(x) for x in lists]
    counts = np.stack([np.bincount(d, minlength=len(shard.first)) for d in docs])
    rarest = np.where(counts.min(axis=0) > 0, counts.argmin(axis=0), -1)
    anchors = np.sort(np.concatenate([x[rarest[d] == i] for i, (x, d) in enumerate(zip(lists, docs))]))
    if not len(anchors):
        return []
    places = np.unique(np.concatenate([x[rarest[d] >= 0] for x, d in zip(lists, docs)]))
    n = len(places)
    # The least end of a span from each place that holds all terms: it never decreases.
    last = places.copy()
    for x in lists:
        last = np.maximum(last, np.append(x, shard.size)[np.searchsorted(x, places)])
    whole = (last < shard.size) & (shard.documents(last) == shard.documents(places))
    widths = np.where(whole, np.minimum(last - places, slop), slop)

    starts = np.maximum(shard.first[shard.documents(anchors)], anchors - slop + 1)
    low, here = np.searchsorted(places, starts), np.searchsorted(places, anchors)
    # Spans from places before ``done`` end at the anchor, the later the shorter; of the
    # others up to the anchor the least is taken, from least values of 1, 2, 4 ... places.
    done = np.searchsorted(last, anchors, "right")
    before = np.maximum(done - 1, 0)
    width_before = np.where(done > low, anchors - places[before], slop)
    begin = np.maximum(low, done)
    length = here - begin + 1
    least = np.full(len(anchors), slop * n)
    level, step = widths * n + np.arange(n), 1
    while True:
        now = (length >= step) & (length < 2 * step)
        least[now] = np.minimum(level[begin[now]], level[here[now] - step + 1])
        if 2 * step > length.max():
            break
        level, step = np.minimum(level[:-step], level[step:]), 2 * step
    width_after, after = np.divmod(least, n)
    first = places[np.where(width_before <= width_after, before, after)]
    width = np.minimum(width_before, width_after)
    fits = width < slop
    return list(zip(first[fits].tolist(), (first + width)[fits].tolist()))


def item_hits(shard: Shard, words: Sequence[bytes], window: int) -> tuple[np.ndarray, int]:
    """Starts of all occurrences of an item's windows, and the windows' length."""
    length = min(window, len(words))
    lists = [shard.places(w) for w in words]
    sizes = np.array([len(x) for x in lists])
    found = [
        phrase_starts(lists[a : a + length])
        for a in range(len(words) - length + 1)
        if length and sizes[a : a + length].all()
    ]
    return (np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)), length


Items = list[tuple[int, list[bytes]]]


_SPANS = (
    "doc_id long, text_key long, n_words long, firsts array<long>, lasts array<long>, items array<long>"
)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item_id, text of the items that can have words."""
    return benchmark.select("item_id", "text").where(F.length("text") > 0)


def benchmark_blocks(items: DataFrame) -> int:
    """How many blocks of BLOCK_BYTES the items take; 0 and 1 can be broadcast."""
    size = items.select(F.sum(F.octet_length("text") + ITEM_BYTES).alias("n")).first()["n"] or 0
    return -(-size // BLOCK_BYTES)


def benchmark_spans(path: str, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """``phrase_spans`` of a whole benchmark, whatever its size.

    One of up to BLOCK_BYTES is broadcast. A larger one never passes through the driver: its
    items are dealt by hash to blocks of about that size, the shards to lanes of about
    LANE_SHARDS, and blocks and lanes meet by key, one pair in a task at a time. The shuffle
    then is the index once for every block, and every block once for each lane. A document's
    spans of several blocks are put together by its place in the index, so that rows which
    agree in everything stay apart.
    """
    spark = benchmark.sparkSession
    items = benchmark_items(benchmark)
    n_blocks = benchmark_blocks(items)
    if n_blocks <= 1:
        return phrase_spans(spark, path, [(r["item_id"], words_of(r["text"])) for r in items.collect()], window)
    stored = spark.read.schema(_SHARD).parquet(path)
    lanes = -(-stored.count() // LANE_SHARDS)

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(max(1, n) - 1)))

    lane = F.pmod(F.xxhash64("shard"), F.lit(max(1, lanes))).cast("int")
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)).cast("int")
    shards = stored.withColumn("lane", lane).withColumn("block", every(n_blocks))
    dealt = items.distinct().withColumn("block", block).withColumn("lane", every(lanes))

    def search(key: tuple, shards: pa.Table, some: pa.Table) -> pa.Table:
        columns = (some.column(c).to_pylist() for c in ("item_id", "text"))
        wanted = [(item_id, words_of(text)) for item_id, text in zip(*columns)]
        rows = (shards.slice(i, 1).to_pylist()[0] for i in range(len(shards)))
        found = [_of_block(row, wanted, window, key[0].as_py()) for row in rows]
        return pa.Table.from_batches(found, _arrow_of_block())

    both = shards.groupBy("block", "lane").cogroup(dealt.groupBy("block", "lane"))
    found = both.applyInArrow(search, f"shard long, at long, {_SPANS}")
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("firsts", "lasts", "items")]  # a row of each block
    return found.groupBy("shard", "at", "doc_id", "text_key", "n_words").agg(*lists).drop("shard", "at")


def _arrow_of_block() -> pa.Schema:
    fields = (f.split() for f in f"shard long, at long, {_SPANS}".split(", "))
    return pa.schema([(k, pa.int64() if t == "long" else pa.list_(pa.int64())) for k, t in fields])


def _of_block(row: dict, items: Items, window: int, block: int) -> pa.RecordBatch:
    """The spans of a shard's documents, those without any from the first block only."""
    found = _search(row, items, window)
    at = np.arange(found.num_rows)
    numbers = [pa.array(np.full(found.num_rows, row["shard"])), pa.array(at)]
    found = pa.RecordBatch.from_arrays([*numbers, *found.columns], schema=_arrow_of_block())
    hit = pc.greater(pc.list_value_length(found.column("firsts")), 0)
    return found if block == 0 else found.filter(hit)


def phrase_spans(spark: SparkSession, path: str, items: Items, window: int = 13) -> DataFrame:
    """doc_id, text_key, n_words, firsts, lasts, items: one row per indexed document.

    ``firsts`` and ``lasts`` bound, in words from 0, the stretches of the document that
    occurrences of windows cover, joined where they touch; ``items`` are the ids whose
    windows occur. The items asked for are broadcast; ``benchmark_spans`` takes a table of
    any size.
    """
    shared = spark.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _search(row, shared.value, window)

    return spark.read.schema(_SHARD).parquet(path).mapInArrow(run, _SPANS)


def _search(row: dict, items: Items, window: int) -> pa.RecordBatch:
    shard = Shard(row["terms"], row["n_places"], row["places"], row["n_words"])
    change = np.zeros(shard.size + 1, np.int32)
    of_doc: dict[int, set] = {}
    for item_id, words in items:
        starts, length = item_hits(shard, words, window)
        if len(starts):
            np.add.at(change, starts, 1)
            np.add.at(change, starts + length, -1)
            for doc in np.unique(shard.documents(starts)).tolist():
                of_doc.setdefault(doc, set()).add(item_id)
    hit = np.concatenate([[0], np.cumsum(change) > 0]).astype(np.int8)
    edges = np.diff(hit)
    firsts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    spans: dict[int, tuple[list, list]] = {}
    for doc, a, b in zip(shard.documents(firsts).tolist(), firsts.tolist(), ends.tolist()):
        base = int(shard.first[doc])
        spans.setdefault(doc, ([], []))[0].append(a - base)
        spans[doc][1].append(b - base - 1)
    docs = range(len(row["doc_ids"]))
    longs = pa.list_(pa.int64())
    nothing: tuple[list, list] = ([], [])
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(row["doc_ids"], pa.int64()),
            "text_key": pa.array(row["text_keys"], pa.int64()),
            "n_words": pa.array(row["n_words"], pa.int64()),
            "firsts": pa.array([spans.get(d, nothing)[0] for d in docs], longs),
            "lasts": pa.array([spans.get(d, nothing)[1] for d in docs], longs),
            "items": pa.array([list(of_doc.get(d, ())) for d in docs], longs),
        }
    )


def near_matches(spark: SparkSession, path: str, items: Items, slop: int) -> DataFrame:
    """doc_id, item_id, first, last: places where all words of an item stand within ``slop``.

    One row per place of the word that is rarest in the document, as ``near_spans`` has it.
    """
    shared = spark.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["terms"], row["n_places"], row["places"], row["n_words"])
                found = []
                for item_id, words in shared.value:
                    lists = [shard.places(w) for w in dict.fromkeys(words)]
                    for a, b in near_spans(shard, lists, slop):
                        doc = int(shard.documents(np.array([a]))[0])
                        base = int(shard.first[doc])
                        found.append((row["doc_ids"][doc], item_id, a - base, b - base))
                columns = list(zip(*found)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "first", "last"]
                )

    return spark.read.schema(_SHARD).parquet(path).mapInArrow(
        run, "doc_id long, item_id long, first long, last long"
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, path: str, window: int = 13, share: int = 20
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_key per document.

    A word is hit inside any occurrence of a window of an item: ``window`` consecutive words,
    or a shorter item as a whole. A document with a hit is contaminated if at least one in
    ``share`` of its words is hit. Null texts and items have no words; items without words
    are never found; items of the same id count once, and those of a null id only hit words.
    The index is written to ``path``. A benchmark over ``BLOCK_BYTES`` is searched in blocks,
    as ``benchmark_spans`` has it, with the same result.
    """
    write_index(docs, path)
    spans = benchmark_spans(path, benchmark, window)
    return spans.mapInArrow(
        _summaries(share),
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
        "contaminated boolean, text_key long",
    )


def _summaries(share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, counts, digests = [], [], []
            for firsts, lasts, items in zip(
                *(batch.column(c).to_pylist() for c in ("firsts", "lasts", "items"))
            ):
                covered, end = 0, -1
                for a, b in sorted(zip(firsts, lasts)):
                    covered += max(0, b - max(a - 1, end))
                    end = max(end, b)
                names = sorted({str(i) for i in items if i is not None})
                hits.append(covered)
                counts.append(len(names))
                digests.append(hashlib.sha256(",".join(names).encode()).hexdigest())
            n_words = batch.column("n_words").to_pylist()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_words": batch.column("n_words"),
                    "n_hit": pa.array(hits, pa.int64()),
                    "n_items": pa.array(counts, pa.int64()),
                    "items_sha256": pa.array(digests, pa.string()),
                    "contaminated": pa.array([h > 0 and share * h >= n for h, n in zip(hits, n_words)]),
                    "text_key": batch.column("text_key"),
                }
            )

    return run


def without_contaminated(docs: DataFrame, benchmark: DataFrame, path: str) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    found = contamination(docs, benchmark, path).where("contaminated")
    bad_id, bad_key, key = (free_name(docs, n) for n in ("_bad_id", "_bad_key", "_key"))
    bad = found.select(F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_key)).distinct()
    keyed = docs.withColumn(key, text_key())
    same = F.col(key).eqNullSafe(F.col(bad_key)) & F.col("doc_id").eqNullSafe(F.col(bad_id))
    return keyed.join(bad, same, "left_anti").select(*docs.columns)
