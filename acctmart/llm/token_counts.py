"""Token counts by two lookups in the map task: frequent pre-tokens, then a worker's cache.

A sentencepiece BPE model whose pieces hold the space mark only at their start, and whose
normaliser changes nothing but spaces, never merges over the start of a run of spaces. A
text's count then is the sum of the counts of its pre-tokens, each a run of spaces and what
follows it. The counts of the most frequent pre-tokens are broadcast as one hash table of a
fixed number of entries. Others are encoded once and kept in a bounded cache of the worker.
No pre-token is ever shuffled: the frequent ones are found by bounded summaries, one of each
task and over the whole corpus, which are merged a few at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctmart.llm.common import slices, write_table

#: Entries of the broadcast table, and of each summary.
FREQUENT = 1 << 17
#: Pre-tokens a worker keeps at most; its cache starts anew beyond it.
CACHED = 400_000
#: Longer pre-tokens, in characters, are in neither.
LONGEST = 48
#: Summaries that are merged at a time.
FAN_IN = 8
LIMIT = 4096

MARK = "▁"
_PRETOKEN = re.compile(" +[^ ]*")
_SUMMARY = "part long, keys array<string>, counts array<long>, total long"


def _message(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """The fields of a protocol buffer message: numbers and values."""

    def varint(i: int) -> tuple[int, int]:
        n = shift = 0
        while True:
            n |= (data[i] & 127) << shift
            i, shift = i + 1, shift + 7
            if data[i - 1] < 128:
                return n, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        if key & 7 == 0:
            value, i = varint(i)
        else:
            size, i = {1: (8, i), 5: (4, i)}[key & 7] if key & 7 != 2 else varint(i)
            value, i = data[i : i + size], i + size
        yield key >> 3, value


def counts_add_up(model: bytes) -> bool:
    """Whether a text's count is the sum of its pre-tokens' counts under this model.

    That is so for BPE with an identity normaliser that adds a space before the text, marks
    spaces and removes none, if no piece has the mark after another character.
    """
    fields = list(_message(model))
    trainer = dict(f for k, v in fields if k == 2 for f in _message(v))
    rules = dict(f for k, v in fields if k == 3 for f in _message(v))
    pieces = (dict(_message(v)).get(1, b"").decode() for k, v in fields if k == 1)
    plain = not rules.get(2) and not rules.get(6) and rules.get(3, 1) and not rules.get(4, 1) and rules.get(5, 1)
    prefix = not trainer.get(24, 0)  # the mark stands before a word, not after it
    return bool(trainer.get(3) == 2 and plain and prefix and not any(MARK in p.lstrip(MARK) for p in pieces))


def pretokens(text: str) -> list[str]:
    """A text's pre-tokens, each without its first space; the text itself is preceded by one."""
    if MARK in text:
        text = text.replace(MARK, " ")
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [w[1:] for w in _PRETOKEN.findall(" " + text)]
    return text.split(" ")


def _reduced(counts: dict[str, int], size: int) -> dict[str, int]:
    """At most ``size`` entries, all lessened by the largest count left out.

    A pre-token that makes up more than one in ``size`` of all is never lost so.
    """
    if len(counts) <= size:
        return counts
    ranked = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    least = ranked[size][1]
    return {k: n - least for k, n in ranked[:size] if n > least}


def _row(part: int, counts: dict[str, int], total: int) -> pa.RecordBatch:
    strings, longs = pa.list_(pa.string()), pa.list_(pa.int64())
    columns = [pa.array([part]), pa.array([list(counts)], strings), pa.array([list(counts.values())], longs)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([total])], ["part", "keys", "counts", "total"])


def _summarize(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        total = 0
        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    counts.update(pretokens(text))
                    if len(counts) > 4 * size:
                        counts = _merged(counts, size)
                total += part.num_rows
        yield _row(TaskContext.get().partitionId(), _merged(counts, size), total)

    def _merged(counts: Counter, size: int) -> Counter:
        return Counter(_reduced({k: n for k, n in counts.items() if len(k) <= LONGEST}, size))

    return run


def _merge(size: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        counts: Counter[str] = Counter()
        for keys, numbers in zip(table.column("keys"), table.column("counts")):
            counts.update(dict(zip(keys.as_py(), numbers.as_py())))
            if len(counts) > 4 * size:
                counts = Counter(_reduced(counts, size))
        total = pc.sum(table.column("total")).as_py()
        return pa.Table.from_batches([_row(key[0].as_py(), _reduced(counts, size), total)])

    return run


def frequent_pretokens(docs: DataFrame, size: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens of all texts, ``size`` at most.

    Every task summarizes what it reads in ``size`` entries; summaries are merged FAN_IN at
    a time, in as many rounds as it takes to have one.
    """
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    found, _ = write_table(texts.mapInArrow(_summarize(size), _SUMMARY), "summaries")
    while found.count() > 1:
        group = F.floor(F.col("part") / FAN_IN)
        merged = found.groupBy(group.alias("group")).applyInArrow(_merge(size), _SUMMARY)
        found, _ = write_table(merged, "summaries")
    last = found.select("keys").first()
    return sorted(last["keys"]) if last else []


class PretokenCounter:
    """Counts tokens by a table of frequent pre-tokens and a cache of others."""

    def __init__(self, model: bytes, frequent: dict[str, int], cached: int = CACHED) -> None:
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.frequent, self.cached = frequent, cached
        self.known: dict[str, int] = {}
        # A last single space is a pre-token that the library takes only after another one.
        self.space = len(self.processor.encode("a ")) - len(self.processor.encode("a"))

    def lengths(self, keys: list[str]) -> list[int]:
        """The number of tokens of each pre-token."""
        return [len(ids) if k else self.space for k, ids in zip(keys, self.processor.encode(keys, num_threads=1))]

    def __call__(self, texts: list[str]) -> list[int]:
        """The number of tokens of every text."""
        if len(self.known) > self.cached:
            self.known.clear()
        get, also = self.frequent.get, self.known.get
        totals, left, missing = [], [], {}
        for i, text in enumerate(texts):
            keys = pretokens(text)
            found = list(map(get, keys))
            if None not in found:
                totals.append(sum(found))
                continue
            rare = [k for k, n in zip(keys, found) if n is None]
            found_rare = list(map(also, rare))
            totals.append(sum(filter(None, found)) + sum(filter(None, found_rare)))
            new = [k for k, n in zip(rare, found_rare) if n is None]
            if new:
                left.append((i, new))
                missing.update(dict.fromkeys(new))
        if missing:
            missing = dict(zip(missing, self.lengths(list(missing))))
            for i, new in left:
                totals[i] += sum(map(missing.__getitem__, new))
            self.known.update((k, n) for k, n in missing.items() if len(k) <= LONGEST)
        return totals


_COUNTERS: dict[int, Callable[[list[str]], list[int]]] = {}


def _counter(model: bytes, frequent: dict[str, int] | None, key: int) -> Callable[[list[str]], list[int]]:
    """The worker's counter for a broadcast; the last one's cache goes with it."""
    if key not in _COUNTERS:
        _COUNTERS.clear()
        if frequent is None:
            processor = sentencepiece.SentencePieceProcessor(model_proto=model)
            _COUNTERS[key] = lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)]
        else:
            _COUNTERS[key] = PretokenCounter(model, frequent)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, model_path: str, limit: int = LIMIT, size: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs``.

    ``model_path`` is a sentencepiece model on the driver. Whole texts are counted as by its
    library, without begin and end. A null text counts as empty, which has no tokens; repeated
    rows are each counted; other columns are ignored; an empty table gives no rows. Under a
    model for which ``counts_add_up`` does not hold, texts are encoded as a whole.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as file:
        model = file.read()
    frequent = None
    if counts_add_up(model):
        keys = frequent_pretokens(docs, size)
        frequent = dict(zip(keys, PretokenCounter(model, {}).lengths(keys)))
    shared = spark.sparkContext.broadcast((model, frequent))
    token = shared._jbroadcast.id()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(*shared.value, token)
        for batch in batches:
            for part in slices(batch, "text"):
                n = pa.array(count(part.column("text").to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pc.binary_length(part.column("text")).cast(pa.int64()),
                        n,
                        pc.greater(n, limit),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
