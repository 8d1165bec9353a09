"""Maximal periodic runs of words, by internal pattern matching.

A run of period p holds a dyadic block of words, about half as long as p, whose next copy
lies p words on. So every aligned block is looked up in the window of words after it: the
block's range of the suffix array has all its occurrences, and a wavelet tree over the suffix
array gives the first one in the window (range successor). Occurrences less than half a block
apart form an arithmetic progression, which stands for one periodic stretch; two stretches
give few periods that are worth a trial. Each candidate is extended both ways by comparing
dyadic ranks, which is exact, and what is long enough is a run.

Words of different documents get different symbols, so one suffix array serves many
documents and no occurrence lies in another one. All steps are done for all blocks at once.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctmart.llm.common import slices

MIN_LENGTH = 12
#: Bytes of text whose words share a suffix array; a longer text has one of its own.
AT_ONCE = 1 << 20


class DyadicIndex:
    """The suffix array of a sequence of symbols, and ranks of all its dyadic factors.

    ``levels[k][i]`` is where in the suffix array the factors equal to the 2^k symbols from
    i begin. Levels end where all factors differ.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        self.n = n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        rank = np.empty(n, np.int32)
        self.levels: list[np.ndarray] = []
        #: For each level, the suffix array's places whose factor occurs more than once.
        self.repeated: list[np.ndarray] = []
        at, key = np.arange(n), symbols[order]
        half = 1
        while True:
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if n else at
            sizes = np.diff(np.append(starts, len(at)))
            rank = rank.copy()
            rank[order[at]] = np.repeat(at[starts], sizes)
            at = at[np.repeat(sizes > 1, sizes)]
            if not len(at):
                break
            self.levels.append(rank)
            self.repeated.append(at)
            places = order[at]
            following = places + half
            later = np.where(following < n, rank[np.minimum(following, n - 1)], -1)
            key = rank[places].astype(np.int64) * (n + 1) + later + 1
            by = np.argsort(key, kind="stable")
            order[at], key = places[by], key[by]
            half *= 2
        self.order = order

    def common_after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i and from j agree."""
        i, j = i.copy(), j.copy()
        first, last = i.copy(), self.n - 1
        for k in reversed(range(len(self.levels))):
            rank = self.levels[k]
            same = (i <= last) & (j <= last) & (rank[np.minimum(i, last)] == rank[np.minimum(j, last)])
            step = same.astype(i.dtype) << k
            i += step
            j += step
        return i - first

    def common_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before i and before j agree."""
        i, j = i.copy(), j.copy()
        first = i.copy()
        for k in reversed(range(len(self.levels))):
            rank, a, b = self.levels[k], i - (1 << k), j - (1 << k)
            same = (a >= 0) & (b >= 0) & (rank[np.maximum(a, 0)] == rank[np.maximum(b, 0)])
            step = same.astype(i.dtype) << k
            i -= step
            j -= step
        return first - i


class WaveletTree:
    """Values in which the least value of a range from a bound on is found in one descent a bit."""

    def __init__(self, values: np.ndarray, largest: int) -> None:
        self.bits = max(1, int(largest).bit_length())
        self.ones, self.zeros = [], []
        for bit in reversed(range(self.bits)):
            one = (values >> bit) & 1
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(one, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(values) - int(ones[-1]))
            one = one.astype(bool)
            values = np.concatenate([values[~one], values[one]])

    def _below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of the values at lo to hi are below the bound."""
        count = np.zeros(len(lo), lo.dtype)
        for bit, ones, zeros in zip(reversed(range(self.bits)), self.ones, self.zeros):
            one, a, b = (bound >> bit) & 1 == 1, ones[lo], ones[hi]
            count += np.where(one, (hi - b) - (lo - a), 0)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return count

    def _ranked(self, lo: np.ndarray, hi: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The value of this rank among those at lo to hi."""
        value = np.zeros(len(lo), lo.dtype)
        for bit, ones, zeros in zip(reversed(range(self.bits)), self.ones, self.zeros):
            a, b = ones[lo], ones[hi]
            none = (hi - b) - (lo - a)
            one = place >= none
            place = np.where(one, place - none, place)
            value += one.astype(lo.dtype) << bit
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray, none: int) -> np.ndarray:
        """The least value of at least ``bound`` at lo to hi; ``none`` where there is none."""
        found = np.full(len(lo), none, lo.dtype)
        within = np.flatnonzero(bound >> self.bits == 0)
        place = self._below(lo[within], hi[within], bound[within])
        some = place < hi[within] - lo[within]
        within = within[some]
        found[within] = self._ranked(lo[within], hi[within], place[some])
        return found


def block_windows(min_length: int, n: int) -> list[tuple[int, int, int]]:
    """(level, least, largest period): blocks of 2^level symbols find the runs of these periods.

    The first max(min_length - p, p) symbols of a run of period p have their copy in it, and
    hold an aligned block of b symbols if they are 2b - 1 at least.
    """
    windows: dict[int, tuple[int, int]] = {}
    level_of = lambda p: (max(min_length - p, p) + 1).bit_length() - 2
    p = 1
    while p <= n // 2:
        level = level_of(p)
        # Beyond the minimum length, all periods of a level at once.
        last = p if p < min_length else min(n // 2, (1 << level + 2) - 2)
        low, high = windows.get(level, (p, p))
        windows[level] = (min(low, p), max(high, last))
        p = last + 1
    return [(k, *windows[k]) for k in sorted(windows)]


def _progression(start: np.ndarray, step: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All members of arithmetic progressions, and which progression each is of."""
    owner = np.repeat(np.arange(len(start)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return start[owner] + nth * step[owner], owner


def find_runs(symbols: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, length, period) of all maximal runs, by start and period.

    A run is a longest stretch in which symbols ``period`` apart are equal, the period being
    its smallest, of a length of at least ``min_length`` and twice the period.
    """
    index = DyadicIndex(symbols)
    n, none = index.n, 2 * index.n + 2
    windows = [w for w in block_windows(min_length, n) if w[0] < len(index.levels)]
    if not windows:
        return np.zeros((0, 3), np.int64)
    # The tree holds the suffixes whose shortest blocks occur more than once.
    held = index.repeated[windows[0][0]]
    tree = WaveletTree(index.order[held], n)
    starts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for level, least, largest in windows:
        size, rank = 1 << level, index.levels[level]
        places = index.repeated[level]
        group = rank[index.order[places]]
        s = index.order[places]
        aligned = s % size == 0
        # Groups of equal blocks are contiguous in the suffix array, and so in what is held.
        edges = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        widths = np.diff(np.append(edges, len(group)))
        lo = np.repeat(np.searchsorted(held, places[edges]), widths)[aligned]
        hi = lo + np.repeat(widths, widths)[aligned]
        s = s[aligned]
        cursor, limit = s + least, s + largest
        while len(s):
            o = tree.successor(lo, hi, cursor, none)
            ok = o <= limit
            s, lo, hi, limit, o = s[ok], lo[ok], hi[ok], limit[ok], o[ok]
            starts.append(s)
            periods.append(o - s)
            step = tree.successor(lo, hi, o + 1, none) - o
            cursor = o + 1
            many = np.flatnonzero(2 * step <= size)
            if len(many):
                b, at, d, end = s[many], o[many], step[many], limit[many]
                left, left_end = b - index.common_before(b, b + d), b + d + index.common_after(b, b + d)
                right, right_end = at - index.common_before(at, at + d), at + d + index.common_after(at, at + d)
                count = (right_end - size - at) // d + 1
                cursor[many] = at + count * d
                # The stretches' own period, and the shifts that align their starts or ends.
                for p in (d, right - left, right_end - left_end):
                    starts.append(b)
                    periods.append(p)
                # Of stretches that meet, any copy of the block may be at a period of its own.
                meet = np.flatnonzero((left != right) & (left_end >= right))
                inside = np.minimum(count, (end - at) // d + 1)[meet]
                members, owner = _progression(at[meet], d[meet], inside)
                starts.append(b[meet][owner])
                periods.append(members - b[meet][owner])
            s, lo, hi, limit, cursor = (x[cursor <= limit] for x in (s, lo, hi, limit, cursor))
    s, p = np.concatenate(starts), np.concatenate(periods)
    some = (p > 0) & (s + p < n)
    s, p = s[some], p[some]
    first = s - index.common_before(s, s + p)
    length = s + p + index.common_after(s, s + p) - first
    some = length >= np.maximum(min_length, 2 * p)
    found = np.stack([first[some], length[some], p[some]], axis=1).astype(np.int64)
    # Of several periods of one stretch the smallest counts.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    other = np.any(found[1:, :2] != found[:-1, :2], axis=1)
    found = found[np.append(True, other)] if len(found) else found
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in turn, and the number of words of each text."""
    lists = pc.ascii_split_whitespace(texts)
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    words = pc.list_flatten(lists)
    real = pc.greater(pc.binary_length(words), 0)  # white space at either end leaves an empty one
    ends = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return words.filter(real), np.diff(ends[np.concatenate([[0], np.cumsum(lengths)])])


def repeated_from(doc_ids: list[int | None], counts: np.ndarray) -> np.ndarray:
    """Which original word each word is, where every tenth document is made to repeat itself.

    With h the crc32 of the decimal id and g a tenth of it, a document of n words with h
    divisible by 10 continues from word g % n on with a period of 1 + (n - a) // (3 + g % 8).
    """
    source, base = np.arange(int(counts.sum())), 0
    for doc_id, n in zip(doc_ids, counts.tolist()):
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            period = 1 + (n - a) // (3 + g % 8)
            source[base + a : base + n] = base + a + np.arange(n - a) % period
        base += n
    return source


def runs_of_texts(
    texts: pa.Array, source: np.ndarray | None = None, min_length: int = MIN_LENGTH, words=None
) -> tuple[list[np.ndarray], list[str]]:
    """Each text's runs, and the text with all but the first period of every run left out.

    Starts count words of the text. ``source`` gives the original word that each word is;
    ``words`` is what ``word_lists`` gave for the texts, if known.
    """
    words, counts = words or word_lists(texts)
    total = len(words)
    source = np.arange(total) if source is None else source
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)[source].astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(counts)), counts)
    runs = find_runs(owner * (int(codes.max(initial=0)) + 1) + codes, min_length)
    # Words after a run's first period are covered by it.
    covered = np.zeros(total + 1, np.int64)
    np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
    np.add.at(covered, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
    offsets = np.searchsorted(kept, bounds).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), words.take(pa.array(source[kept])))
    cuts = np.searchsorted(runs[:, 0], bounds)
    each = []
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        each.append(runs[a:b] - [bounds[i], 0, 0] if b > a else runs[:0])
    return each, pc.binary_join(lists, " ").to_pylist()


_SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def _digests(with_texts: bool, min_length: int):
    def sha(data: str) -> str:
        return hashlib.sha256(data.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", AT_ONCE):
                doc_ids, texts = part.column("doc_id"), part.column("text")
                words = word_lists(texts)
                source = repeated_from(doc_ids.to_pylist(), words[1])
                each, collapsed = runs_of_texts(texts, source, min_length, words)
                best = []
                for runs in each:
                    # Ties of length: smallest start, then period, which is the runs' order.
                    first = runs[np.argmax(runs[:, 1])].tolist() if len(runs) else [None] * 3
                    best.append([*first, 1000 * first[1] // first[2] if len(runs) else None])
                lines = ["".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist()) for runs in each]
                columns = [doc_ids, pa.array([len(r) for r in each], pa.int64())]
                columns += [pa.array([b[i] for b in best], pa.int64()) for i in range(4)]
                columns += [pa.array(list(map(sha, x)), pa.string()) for x in (lines, collapsed)]
                if with_texts:
                    rows = [[dict(zip(("start", "length", "period"), r)) for r in runs.tolist()] for runs in each]
                    kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))
                    columns += [pa.array(rows, kind), pa.array(collapsed, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [c.split()[0] for c in _SCHEMA.split(", ")] + ["runs", "collapsed"] * with_texts
    return run


def periodic_runs(docs: DataFrame, with_texts: bool = False, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, n_runs, the longest run, and digests of all runs and of the collapsed text.

    One row per row of ``docs``, after the repetition that ``repeated_from`` lays down; null and
    empty texts, as texts of white space, have no words and no runs, and a null id lays down no
    repetition. ``with_texts`` adds all ``runs`` and the ``collapsed`` text. Each row stands
    for itself, so repeated rows have equal results and no row is moved; other columns are
    ignored, and an empty table gives no rows. A text takes about 100 bytes a word and level
    of repetition, in one task.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    more = ", runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return texts.mapInArrow(_digests(with_texts, min_length), _SCHEMA + more * with_texts)
