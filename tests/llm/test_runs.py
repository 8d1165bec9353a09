"""Periodic runs against a plain search of all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from acctmart.llm import periodic_runs


def plain_runs(words, min_length=12):
    """All maximal runs by trying every period at every place."""
    n, best = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(min_length, 2 * p):
                best.setdefault((i, j + p - i), p)  # the smallest period comes first
            i = j
    return sorted(((s, n, p) for (s, n), p in best.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    """The query's row for one document."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def sequence(rng, n, kinds):
    """Symbols with many repeated and nested stretches."""
    out = []
    while len(out) < n:
        if out and rng.random() < 0.4:
            out += out[-rng.randint(1, min(len(out), 20)) :] * rng.randint(1, 6)
        elif rng.random() < 0.2:
            out += [rng.randrange(kinds) for _ in range(rng.randint(1, 4))] * rng.randint(2, 12)
        else:
            out.append(rng.randrange(kinds))
    return out[:n]


@pytest.mark.parametrize("min_length", [1, 2, 5, 12, 31])
def test_runs_of_random_sequences(min_length):
    rng = random.Random(min_length)
    for _ in range(400):
        words = sequence(rng, rng.randint(0, 150), rng.choice([1, 2, 3, 6, 20]))
        found = periodic_runs.find_runs(np.array(words, np.int64), min_length)
        assert [tuple(r) for r in found.tolist()] == plain_runs(words, min_length)


def test_stretches_that_meet():
    """Squares around the meeting of two periodic stretches, and a Fibonacci word."""
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    for words in (b, [0, 1] * 20 + [0, 0, 1] * 20, ([0, 1] * 9 + [0]) * 2 + [1, 0] * 15, [0] * 40 + [1] + [0] * 40):
        found = periodic_runs.find_runs(np.array(words, np.int64))
        assert [tuple(r) for r in found.tolist()] == plain_runs(words)


def test_successor_is_the_least_value_from_the_bound():
    rng = np.random.default_rng(5)
    values = rng.permutation(200)
    tree = periodic_runs.WaveletTree(values, 200)
    lo = rng.integers(0, 200, 500)
    hi = np.minimum(200, lo + rng.integers(0, 60, 500))
    bound = rng.integers(0, 700, 500)
    for a, b, x, found in zip(lo, hi, bound, tree.successor(lo, hi, bound, -1)):
        assert found == min((v for v in values[a:b] if v >= x), default=-1)


def test_words_are_cut_at_ascii_space_only():
    texts = ["", " a  b\x0b\x0cc ", "\x1ca\x85b\xa0c　d", "a\r\n\tb", "  ", "é漢 é"]
    words, counts = periodic_runs.word_lists(pa.array(texts))
    plain = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    assert words.to_pylist() == [w for ws in plain for w in ws]
    assert counts.tolist() == list(map(len, plain))


def test_documents(spark, documents):
    rng = random.Random(11)
    texts = [
        " ".join(f"w{k}" for k in sequence(rng, rng.randint(0, 90), rng.choice([2, 5, 30])))
        for _ in range(250)
    ]
    odd = [(None, "a b " * 9), (None, None), (7, None), (8, ""), (9, " \n\t "), (9, "again " * 12), (9, "again " * 12)]
    long = [(3000 + i, " ".join(f"w{k % 700}" for k in range(40_000))) for i in range(2)]
    rows = [*enumerate(texts), *odd]
    found = periodic_runs.periodic_runs(documents(*rows), with_texts=True).collect()
    wanted = sorted((plain_row(i, t) for i, t in rows), key=repr)
    assert sorted((tuple(r)[:8] for r in found), key=repr) == wanted
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in enumerate(texts))
    for r in found:
        assert len(r["runs"]) == r["n_runs"]
        assert hashlib.sha256(r["collapsed"].encode()).hexdigest() == r["collapsed_sha256"]
    one = periodic_runs.periodic_runs(documents(*[x for x in long if zlib.crc32(str(x[0]).encode()) % 10])).first()
    assert (one["n_runs"], one["start"], one["length"], one["period"]) == (1, 0, 40_000, 700)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, runs int")
    assert periodic_runs.periodic_runs(docs).collect() == []
