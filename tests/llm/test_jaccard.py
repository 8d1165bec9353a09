"""The token-group join against all pairs."""

from __future__ import annotations

import random

import brute
import pytest

from acctmart.llm import token_groups


def near_copies(seed, families=6, copies=14, words=60):
    """Texts in families of edited copies, with a line that many share, and plain odd ones."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    shared = [word() for _ in range(12)]
    texts = []
    for family in range(families):
        base = [word() for _ in range(words)]
        if family % 2:
            base[:12] = shared
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy = copy[: rng.randrange(50, len(copy))]
            texts.append(" ".join(copy))
            if rng.random() < 0.2:
                texts.append(" ".join(copy).upper().replace("W", "w"))
    texts += [None, "", " \t\n", "one", "one", "One two", "one two", "a b c d", "a b c d e", "é É ü", "é é ü"]
    texts += [" ".join(f"t{i}" for i in range(30_000)), " ".join(f"t{i}" for i in range(29_000))]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("width, percent, leaders", [(4, 85, 32), (5, 80, 32), (4, 85, 0)])
def test_against_all_pairs(spark, documents, monkeypatch, width, percent, leaders):
    """With no leaders every link is left to the matrix."""
    monkeypatch.setattr(token_groups, "LEADERS", leaders)
    texts = dict(enumerate(near_copies(width + leaders)))
    found = token_groups.jaccard_components(documents(*texts.items()), width, percent).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found}
    assert len(found) == len(texts)
    assert got == brute.components(texts, width, percent)


def test_repeated_and_null_ids(spark, documents):
    docs = documents((7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, "x y"), (3, "x z"), (3, "q r s"))
    found = token_groups.jaccard_components(docs).collect()
    assert sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"])) for r in found) == [
        ("3", 1, "3"), ("3", 1, "3"), ("7", 3, "7"), ("7", 3, "7"), ("None", 1, "None"), ("None", 3, "7"),
    ]
    kept = token_groups.one_of_each_component(docs)
    assert kept.columns == docs.columns
    assert sorted((repr(r["doc_id"]), r["text"]) for r in kept.collect())[-1] == ("None", "x y")
    assert kept.count() == 3


def test_empty_table(spark, documents):
    docs = documents((1, "a")).where("doc_id > 1")
    assert token_groups.jaccard_components(docs).collect() == []
    assert token_groups.one_of_each_component(documents((1, None), (2, ""))).count() == 2


def test_chain_of_links(spark, documents):
    """Neighbours link, ends do not: the component follows the whole chain."""
    words = [f"c{i}" for i in range(400)]
    texts = {i: " ".join(words[4 * i : 4 * i + 100]) for i in range(40)}
    found = token_groups.jaccard_components(documents(*texts.items())).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute.components(texts)
    assert {r["component_id"] for r in found} == {0}


def test_one_of_each_component_of_null_ids(spark, documents):
    words = [f"w{i}" for i in range(60)]
    near = [" ".join([*words, f"end{i}"]) for i in range(5)]
    other = " ".join(f"x{i}" for i in range(60))
    docs = documents(*((None, t) for t in near), (None, other), (None, other + " more"), (None, ""))
    kept = [r["text"] for r in token_groups.one_of_each_component(docs).collect()]
    assert sorted(t[:2] for t in kept) == ["", "w0", "x0"]
    mixed = documents(*((None, t) for t in near[1:]), (7, near[0]), (None, other))
    kept = [(r["doc_id"], r["text"]) for r in token_groups.one_of_each_component(mixed).collect()]
    assert sorted(kept, key=repr) == sorted([(7, near[0]), (None, other)], key=repr)
