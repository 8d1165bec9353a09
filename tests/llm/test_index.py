"""Phrase search, decontamination and licence scans against plain searches."""

from __future__ import annotations

import random

import brute
import pytest

from acctmart.llm import license_scan, positional_index


def corpus(seed=5):
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.randrange(14, 40))) for i in range(12)]
    items += [(20, "V1, v2; v3!"), (21, ""), (22, None), (23, "..."), (3, text(20)), (24, items[0][1])]
    texts = [None, "", "--- !", "v1 v2 v3", "v1 v2 v3 " * 20 + text(300), "v1 v2 v3 " + text(300), text(8000)]
    for _ in range(60):
        item = rng.choice(items)[1] or ""
        begin = rng.randrange(0, 5)
        cut = " ".join(item.split()[begin : begin + rng.randrange(8, 40)])
        texts.append(f"{text(rng.randrange(0, 200))}. {cut.upper()} {text(rng.randrange(0, 100))}")
    return texts, items


@pytest.mark.parametrize("shard, block", [(500_000, 8 << 20), (150, 100)])
def test_contamination(spark, documents, tmp_path, monkeypatch, shard, block):
    """Also with many small shards, and with the benchmark in many blocks."""
    monkeypatch.setattr(positional_index, "SHARD_WORDS", shard)
    monkeypatch.setattr(positional_index, "BLOCK_BYTES", block)
    texts, items = corpus()
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    assert positional_index.benchmark_blocks(positional_index.benchmark_items(benchmark)) > 10 or block > 1 << 20
    found = positional_index.contamination(documents(*enumerate(texts)), benchmark, str(tmp_path / "i")).collect()
    got = {r["doc_id"]: tuple(r)[1:6] for r in found}
    assert len(found) == len(texts)
    assert got == dict(enumerate(brute.contamination(texts, items)))
    assert any(v[-1] for v in got.values()) and any(v[1] and not v[-1] for v in got.values())


def test_a_large_benchmark_gives_what_a_small_one_does(spark, documents, tmp_path, monkeypatch):
    """Repeated documents stay apart, and repeated items and those of a null id count as ever."""
    texts, items = corpus(7)
    pairs = [*enumerate(texts), *[(5, texts[5])] * 9, *[(None, texts[6])] * 4, (None, None), (None, "")]
    rows = [*items, *items[:4], (None, texts[6]), (None, items[2][1]), (None, None)]
    benchmark = spark.createDataFrame(rows, "item_id long, text string").repartition(4)
    monkeypatch.setattr(positional_index, "SHARD_WORDS", 400)
    results = []
    for name, limit in (("a", 8 << 20), ("b", 300)):
        monkeypatch.setattr(positional_index, "BLOCK_BYTES", limit)
        found = positional_index.contamination(documents(*pairs), benchmark, str(tmp_path / name)).collect()
        results.append(sorted((tuple(r) for r in found), key=repr))
    assert results[0] == results[1] and len(results[0]) == len(pairs)
    assert any(r[2] for r in results[0] if r[0] is None)


def test_stage_drops_contaminated_rows_only(spark, documents, tmp_path):
    texts, items = corpus(6)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(*enumerate(texts), (None, "v1 v2 v3"), (None, "fine words"), (0, "v1 v2 v3"))
    kept = positional_index.without_contaminated(docs, benchmark, str(tmp_path / "i"))
    assert kept.columns == docs.columns
    clean = [i for i, r in enumerate(brute.contamination(texts, items)) if not r[-1]]
    assert sorted((repr(r["doc_id"]), r["text"]) for r in kept.collect() if r["text"]) == sorted(
        [(repr(i), texts[i]) for i in clean if texts[i]] + [("None", "fine words")]
    )


def test_empty_tables(spark, documents, tmp_path):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    one = documents((1, "a b"))
    rows = positional_index.contamination(one, benchmark, str(tmp_path / "a")).collect()
    assert [tuple(r)[1:4] for r in rows] == [(2, 0, 0)]
    none = one.where("doc_id > 1")
    assert positional_index.contamination(none, benchmark, str(tmp_path / "b")).collect() == []
    assert license_scan.scan_licenses(none).collect() == []


def test_phrases_and_close_terms(spark, documents, tmp_path):
    docs = documents((1, "the quick brown fox jumps"), (2, "fox, quick and brown"), (3, "quick"), (4, "brown"))
    positional_index.write_index(docs, str(tmp_path / "i"))
    items = [(9, [b"quick", b"brown", b"fox"])]
    spans = positional_index.phrase_spans(spark, str(tmp_path / "i"), items).where("size(items) > 0").collect()
    assert [(r["doc_id"], r["firsts"], r["lasts"], r["items"]) for r in spans] == [(1, [1], [3], [9])]
    near = positional_index.near_matches(spark, str(tmp_path / "i"), items, slop=4).collect()
    assert sorted(map(tuple, near)) == [(1, 9, 1, 3), (2, 9, 0, 3)]
    assert len(positional_index.near_matches(spark, str(tmp_path / "i"), items, slop=3).collect()) == 1


def near_by_hand(texts, terms, slop):
    """(text, first, last) of the shortest span around each place of a text's rarest term."""
    out = []
    for i, text in enumerate(texts):
        words = text.split()
        counts = [words.count(t) for t in terms]
        if not all(counts):
            continue
        rarest = terms[counts.index(min(counts))]
        for a in (k for k, w in enumerate(words) if w == rarest):
            spans = [
                (last - first, first)
                for first in range(a + 1)
                for last in range(a, len(words))
                if last - first < slop and set(terms) <= set(words[first : last + 1])
            ]
            if spans:
                width, first = min(spans)
                out.append((i, first, first + width))
    return sorted(out)


@pytest.mark.parametrize("shard", [500_000, 40, 1])
def test_close_terms_against_all_spans(spark, documents, tmp_path, monkeypatch, shard):
    monkeypatch.setattr(positional_index, "SHARD_WORDS", shard)
    rng = random.Random(8)
    texts = ["w w w w w w w b w w a w w b c", "b b c", "a", "c b a", ""]
    texts += [" ".join(rng.choice("aabbbcdefgw") for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    docs = documents(*enumerate(texts)).coalesce(1)
    positional_index.write_index(docs, str(tmp_path / "i"))
    items = [(i, [w.encode() for w in t]) for i, t in enumerate(["abc", "a", "bb", "cba", "defg", "wb", "abcdefgw"])]
    for slop in (1, 2, 5, 9, 1000):
        got = {}
        for d, i, a, b in map(tuple, positional_index.near_matches(spark, str(tmp_path / "i"), items, slop).collect()):
            got.setdefault(i, []).append((d, a, b))
        for i, words in items:
            terms = [w.decode() for w in dict.fromkeys(words)]
            assert sorted(got.get(i, [])) == near_by_hand(texts, terms, slop), (slop, terms)


def test_farther_place_of_the_same_document():
    shard = positional_index.Shard(b"", b"", b"", [20, 3])
    np_list = lambda *x: positional_index.np.array(x)
    assert positional_index.near_spans(shard, [np_list(10), np_list(7, 14), np_list(14)], 5) == [(10, 14)]
    assert positional_index.near_spans(shard, [np_list(18), np_list(13, 21)], 6) == [(13, 18)]


def test_base_phrases(spark, documents):
    rng = random.Random(2)
    parts = ["under the MIT license", "Apache License, Version 2.0", "CC-BY-NC", "cc by", "the mit", "license", "nc cc by nc", "under", "version 2", "w"]
    texts = [None, "", "under the mit license", "under the mit licensee"]
    texts += [" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(80)]
    phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    rows = {r["doc_id"]: r for r in license_scan.scan_licenses(documents(*enumerate(texts))).collect()}
    for i, text in enumerate(texts):
        words = brute.WORD.findall(brute.lower(text))
        places = [
            (a, label)
            for label, phrase in phrases.items()
            for a in range(len(words))
            if words[a : a + len(phrase.split())] == phrase.split()
        ]
        starts = [a for a, _ in places]
        r = rows[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert {x for x in r["base_labels"].split(",") if x} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1 or not places)


def test_notices_need_their_key_phrases(spark, documents):
    notice = next(t for t in license_scan.NOTICES if t.label == "bsd").text
    broken = notice.replace("source and binary forms", "source or any form")
    other = "the forms that you have met are permitted, with the source in use"
    filler = " ".join(f"f{i}" for i in range(200))
    docs = documents((1, f"{filler} {notice} {filler}"), (2, broken), (3, other), (4, "the GNU General Public License"))
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan.scan_licenses(docs).collect()}
    assert labels[1] == ("bsd", 1.0)
    assert labels[2] == ("", 0.0) and labels[3] == ("", 0.0)
    assert labels[4][0] == "gpl" and 0 < labels[4][1] < 1
