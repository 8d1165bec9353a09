"""Learned operators: held-out accuracy, defined results for odd input."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pytest

from acctmart.llm import byte_cnn, clause_grammar, crf_language

FOLDER = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels")}


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def truth(tables, label):
    return {r["doc_id"]: r[label] for r in tables["labels"].collect()}


@needs_data
def test_language(tables):
    lang = {r["doc_id"]: r["lang"] for r in tables["documents"].collect()}
    rows = crf_language.predict_language(tables["documents"]).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    right = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert np.mean(right) > 0.97


@needs_data
def test_quality(tables):
    quality = truth(tables, "quality")
    rows = byte_cnn.score_quality(tables["documents"], tables["labels"]).collect()
    assert len(rows) == 1000
    assert all((r["predicted"] == 1) == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    good = [r["predicted"] for r in rows if r["held_out"] and quality.get(r["doc_id"]) == 1]
    assert np.mean(good) > 0.95


@needs_data
def test_toxicity(tables):
    toxic = truth(tables, "toxic")
    rows = clause_grammar.score_toxicity(tables["documents"], tables["labels"]).collect()
    assert len(rows) == 1000
    assert all((r["predicted"] == 1) == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)
    right = [r["predicted"] == toxic[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in toxic]
    assert np.mean(right) > 0.9


ODD = [(1, None), (2, ""), (3, "12 34 !?"), (4, "word " * 60_000), (4, "word " * 60_000), (None, "a b"), (5, "\0")]


def test_odd_texts_and_tables(spark, documents):
    docs = documents(*ODD)
    labels = spark.createDataFrame(
        [(4, 1, 0), (None, 1, 1), (5, None, None), (1, 0, 1), (4, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int"
    )
    for found in (byte_cnn.score_quality(docs, labels), clause_grammar.score_toxicity(docs, labels)):
        rows = found.collect()
        assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    empty = docs.where("doc_id > 9"), labels.where("doc_id > 9")
    assert byte_cnn.score_quality(*empty).collect() == []
    assert clause_grammar.score_toxicity(*empty).collect() == []
    assert {r["score"] for r in byte_cnn.score_quality(docs, empty[1]).collect()} == {0.5}
    assert byte_cnn.without_rejected(docs, empty[1]).columns == docs.columns
    rows = crf_language.predict_language(docs).collect()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 5)} == {"und"}
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert crf_language.predict_language(empty[0]).collect() == []


def test_sample_is_filled_with_usable_texts(spark):
    from acctmart.llm.common import sample_texts

    # Of each five rows of a label one has a usable text.
    texts = [(i, f"text {i}" if i % 10 in (0, 1) else None if i % 3 else "long " * 20, "ab"[i % 2]) for i in range(600)]
    docs = spark.createDataFrame([*texts, (0, None, "a"), (None, "no", "a")], "doc_id long, text string, lang string")
    found = sample_texts(docs, docs.select("doc_id", "lang"), "lang", 20, longest=50)
    assert sorted(lang for _, lang in found) == ["a"] * 20 + ["b"] * 20
    assert all(t.startswith("text ") and int(t[5:]) % 2 == "ab".index(lang) for t, lang in found)


def test_words_of_switched_text():
    english = "the cat sat on the mat and the dog was with them in this house"
    spanish = "el gato se sienta en la casa y el perro está con ellos en esta calle"
    model = crf_language.train([(english, "en"), (spanish, "es")] * 40)
    labels = model.label_words("the dog was with them, el gato está en la casa 12")
    assert [lang for _, lang, _ in labels] == ["en"] * 5 + ["es"] * 6
    assert model.move[0, 0] > model.move[0, 1] and model.move[1, 1] > model.move[1, 0]


def test_long_unspaced_text_is_read_to_its_end():
    english = "the cat sat on the mat and the dog was with them in this house"
    spanish = "el gato se sienta en la casa y el perro está con ellos en esta calle"
    glued = [(t.replace(" ", ""), lang) for t, lang in ((english, "en"), (spanish, "es"))]
    model = crf_language.train([(english, "en"), (spanish, "es"), *glued] * 40)
    text = glued[0][0] + glued[1][0] * 5
    words = crf_language.words_of(text)
    assert "".join(words) == text and all(len(w) <= crf_language.LONGEST for w in words)
    labels = [lang for _, lang, _ in model.label_words(text)]
    assert labels[0] == "en" and labels[-1] == "es" and labels.count("es") > labels.count("en")
    assert model.predict([text, glued[0][0]])[0] == ["es", "en"]
    marks = "1" * 50 + "-ab-" * 20 + "9" * 50
    assert crf_language.words_of(marks) == [marks]
    assert crf_language.tokens_of("") == [] and "".join(crf_language.words_of(marks * 3)) == marks * 3


def test_forward_backward_against_all_paths():
    from itertools import product

    rng = np.random.default_rng(2)
    move, lengths = rng.normal(size=(3, 3)), np.array([4, 1, 3])
    scores = rng.normal(size=(8, 3))
    found = crf_language.forward_backward(scores, lengths, move)
    start = 0
    for n in lengths:
        want = np.zeros((n, 3))
        for path in product(range(3), repeat=int(n)):
            s = sum(scores[start + i, k] for i, k in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:]))
            for i, k in enumerate(path):
                want[i, k] += np.exp(s)
        np.testing.assert_allclose(found[start : start + n], want / want.sum(1, keepdims=True), rtol=1e-9)
        start += n


def test_clauses():
    lexicon = clause_grammar.Lexicon(clause_grammar.common_lexicon())
    kinds = clause_grammar.KINDS
    count = lambda text: {k: int(v) for k, v in zip(kinds, lexicon.features(text)) if v}
    assert count("you are an idiot.") == {clause_grammar.AIMED: 1}
    assert count("what an idiot you are") == {clause_grammar.AIMED: 1}
    assert count("you are not an idiot") == {clause_grammar.NEGATED: 1}
    assert count("he said idiot again") == {clause_grammar.REPORTED: 1}
    assert count("I will kill you") == {clause_grammar.THREAT: 1}
    assert count("you, a stupid thing") == {clause_grammar.INSULT: 1}
    assert count("nothing here") == {}


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    model = byte_cnn.new_model()
    for k in model:
        model[k] = model[k].astype(np.float64)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    rows = [byte_cnn.chunk_matrix(t) for t in (" ".join(words[:200]), " | ".join(words[200:]))]
    y = np.array([1.0, 0.0])
    g = byte_cnn._gradients(model, rows, y)

    def loss():
        chunks = np.concatenate(rows)
        counts = np.array([len(r) for r in rows])
        peaks = np.maximum(byte_cnn.largest(model, chunks) + model["bias"], 0)
        z, _ = byte_cnn._logits(model, byte_cnn._pool(peaks, np.cumsum(counts) - counts, counts).astype(float))
        return float(np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y)))

    for name in ("filters", "bias", "w1", "w2", "embed"):
        flat, got = model[name].reshape(-1), g[name].reshape(-1)
        for i in rng.choice(np.flatnonzero(np.abs(got) > 1e-4), 3):
            old = flat[i]
            flat[i] = old + 1e-3
            up = loss()
            flat[i] = old - 1e-3
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-3 - got[i]) < 0.05 * abs(got[i]) + 2e-3
