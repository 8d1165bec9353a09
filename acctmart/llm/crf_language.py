"""Language of every word of code-switched text by a linear-chain conditional random field.

A word's features are its affixes, its letter n-grams and the learned languages' lexicons;
transitions between the languages of neighbouring words are learned as well. Training texts
are cut into stretches, and stretches of different documents are joined, so that there are
switches to learn from. Forward-backward gives each word's language probabilities, for many
documents at once; a document's language is the one with most weight over its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctmart.llm.common import held_out, sample_texts

TRAIN_PER_LANGUAGE = 400
#: Words of each training document, as a stretch from anywhere in it, and of a sequence.
TRAIN_WORDS, SEQUENCE = 160, 40
EPOCHS = 4
#: Feature weights are kept in this many hashed places.
PLACES = 1 << 16
#: A word is in a language's lexicon from this many training documents on.
LEXICON_DOCUMENTS = 3
#: Letters of a word; longer tokens are cut into several words.
LONGEST = 40
#: Words that are scored at a time.
_SCORED = 1 << 14
_CACHED = 400_000
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_LETTER = re.compile(r"[^\W\d_]")


def tokens_of(text: str) -> list[str]:
    """White-space separated tokens; one of more than ``LONGEST`` letters as several.

    Such a token is a sentence or more of a script without spaces, or glued text. Its parts
    follow each other without a gap and have about as many letters each.
    """
    tokens = text.split()
    if max(map(len, tokens), default=0) <= LONGEST:
        return tokens
    return [part for t in tokens for part in ((t,) if len(t) <= LONGEST else _parts(t))]


def _parts(token: str) -> list[str]:
    letters = [m.start() for m in _LETTER.finditer(token)]
    n = -(-len(letters) // LONGEST)
    cuts = [letters[len(letters) * i // n] for i in range(1, n)]
    return [token[a:b] for a, b in zip([0, *cuts], [*cuts, len(token)])]


def words_of(text: str) -> list[str]:
    """The tokens that have a letter."""
    return [t for t in tokens_of(text) if _LETTER.search(t)]


def letters_of(token: str) -> str:
    """A token's letters in lower case: what its features are made of."""
    return _NOT_LETTERS.sub("", token).lower()


def word_features(words: list[str], lexicon: dict[str, tuple[int, ...]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, word) pairs of all features of all ``words``, given as their letters.

    Features are a word's UTF-8 n-grams of 2 to 4 bytes, a mark at each end included; its
    affixes of up to 4 bytes, which are the n-grams with a mark, also those of 5 bytes; and
    the lexicons that have it, at places after the hashed ones, the last being for none.
    """
    marked = [b"^%b$" % w.encode() for w in words]
    lengths = np.array([len(m) for m in marked], np.int64)
    data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    ends = np.cumsum(lengths)[owner]
    starts = ends - lengths[owner]
    at = np.arange(len(data))
    places, owners = [], []
    for n in (2, 3, 4, 5):
        whole = at + n <= ends
        if n == 5:
            whole &= (at == starts) | (at + n == ends)
        begin = at[whole]
        mixed = np.full(len(begin), n, np.uint64)
        for i in range(n):
            mixed = (mixed ^ data[begin + i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(31)
        places.append((mixed % np.uint64(PLACES)).astype(np.int64))
        owners.append(owner[begin])
    known = [(PLACES + i, j) for j, w in enumerate(words) for i in lexicon.get(w, (k,))]
    places.append(np.array([p for p, _ in known], np.int64))
    owners.append(np.array([j for _, j in known], np.int64))
    return np.concatenate(places), np.concatenate(owners)


def word_scores(words: list[str], lexicon: dict, weights: np.ndarray) -> np.ndarray:
    """Each word's score for each language: the sum of its features' weights."""
    k = weights.shape[1]
    found = np.empty((len(words), k))
    for a in range(0, len(words), _SCORED):
        part = words[a : a + _SCORED]
        places, owners = word_features(part, lexicon, k)
        for i in range(k):
            found[a : a + len(part), i] = np.bincount(owners, weights[places, i], len(part))
    return found


def forward_backward(scores: np.ndarray, lengths: np.ndarray, log_move: np.ndarray) -> np.ndarray:
    """Each word's language probabilities.

    ``scores`` has the words of all sequences one after the other, ``lengths`` the sequences'
    lengths, and ``log_move[a, b]`` scores language b after a. All sequences take a step at
    once; those that have ended drop out, so the longest determines the steps.
    """
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    first = (np.cumsum(lengths) - lengths)[order]
    weights = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(log_move - log_move.max())
    ahead = np.empty_like(weights)
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), "left")  # sequences longer than t
    state = None
    for t in range(longest):
        at = first[: active[t]] + t
        state = weights[at] if state is None else (state[: len(at)] @ move) * weights[at]
        state = state / state.sum(axis=1, keepdims=True)
        ahead[at] = state
    back = np.ones((len(sizes), weights.shape[1]))
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t + 1
        step = (weights[at] * back[: len(at)]) @ move.T
        back[: len(at)] = step / step.sum(axis=1, keepdims=True)
        ahead[at - 1] *= back[: len(at)]
    return ahead / ahead.sum(axis=1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    lexicon: dict[str, tuple[int, ...]]
    weights: np.ndarray
    move: np.ndarray
    known: dict[str, int] = field(default_factory=dict)
    table: np.ndarray | None = None

    def rows(self, tokens: list[str]) -> list[int]:
        """Places of the tokens' scores in ``table``; -1 for a token without letters."""
        found = list(map(self.known.get, tokens))
        if None in found:
            new: dict[str, int] = {}
            for i, place in enumerate(found):
                if place is None:
                    token = tokens[i]
                    place = new.get(token)
                    if place is None:
                        place = self.used + len(self.waiting) if _LETTER.search(token) else -1
                        if place >= 0:
                            self.waiting.append(letters_of(token))
                        new[token] = place
                    found[i] = place
            self.known.update(new)
        return found

    def score_waiting(self) -> None:
        """Score the words that came new."""
        if self.waiting:
            scores = word_scores(self.waiting, self.lexicon, self.weights)
            while self.used + len(scores) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[self.used : self.used + len(scores)] = scores
            self.used += len(scores)
            self.waiting = []

    def label_words(self, text: str) -> list[tuple[str, str, float]]:
        """Each word that has a letter, its most likely language and that one's probability."""
        words = words_of(text)
        if not self.languages or not words:
            return [(w, UNKNOWN, 0.0) for w in words]
        scores = word_scores([letters_of(w) for w in words], self.lexicon, self.weights)
        found = forward_backward(scores, np.array([len(words)]), self.move)
        return [(w, self.languages[k], float(p[k])) for w, p, k in zip(words, found, found.argmax(axis=1))]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Each text's language and its share of the words' probability."""
        if self.table is None or len(self.known) > _CACHED:
            self.known, self.used, self.waiting = {}, 0, []
            self.table = np.zeros((1 << 15, len(self.languages)), np.float32)
        rows = [np.array(self.rows(tokens_of(t)), np.int64) for t in texts]
        self.score_waiting()
        rows = [r[r >= 0] for r in rows]
        lengths = np.array([len(r) for r in rows], np.int64)
        names, shares = [UNKNOWN] * len(texts), np.zeros(len(texts))
        some = np.flatnonzero(lengths)
        if not self.languages or not len(some):
            return names, shares
        found = forward_backward(self.table[np.concatenate(rows)].astype(float), lengths[some], self.move)
        starts = np.cumsum(lengths[some]) - lengths[some]
        mean = np.add.reduceat(found, starts) / lengths[some, None]
        for i, k in zip(some.tolist(), mean.argmax(axis=1).tolist()):
            names[i] = self.languages[k]
        shares[some] = np.clip(mean.max(axis=1), 0, 1)
        return names, shares


def train(samples: list[tuple[str, str]], epochs: int = EPOCHS, seed: int = 1) -> Model:
    """A model for (text, language) samples; no samples give a model that knows no language."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for _, lang in samples})
    number = {lang: i for i, lang in enumerate(languages)}
    stretches, seen = [], Counter()
    for text, lang in samples:
        words = words_of(text)
        begin = int(rng.integers(0, max(1, len(words) - TRAIN_WORDS + 1)))
        words = words[begin : begin + TRAIN_WORDS]
        seen.update((w, number[lang]) for w in {letters_of(w) for w in words})
        # Parts of a few words up to a whole sequence, so that switches are at any place.
        while words:
            n = int(rng.integers(4, SEQUENCE + 1))
            stretches.append((words[:n], number[lang]))
            words = words[n:]
    lexicon: dict[str, tuple[int, ...]] = {}
    for (word, k), count in sorted(seen.items()):
        if count >= LEXICON_DOCUMENTS:
            lexicon[word] = (*lexicon.get(word, ()), k)
    k = len(languages)
    weights, move = np.zeros((PLACES + k + 1, k)), np.zeros((k, k))
    if k < 2 or not stretches:
        return Model(languages, lexicon, weights, move)
    vocabulary: dict[str, int] = {}
    for words, _ in stretches:
        for w in words:
            vocabulary.setdefault(letters_of(w), len(vocabulary))
    found, owners = word_features(list(vocabulary), lexicon, k)
    order = np.argsort(owners, kind="stable")
    places = np.split(found[order], np.cumsum(np.bincount(owners))[:-1])
    squares, move_squares = np.full_like(weights, 1e-2), np.full_like(move, 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(stretches))
        sequences: list[tuple[list[int], list[int]]] = []
        ids: list[int] = []
        gold: list[int] = []
        for i in order:
            words, lang = stretches[i]
            ids += [vocabulary[letters_of(w)] for w in words]
            gold += [lang] * len(words)
            if len(ids) >= SEQUENCE:
                sequences.append((ids, gold))
                ids, gold = [], []
        for a in range(0, len(sequences), 64):
            batch = sequences[a : a + 64]
            lengths = np.array([len(s[0]) for s in batch])
            words = np.concatenate([s[0] for s in batch])
            truth = np.concatenate([s[1] for s in batch])
            used, inverse = np.unique(words, return_inverse=True)
            flat = np.concatenate([places[u] for u in used])
            owner = np.repeat(np.arange(len(used)), [len(places[u]) for u in used])
            score = np.zeros((len(used), k))
            np.add.at(score, owner, weights[flat])
            scores = score[inverse]
            marginal = forward_backward(scores, lengths, move)
            wrong = -marginal
            wrong[np.arange(len(truth)), truth] += 1
            by_word = np.zeros((len(used), k))
            np.add.at(by_word, inverse, wrong)
            step, at = np.unique(flat, return_inverse=True)
            g = np.zeros((len(step), k))
            np.add.at(g, at, by_word[owner])
            g -= 0.01 * weights[step]
            squares[step] += g * g
            weights[step] += 0.3 * g / np.sqrt(squares[step])
            g = _move_gradient(scores, lengths, move, truth) - 0.01 * move
            move_squares += g * g
            move += 0.3 * g / np.sqrt(move_squares)
    return Model(languages, lexicon, weights.astype(np.float32), move)


def _move_gradient(scores: np.ndarray, lengths: np.ndarray, move: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """Moves in the truth less expected moves, from pairs of forward and backward states."""
    k = len(move)
    weights = np.exp(scores - scores.max(axis=1, keepdims=True))
    factor = np.exp(move - move.max())
    g = np.zeros((k, k))
    start = 0
    longest = int(lengths.max())
    inside = np.arange(longest)[None, :] < lengths[:, None]
    padded = np.ones((len(lengths), longest, k))
    padded[inside] = weights
    ahead, behind = np.empty_like(padded), np.ones_like(padded)
    ahead[:, 0] = padded[:, 0]
    for t in range(1, longest):
        ahead[:, t] = (ahead[:, t - 1] @ factor) * padded[:, t]
        ahead[:, t] /= ahead[:, t].sum(axis=1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        step = (padded[:, t + 1] * behind[:, t + 1]) @ factor.T
        step /= step.sum(axis=1, keepdims=True)
        behind[:, t] = np.where(inside[:, t + 1, None], step, 1.0)
    pair = ahead[:, :-1, :, None] * factor * (padded[:, 1:] * behind[:, 1:])[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    g -= pair[inside[:, 1:]].sum(axis=0)
    for n in lengths:
        path = truth[start : start + n]
        np.add.at(g, (path[:-1], path[1:]), 1)
        start += n
    return g


def predict_language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per row of ``docs``.

    Learns from text and non-null lang of a bounded sample of rows that are not held out. A
    null text, or one without a letter, is ``und`` with score 0, as is every text if there is
    nothing to learn from. A token of more than ``LONGEST`` letters counts as several words,
    so that all its letters are read and weigh by their number. Of equal shares the language that sorts first is taken. Repeated
    rows are each predicted; lang is never used for a prediction, nor are other columns.
    """
    samples = sample_texts(docs, docs.select("doc_id", "lang"), "lang", TRAIN_PER_LANGUAGE)
    shared = docs.sparkSession.sparkContext.broadcast(train(samples))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            texts, parts = texts.tolist(), []
            begin = size = 0
            for i, text in enumerate(texts, 1):
                size += len(text)
                if size > 2 << 20 or i == len(texts):
                    parts.append(shared.value.predict(texts[begin:i]))
                    begin, size = i, 0
            names = [n for part in parts for n in part[0]]
            scores = np.concatenate([part[1] for part in parts]) if parts else []
            yield pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": pd.Series(scores, dtype=float)})

    found = predict(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", held_out().alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score"
    )
