"""Toxicity by a weighted finite-state grammar over clauses.

Words are read as classes: insult, threat, target, negation, report, quotation mark, other.
Transducers for negation, reported speech and targets are composed into one machine, which
rewrites the insults and threats of a clause: an insult after a negation or in reported speech
is marked as such, one that goes with a target as aimed. A text's score is a logistic function
of its numbers of matches of each kind, with weights learned from labels. Insult words and
stems are learned as well, besides a list of common ones.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctmart.llm.common import held_out, sample_texts

TRAIN_PER_LABEL = 2000
#: Stems are beginnings of words with these lengths.
STEM_LENGTHS = range(4, 11)
#: A learned word or stem is this many times as frequent in toxic documents, and stands in
#: this many and this share of them.
ODDS, LEAST_DOCUMENTS, LEAST_SHARE = 25.0, 5, 0.004
_CACHED = 500_000

# Common words of each class.
INSULTS = "idiot moron stupid dumb pathetic worthless disgusting scum trash loser clown"
THREATS = "kill murder destroy hurt beat shoot burn hang stab tuer détruire töten schlagen matar golpear"
TARGETS = (
    "you your yours he him she her they them their these those people "
    "tu toi vous ils elles eux du dich dir ihr euch sie tú te ti usted ustedes ellos ellas"
)
NEGATIONS = "not no never nobody none isn't aren't wasn't don't nicht kein keine nie ne pas jamais nunca jamás"
REPORTS = "said says told wrote called quoted claimed reported sagte schrieb nannte dit écrit appelé dijo escribió llamó"

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = range(7)
#: What the machine makes of insults and threats.
AIMED, NEGATED, REPORTED, AIMED_THREAT, AIMED_LATER = range(7, 12)
KINDS = (INSULT, AIMED, NEGATED, REPORTED, THREAT, AIMED_THREAT)
_CLAUSE_END = re.compile(r"[.!?;:,\n]")
_EDGE = re.compile(r"^[^\w']+|[^\w']+$")

Transducer = dict[tuple[object, int], tuple[object, int]]


def transducer(states: range, symbols: range, rule) -> Transducer:
    """All arcs (state, symbol) -> (state, symbol) of a rule. State 0 is the first."""
    return {(s, x): rule(s, x) for s in states for x in symbols}


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that gives the first one's output to the second one."""
    arcs: Transducer = {}
    todo, seen = [(0, 0)], {(0, 0)}
    while todo:
        a, b = todo.pop()
        for (state, symbol), (next_a, middle) in first.items():
            if state == a:
                next_b, out = second[b, middle]
                arcs[(a, b), symbol] = ((next_a, next_b), out)
                if (next_a, next_b) not in seen:
                    seen.add((next_a, next_b))
                    todo.append((next_a, next_b))
    number = {state: i for i, state in enumerate(sorted(seen))}
    return {(number[s], x): (number[n], out) for (s, x), (n, out) in arcs.items()}


def _negation(state: int, symbol: int) -> tuple[int, int]:
    """A negation reaches over the next three words."""
    if symbol == NEGATION:
        return 3, symbol
    reached = state > 0 and symbol in (INSULT, THREAT)
    return max(0, state - 1), NEGATED if reached else symbol


def _report(state: int, symbol: int) -> tuple[int, int]:
    """A word of saying reaches to the clause's end, a quotation mark to the next one."""
    if symbol == REPORT:
        return 1, symbol
    if symbol == QUOTE:
        return 0 if state == 2 else 2, symbol
    return state, REPORTED if state and symbol in (INSULT, THREAT) else symbol


def _target(state: int, symbol: int) -> tuple[int, int]:
    """A target aims the clause's insults and threats, also one before it."""
    if symbol == TARGET:
        return 1, AIMED_LATER if state == 2 else symbol
    if symbol == INSULT:
        return (1, AIMED) if state == 1 else (2, symbol)
    if symbol == THREAT:
        return (1, AIMED_THREAT) if state == 1 else (state, symbol)
    return state, symbol


GRAMMAR = compose(
    compose(transducer(range(4), range(12), _negation), transducer(range(3), range(12), _report)),
    transducer(range(3), range(12), _target),
)


def match_clause(classes: list[int]) -> Counter:
    """Numbers of matches of each kind in a clause's word classes."""
    state, found = 0, Counter()
    for symbol in classes:
        state, out = GRAMMAR[state, symbol]
        if out == AIMED_LATER:
            found[INSULT] -= 1
            found[AIMED] += 1
        elif out in KINDS:
            found[out] += 1
    return found


@dataclass
class Lexicon:
    """Words of each class and insult stems, with a bounded cache of tokens read."""

    words: dict[str, int]
    stems: frozenset[str] = frozenset()
    known: dict[str, tuple[int, bool, bool]] = field(default_factory=dict)

    def read(self, token: str) -> tuple[int, bool, bool]:
        """A token's class, and whether it begins and ends a quotation or clause."""
        word = _EDGE.sub("", token).lower()
        kind = self.words.get(word)
        if kind is None:
            stem = any(word[:n] in self.stems for n in STEM_LENGTHS if len(word) >= n)
            kind = INSULT if stem else OTHER
        return kind, '"' in token or "«" in token or "»" in token, bool(_CLAUSE_END.search(token[-2:]))

    def features(self, text: str | None) -> np.ndarray:
        """Numbers of matches by kind, and of words."""
        tokens = (text or "").split()
        known = self.known
        if len(known) > _CACHED:
            known.clear()
        found = list(map(known.get, tokens))
        if None in found:
            for i, value in enumerate(found):
                if value is None:
                    found[i] = known[tokens[i]] = self.read(tokens[i])
        total: Counter = Counter()
        done = -1
        for at, (kind, _, _) in enumerate(found):
            if at > done and kind in (INSULT, THREAT):
                begin = at
                while begin > done + 1 and not found[begin - 1][2]:
                    begin -= 1
                end = at
                while end + 1 < len(found) and not found[end][2]:
                    end += 1
                clause = []
                for k, quote, _ in found[begin : end + 1]:
                    clause += [QUOTE, k] if quote else [k]
                total += match_clause(clause)
                done = end
        return np.array([max(0, total[k]) for k in KINDS] + [len(tokens)], float)


def common_lexicon() -> dict[str, int]:
    classes = (
        (INSULTS, INSULT),
        (THREATS, THREAT),
        (TARGETS, TARGET),
        (NEGATIONS, NEGATION),
        (REPORTS, REPORT),
    )
    return {w: kind for words, kind in reversed(classes) for w in words.split()}


def learn_lexicon(samples: list[tuple[str, int]]) -> Lexicon:
    """The common words, and words and stems that are far more frequent in toxic samples.

    Near copies among the samples count once: texts with the same three least word hashes.
    """
    once, seen = [], set()
    for text, label in samples:
        words = {_EDGE.sub("", t).lower() for t in text.split()}
        least = tuple(sorted(zlib.crc32(w.encode()) for w in words)[:3])
        if (least, label) not in seen:
            seen.add((least, label))
            once.append((words, label))
    n = Counter(label for _, label in once)
    frequency = {0: Counter(), 1: Counter()}
    for words, label in once:
        units = {("word", w) for w in words}
        units |= {("stem", w[:k]) for w in words for k in STEM_LENGTHS if len(w) >= k}
        frequency[label].update(units)
    lexicon, stems = common_lexicon(), set()
    for (kind, unit), count in frequency[1].items():
        odds = (count + 0.5) / (n[1] + 1) / ((frequency[0][kind, unit] + 0.5) / (n[0] + 1))
        if unit and count >= max(LEAST_DOCUMENTS, LEAST_SHARE * n[1]) and odds >= ODDS:
            if kind == "word":
                lexicon.setdefault(unit, INSULT)
            else:
                stems.add(unit)
    return Lexicon(lexicon, frozenset(stems))


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    shift: float = 0.0

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        z = _design(np.array([self.lexicon.features(t) for t in texts])) @ self.weights + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _design(features: np.ndarray) -> np.ndarray:
    """Logarithms of the numbers of matches and of their share of the words, and a constant."""
    matches, words = features[:, :-1], features[:, -1:]
    total = matches.sum(1, keepdims=True)
    return np.concatenate(
        [np.log1p(matches), np.log1p(1000 * total / (words + 50)), (total > 0), np.ones_like(words)], axis=1
    )


def train(samples: list[tuple[str, int]], prior: float, steps: int = 40, penalty: float = 0.02) -> Model:
    """A model for (text, 0 or 1) samples; ``prior`` is label 1's share of all labels.

    Without samples of both labels every text gets the prior.
    """
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    log_odds = float(np.log(prior / (1 - prior)))
    y = np.array([label for _, label in samples], float)
    lexicon = learn_lexicon(samples)
    width = len(KINDS) + 3
    if len(set(y.tolist())) < 2:
        return Model(lexicon, np.zeros(width), log_odds)
    x = _design(np.array([lexicon.features(t) for t, _ in samples]))
    lexicon.known = {}
    w = np.zeros(width)
    ridge = np.full(width, penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(ridge)
        w += np.linalg.solve(h, x.T @ (y - p) / len(y) - ridge * w)
    share = float(y.mean())
    return Model(lexicon, w, log_odds - float(np.log(share / (1 - share))))


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``.

    A null or empty text has no matches and the score that goes with it. Learning uses a
    bounded sample of labelled rows that are not held out; labels with null ids or values are
    left out. Repeated rows are each scored; other columns are ignored.
    """
    usable = labels.where(~held_out() & F.col("toxic").isin(0, 1))
    share = usable.agg(F.avg("toxic").alias("share")).first()["share"]
    samples = sample_texts(docs, usable, "toxic", TRAIN_PER_LABEL)
    model = train(samples, 0.5 if share is None else share)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.score(texts.tolist()), dtype=float)

    return docs.select(
        "doc_id", held_out().alias("held_out"), score(F.coalesce("text", F.lit(""))).alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
