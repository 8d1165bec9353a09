"""Licence notices found through a positional index of the templates' rare words.

The templates' words are counted over all documents. Each template is indexed by the words of
its mandatory key phrases that have the highest inverse document frequency, and by their
positions. In a file, places of those words vote
for where the template would begin; a begin that enough rare words agree on, within a slack
of some words, is checked by the template's mandatory key phrases, which must stand word for
word near their positions. Base phrases are templates that allow no slack, so that all their
places are found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctmart.llm.common import slices
from acctmart.llm.positional_index import words_of

#: Words that each template is indexed by.
RARE_WORDS = 3
#: Words by which a template's parts may be out of place.
SLACK = 6


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key_phrases: tuple[str, ...]


# The phrases that the base columns report.
BASE = (
    Template("mit", "under the mit license", ("under the mit license",)),
    Template("apache-2", "apache license version 2", ("apache license version 2",)),
    Template("cc-by-nc", "cc by nc", ("cc by nc",)),
)

# Wording of public licences.
NOTICES = (
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Template(
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License",
        ("apache license version 2", "except in compliance with the license"),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms", "with or without modification"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
        ("permission to use copy modify", "with or without fee is hereby granted"),
    ),
    Template("gpl", "licensed under the GNU General Public License, version", ("gnu general public license",)),
    Template("lgpl", "under the terms of the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the GNU Affero General Public License", ("gnu affero general public license",)),
    Template("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("cc-by-sa", "licensed under CC BY-SA", ("cc by sa",)),
    Template("cc0", "CC0 1.0 Universal public domain dedication", ("cc0 1 0 universal",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)


def template_words(templates: tuple[Template, ...]) -> dict[bytes, int]:
    """Numbers from 1 of all words of the templates; 0 stands for other words."""
    words = {w for t in templates for w in words_of(t.text)}
    words |= {w for t in templates for p in t.key_phrases for w in words_of(p)}
    return {w: i for i, w in enumerate(sorted(words), 1)}


def _numbers(texts: list[str | None], number: dict[bytes, int], gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words of all texts, ``gap`` zeros after each text, and word counts."""
    parts, counts = [], []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        found = np.zeros(len(words) + gap, np.int32)
        found[: len(words)] = [number.get(w, 0) for w in words]
        parts.append(found)
    return np.concatenate(parts) if parts else np.zeros(0, np.int32), np.array(counts, np.int64)


def document_frequency(docs: DataFrame, number: dict[bytes, int]) -> np.ndarray:
    """Documents that have each template word; at 0 the number of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(number) + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                found, counts = _numbers(part.column("text").to_pylist(), number, 1)
                doc = np.repeat(np.arange(len(counts)), counts + 1)
                at = np.flatnonzero(found)
                pairs = np.unique(doc[at] * (len(number) + 1) + found[at])
                total += np.bincount(pairs % (len(number) + 1), minlength=len(number) + 1)
                total[0] += len(counts)
        yield pa.RecordBatch.from_pydict({"word": np.arange(len(total)), "n": total})

    counted = docs.select("text").mapInArrow(count, "word long, n long")
    rows = counted.groupBy("word").agg(F.sum("n").alias("n"))
    frequency = np.zeros(len(number) + 1, np.int64)
    for row in rows.collect():  # a row for each template word
        frequency[row["word"]] = row["n"]
    return frequency


@dataclass
class Compiled:
    """A template as word numbers, its rare words' positions, and its key phrases."""

    label: str
    words: np.ndarray
    rare: list[int]
    phrases: list[tuple[int, np.ndarray]]
    slack: int


def compile_template(t: Template, number: dict[bytes, int], idf: np.ndarray, slack: int) -> Compiled:
    words = np.array([number[w] for w in words_of(t.text)], np.int32)
    phrases = []
    for phrase in t.key_phrases:
        wanted = np.array([number[w] for w in words_of(phrase)], np.int32)
        places = [i for i in range(len(words) - len(wanted) + 1) if (words[i : i + len(wanted)] == wanted).all()]
        phrases.append((places[0], wanted))
    mandatory = {at + i for at, phrase in phrases for i in range(len(phrase))}
    order = sorted(mandatory, key=lambda i: (-idf[words[i]], i))
    return Compiled(t.label, words, order[:RARE_WORDS], phrases, slack)


def _near(places: np.ndarray, wanted: np.ndarray, slack: int) -> np.ndarray:
    """Whether any of the sorted ``places`` is within ``slack`` of each wanted one."""
    if not len(places):
        return np.zeros(len(wanted), bool)
    at = np.searchsorted(places, wanted - slack)
    return (at < len(places)) & (places[np.minimum(at, len(places) - 1)] <= wanted + slack)


def template_starts(found: np.ndarray, places: dict[int, np.ndarray], t: Compiled) -> np.ndarray:
    """Verified places where the template begins, sorted."""
    none = np.zeros(0, np.int64)
    lists = [places.get(int(t.words[r]), none) - r for r in t.rare]
    begins = np.unique(np.concatenate(lists)) if t.slack else lists[0]
    votes = sum(_near(x, begins, t.slack).astype(int) for x in lists)
    begins = begins[votes >= (len(lists) + 2) // 2 if t.slack else votes == len(lists)]
    for at, phrase in t.phrases:
        ok = np.zeros(len(begins), bool)
        for shift in range(-t.slack, t.slack + 1):
            start = begins + at + shift
            same = (start >= 0) & (start + len(phrase) <= len(found))
            for i, word in enumerate(phrase):
                same &= found[np.clip(start + i, 0, len(found) - 1)] == word
            ok |= same
        begins = begins[ok]
    return begins


def coverage(found: np.ndarray, begin: int, t: Compiled) -> float:
    """Share of the template's words that stand around ``begin``."""
    around = found[max(0, begin - t.slack) : begin + len(t.words) + t.slack]
    return float(np.isin(t.words, around).mean())


_SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


def scan_licenses(
    docs: DataFrame, base: tuple[Template, ...] = BASE, notices: tuple[Template, ...] = NOTICES
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per row.

    ``n_base`` counts all places of the base phrases, ``first_word`` and ``last_word`` are
    their smallest and largest start, null if there are none. ``labels`` are those of base
    phrases and of verified notices; ``score`` is 1 for a base phrase, else the largest share
    of a notice's words around its place, 0 without one. Null counts as the empty text, which
    has no labels (empty strings). Repeated rows are each scanned; other columns are ignored.
    """
    number = template_words(base + notices)
    frequency = document_frequency(docs, number)
    idf = np.log((1 + frequency[0]) / (1 + frequency.astype(float)))
    compiled = [compile_template(t, number, idf, 0) for t in base]
    compiled += [compile_template(t, number, idf, SLACK) for t in notices]
    n_base = len(base)
    wanted = np.unique([int(t.words[r]) for t in compiled for r in t.rare])
    gap = 1 + 2 * SLACK + max(len(t.words) for t in compiled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield scan(part)

    def scan(part: pa.RecordBatch) -> pa.RecordBatch:
        found, counts = _numbers(part.column("text").to_pylist(), number, gap)
        first = np.cumsum(counts + gap) - counts - gap
        places = {int(w): np.flatnonzero(found == w) for w in wanted}
        n = len(counts)
        starts: list[list[int]] = [[] for _ in range(n)]
        base_labels: list[set] = [set() for _ in range(n)]
        labels: list[set] = [set() for _ in range(n)]
        scores = np.zeros(n)
        for k, t in enumerate(compiled):
            begins = template_starts(found, places, t)
            owners = np.searchsorted(first, np.maximum(begins, 0) + t.slack, "right") - 1
            for begin, doc in zip(begins.tolist(), owners.tolist()):
                labels[doc].add(t.label)
                if k < n_base:
                    base_labels[doc].add(t.label)
                    starts[doc].append(begin - int(first[doc]))
                    scores[doc] = 1.0
                else:
                    scores[doc] = max(scores[doc], coverage(found, begin, t))
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                "n_words": pa.array(counts, pa.int64()),
                "n_base": pa.array([len(s) for s in starts], pa.int64()),
                "first_word": pa.array([min(s, default=None) for s in starts], pa.int64()),
                "last_word": pa.array([max(s, default=None) for s in starts], pa.int64()),
                "base_labels": pa.array([",".join(sorted(x)) for x in base_labels]),
                "labels": pa.array([",".join(sorted(x)) for x in labels]),
                "score": pa.array(scores),
            }
        )

    return docs.select("doc_id", "text").mapInArrow(run, _SCHEMA)
