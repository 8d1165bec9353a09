"""Text quality by a byte-level convolutional network, in numpy.

The bytes of a whole text are laid out in overlapping chunks. Learned filters slide over each
chunk's embedded bytes, and each filter's largest response stands for the chunk. Mean,
largest and smallest of these over all chunks go through a small hidden layer to one
probability. Training follows gradients through the largest responses only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctmart.llm.common import free_name, held_out, sample_texts

#: Chunks of this many bytes; neighbours share OVERLAP bytes.
CHUNK, OVERLAP = 512, 16
EMBED, WIDTH, STRIDE, FILTERS, HIDDEN = 6, 8, 2, 32, 16
#: Training: documents of each label at most, chunks of each, and passes and steps at least.
TRAIN_PER_LABEL, TRAIN_CHUNKS, EPOCHS, STEPS = 1500, 8, 6, 600
#: Chunks that are scored at a time.
AT_ONCE = 512
_STEPS = (CHUNK - WIDTH) // STRIDE + 1


def chunk_matrix(text: str | None) -> np.ndarray:
    """A text's bytes in rows of overlapping chunks, the last one filled up with zeros."""
    data = (text or "").encode()
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(data) - OVERLAP) // step))
    flat = np.zeros((n - 1) * step + CHUNK, np.uint8)
    flat[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.as_strided(flat, (n, CHUNK), (step, 1)).copy()


def new_model(seed: int = 10) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
    return {
        "embed": normal(256, EMBED, s=0.5),
        "filters": normal(WIDTH * EMBED, FILTERS, s=0.2),
        "bias": np.zeros(FILTERS, np.float32),
        "w1": normal(3 * FILTERS, HIDDEN, s=0.15),
        "b1": np.zeros(HIDDEN, np.float32),
        "w2": normal(HIDDEN, s=0.3),
        "b2": np.zeros(1, np.float32),
    }


def _windows(model: dict, chunks: np.ndarray) -> np.ndarray:
    """Embedded windows: chunks x places x (bytes of a window x embedding)."""
    flat = model["embed"][chunks].reshape(len(chunks), CHUNK * EMBED)
    return np.lib.stride_tricks.sliding_window_view(flat, WIDTH * EMBED, axis=1)[:, :: STRIDE * EMBED]


def responses(model: dict, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's largest response in each chunk before the bias, and its place."""
    x = np.ascontiguousarray(_windows(model, chunks)).reshape(-1, WIDTH * EMBED)
    out = (x @ model["filters"]).reshape(len(chunks), _STEPS, FILTERS)
    at = out.argmax(axis=1)
    return np.take_along_axis(out, at[:, None, :], 1)[:, 0], at


def largest(model: dict, chunks: np.ndarray) -> np.ndarray:
    x = np.ascontiguousarray(_windows(model, chunks)).reshape(-1, WIDTH * EMBED)
    return (x @ model["filters"]).reshape(len(chunks), _STEPS, FILTERS).max(axis=1)


def _pool(peaks: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean, largest and smallest chunk response of each document."""
    return np.concatenate(
        [
            np.add.reduceat(peaks, starts) / counts[:, None],
            np.maximum.reduceat(peaks, starts),
            np.minimum.reduceat(peaks, starts),
        ],
        axis=1,
    )


def _logits(model: dict, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(pooled @ model["w1"] + model["b1"])
    return hidden @ model["w2"] + model["b2"][0], hidden


def score_texts(model: dict, texts: list[str | None]) -> np.ndarray:
    """One probability for each whole text."""
    rows = [chunk_matrix(t) for t in texts]
    if not rows:
        return np.zeros(0)
    counts = np.array([len(r) for r in rows])
    chunks = np.concatenate(rows)
    peaks = np.concatenate([largest(model, chunks[i : i + AT_ONCE]) for i in range(0, len(chunks), AT_ONCE)])
    peaks = np.maximum(peaks + model["bias"], 0)
    logits, _ = _logits(model, _pool(peaks, np.cumsum(counts) - counts, counts))
    return 1 / (1 + np.exp(-np.clip(logits + model.get("shift", 0.0), -30, 30).astype(float)))


def _gradients(model: dict, rows: list[np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
    counts = np.array([len(r) for r in rows])
    starts, owner = np.cumsum(counts) - counts, np.repeat(np.arange(len(rows)), counts)
    chunks = np.concatenate(rows)
    raw, at = responses(model, chunks)
    peaks = np.maximum(raw + model["bias"], 0)
    pooled = _pool(peaks, starts, counts)
    logits, hidden = _logits(model, pooled)
    d = ((1 / (1 + np.exp(-logits))) - y).astype(np.float32) / len(y)
    g = {"w2": hidden.T @ d, "b2": d.sum(keepdims=True)}
    dh = np.outer(d, model["w2"]) * (1 - hidden**2)
    g |= {"w1": pooled.T @ dh, "b1": dh.sum(0)}
    mean, top, low = np.split(dh @ model["w1"].T, 3, axis=1)
    dp = mean[owner] / counts[owner, None]
    for extreme, d_extreme in ((pooled[:, FILTERS : 2 * FILTERS], top), (pooled[:, 2 * FILTERS :], low)):
        # Chunks that tie for the largest or smallest response share the gradient.
        tied = (peaks == extreme[owner]).astype(np.float32)
        dp += tied / np.add.reduceat(tied, starts)[owner] * d_extreme[owner]
    dp *= peaks > 0
    # Only the window of the largest response has a gradient, one for each chunk and filter.
    begin = at * STRIDE
    used = chunks[np.arange(len(chunks))[:, None, None], begin[:, :, None] + np.arange(WIDTH)]
    embedded = model["embed"][used].reshape(len(chunks), FILTERS, WIDTH * EMBED)
    g["filters"] = np.einsum("nf,nfk->kf", dp, embedded)
    g["bias"] = dp.sum(0)
    back = (dp[:, :, None] * model["filters"].T[None]).reshape(-1, EMBED)
    embed = np.empty_like(model["embed"])
    for k in range(EMBED):
        embed[:, k] = np.bincount(used.reshape(-1), back[:, k], 256)
    g["embed"] = embed
    return g


def train(samples: list[tuple[str, int]], prior: float, epochs: int = EPOCHS, seed: int = 10) -> dict:
    """A model for (text, 0 or 1) samples; ``prior`` is label 1's share of all labels.

    Without samples of both labels the model gives every text the prior.
    """
    model, rng = new_model(seed), np.random.default_rng(seed)
    y = np.array([label for _, label in samples], np.float32)
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    log_odds = np.log(prior / (1 - prior))
    if len(set(y.tolist())) < 2:
        model["w2"][:] = 0
        return model | {"shift": log_odds}
    rows = [chunk_matrix(t) for t, _ in samples]
    mean = {k: np.zeros_like(v) for k, v in model.items()}
    square = {k: np.zeros_like(v) for k, v in model.items()}
    step = 0
    epochs = max(epochs, -(-STEPS // -(-len(rows) // 32)))
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), 32):
            some, step = order[i : i + 32], step + 1
            # Of long training texts some neighbouring chunks, another stretch each time.
            begins = [rng.integers(0, max(1, len(rows[j]) - TRAIN_CHUNKS + 1)) for j in some]
            batch = [rows[j][b : b + TRAIN_CHUNKS] for j, b in zip(some, begins)]
            rate = 0.004 / (1 + EPOCHS * epoch / epochs)
            for k, g in _gradients(model, batch, y[some]).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                size = np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7
                model[k] -= (rate * mean[k] / (1 - 0.9**step) / size).astype(np.float32)
    share = float(y.mean())
    return model | {"shift": log_odds - np.log(share / (1 - share))}


def train_on(docs: DataFrame, labels: DataFrame, label: str, **options) -> dict:
    """A model from a bounded sample of the labelled rows that are not held out."""
    usable = labels.where(~held_out() & F.col(label).isin(0, 1))
    share = usable.agg(F.avg(label).alias("share")).first()["share"]
    samples = sample_texts(docs, usable, label, TRAIN_PER_LABEL)
    return train(samples, 0.5 if share is None else share, **options)


def score_column(docs: DataFrame, model: dict, text: str = "text") -> Column:
    """The model's probability for each whole text; a null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values, some, size = [], [], 0
            for t in texts:
                some.append(t)
                size += len(t or "")
                if size > 1 << 20:
                    values.append(score_texts(shared.value, some))
                    some, size = [], 0
            values.append(score_texts(shared.value, some))
            yield pd.Series(np.concatenate(values))

    return score(F.coalesce(F.col(text), F.lit("")))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``.

    Null and empty texts have the score of a chunk of zeros. Repeated rows are each scored;
    labels with null ids or values are not learned from; other columns are ignored.
    """
    model = train_on(docs, labels, "quality")
    return (
        docs.select("doc_id", held_out().alias("held_out"), score_column(docs, model).alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def without_rejected(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with all their columns."""
    model = train_on(docs, labels, "quality")
    name = free_name(docs, "_score")
    scored = docs.withColumn(name, score_column(docs, model))
    return scored.where(F.col(name) >= threshold).select(*docs.columns)
