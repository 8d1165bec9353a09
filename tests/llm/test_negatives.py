"""Hard negatives against all scores."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctmart.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>, node long, size string, scores int"


def plain(rows, every=3, positives=5, negatives=3, lowest=50, highest=95, scale=256):
    """All rows of the result by comparing each anchor with all rows."""
    usable = [
        (i, label, [math.floor(scale * x) for x in vec])
        for i, label, vec in rows
        if i is not None and label is not None and vec is not None and all(x is not None and math.isfinite(x) for x in vec)
    ]
    out = []
    for a, (anchor, label, vec) in enumerate(usable):
        if anchor % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(vec, v)), i, other == label)
            for b, (i, other, v) in enumerate(usable)
            if b != a and len(v) == len(vec)
        ]
        for s, i, _ in sorted(x for x in scored if x[2])[:positives]:
            fits = sorted(x for x in scored if not x[2] and lowest * -s <= 100 * -x[0] <= highest * -s)
            out += [(anchor, i, n + 1, x[1], -s, -x[0]) for n, x in enumerate(fits[:negatives])]
    return sorted(out)


def mined(spark, rows, every=3, **options):
    made = [(i, label, vec, 1, "x", 2) for i, label, vec in rows]
    df = spark.createDataFrame(made, SCHEMA).repartition(3)
    found = hard_negatives.mine(df, anchors=F.col("vec_id") % every == 0, **options).collect()
    return sorted((r[0], r[1], r[2], r[3], r[4], r[5]) for r in found)


def clustered(n, size, seed, spread=0.2, clusters=5, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, size))
    x = centres[rng.integers(0, clusters, n)] + spread * rng.standard_normal((n, size))
    return [(i, int(rng.integers(0, labels)), v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("spread", [0.01, 0.3, 3.0])
def test_many_blocks(spark, monkeypatch, spread):
    for name, value in {"BLOCK": 130, "QUERIES": 20, "QUERY_BLOCKS": 2, "LANE": 2, "SAMPLE": 100}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rows = clustered(700, 8, seed=int(spread * 100), spread=spread)
    found = mined(spark, rows)
    assert found == plain(rows) and found


def test_copies_ties_and_odd_rows(spark):
    rows = clustered(120, 4, seed=1, spread=0.4)
    rows += [(200 + i, i % 2, [1.0, 0.5, 0.0, -0.25]) for i in range(40)]  # copies of two labels
    rows += [(200, 0, [1.0, 0.5, 0.0, -0.25]), (201, 0, [0.0] * 4), (3, 1, rows[3][2]), (3, 1, rows[3][2])]
    rows += [(300 + i, i % 3, [0.0] * 4) for i in range(9)]  # zero vectors tie with all
    rows += [(400 + i, i % 2, [0.5 + i / 64, -0.5]) for i in range(12)] + [(499, 0, [])]  # of other lengths
    rows += [(None, 1, [1.0] * 4), (501, None, [1.0] * 4), (504, 1, None), (507, 1, [1.0, None, 0.0, 0.0])]
    rows += [(510, 1, [1.0, math.nan, 0.0, 0.0]), (513, 1, [1.0, math.inf, 0.0, 0.0]), (516, 2, [1 / 512] * 4)]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows, every=1, positives=2, negatives=4, lowest=0, highest=100) == plain(
        rows, every=1, positives=2, negatives=4, lowest=0, highest=100
    )


def test_few_rows_and_none(spark):
    rows = [(0, 1, [0.5, 0.5]), (1, 1, [0.5, 0.25]), (2, 2, [0.25, 0.25])]
    assert mined(spark, rows) == plain(rows) == [(0, 1, 1, 2, 128 * 128 + 128 * 64, 128 * 128)]
    assert mined(spark, rows[:1]) == [] and mined(spark, []) == []
    assert mined(spark, rows[:2]) == [] and mined(spark, [rows[0], rows[2]]) == []


@pytest.mark.parametrize("size", [30.0, 1e6, 9e6])
def test_scores_are_exact_whatever_their_size(spark, size):
    """Scores beyond single and double precision, in the last case close to 64 bits."""
    rng = np.random.default_rng(2)
    vectors = size * np.array([[1.0, 2.0, -1.0]]) + rng.standard_normal((60, 3)) / 16
    if size > 1e6:
        vectors[:, 1:] = rng.standard_normal((60, 2))
        vectors[:, 0] = np.where(np.arange(60) % 2, 9e6, 3e6)
    rows = [(i, i % 2, v.tolist()) for i, v in enumerate(vectors)]
    found = mined(spark, rows, lowest=1, highest=100)
    assert found == plain(rows, lowest=1, highest=100) and found


def test_few_vectors_of_many_tasks_reach_the_driver(spark):
    nodes = spark.range(20_000, numPartitions=40).selectExpr("id AS node", "id % 3 AS label", "array(id, -id) AS vec")
    sample = hard_negatives.sample_vectors(nodes, 50)
    assert len(sample) == 50 == len({v[0] for v in sample}) and max(v[0] for v in sample) > 10_000
    assert sample == hard_negatives.sample_vectors(nodes.repartition(7), 50)
    assert len(hard_negatives.sample_vectors(nodes.limit(9), 50)) == 9
    assert hard_negatives.sample_vectors(nodes.limit(0), 50) == []


def test_bounds_hold():
    rng = np.random.default_rng(7)
    for size in (2, 5, 64):
        vecs = np.floor(256 * rng.standard_normal((300, size)) * rng.choice([0, 0.1, 3], (300, 1)))
        directions = hard_negatives.directions_of({size: hard_negatives.fit_directions(list(vecs), 6)}, size, 9)
        angles, norms = hard_negatives.angles_to(directions, vecs)
        cuts = np.arange(0, 300, 7)
        low, high = (f.reduceat(angles, cuts) for f in (np.minimum, np.maximum))
        least, largest = (f.reduceat(norms, cuts) for f in (np.minimum, np.maximum))
        lower, upper = hard_negatives.score_bounds(angles, norms, low, high, least, largest)
        scores = vecs @ vecs.T
        assert (np.maximum.reduceat(scores, cuts, axis=1) <= upper).all()
        assert (np.minimum.reduceat(scores, cuts, axis=1) >= lower).all()


def test_windows_out_of_range_are_not_scored():
    """Of well separated clusters, only the windows of the query's own one overlap."""
    rng = np.random.default_rng(8)
    vecs = np.concatenate([1000 * np.eye(8)[[k]] + rng.standard_normal((64, 8)) for k in range(8)])
    angles, norms = hard_negatives.angles_to(hard_negatives.fit_directions(list(vecs), 16), vecs)
    cuts = np.arange(0, 512, 64)
    low, high = (f.reduceat(angles, cuts) for f in (np.minimum, np.maximum))
    least, largest = (f.reduceat(norms, cuts) for f in (np.minimum, np.maximum))
    _, upper = hard_negatives.score_bounds(angles, norms, low, high, least, largest)
    assert ((upper > 500_000) == (np.arange(512)[:, None] // 64 == np.arange(8))).all()
