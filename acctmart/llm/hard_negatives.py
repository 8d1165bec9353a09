"""Hard negatives by angular triangle filtering.

Each vector keeps its angles to a few reference directions. By the triangle inequality for
angles, the angle of two vectors lies between the difference and the sum of their angles to
any one direction. Cosines of these limits, multiplied by the norms and widened by more than
all rounding, bound the integer score. Vectors lie in blocks, ordered by their nearest
direction and the angle to it, and blocks are cut into small windows with an interval of
angles for every direction. A query's scores are worked out only in windows whose bounds
overlap the range of scores that it asks for; whole blocks without such a window are never
brought to it. Scores themselves are exact integers.

Rows of equal label and vector are one node with its least ids: more of them could never be
returned, so a vector that very many rows share is compared once. The anchors, a stated query
set, meet all nodes block by block in two rounds: for the positives, with a least score from
the anchor's own block, and for the negatives, with the ranges that the positives set.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctmart.llm.common import write_table
from acctmart.operators.joins import splittable_join
from acctmart.operators.positions import with_positions

#: Nodes that the directions are fitted to at most, and the number of directions.
SAMPLE, DIRECTIONS = 4096, 16
#: Nodes of a block and of a window, queries of a block, and blocks whose queries are put together.
BLOCK, WINDOW, QUERIES, QUERY_BLOCKS = 8192, 64, 2048, 16
#: Nodes of a block, evenly spaced, that are scored first to raise the scores asked for.
FIRST = 512
#: Query blocks whose heads meet those of the nodes' blocks in one task.
LANE = 256
LOWEST, HIGHEST = 1 - (1 << 63), (1 << 63) - 1


def usable_rows(embeddings: DataFrame, scale: int) -> DataFrame:
    """vec_id, label, vec of rows that take part, vec being floor(scale * component).

    A null id, label or vector and any null or non-finite component leave a row out.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite)
    vec = F.transform(x, lambda v: F.floor(v * float(scale)).cast("long"))
    return rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), vec.alias("vec"))


def distinct_nodes(rows: DataFrame, ids: int) -> DataFrame:
    """node, label, vec, ids, is_query: one row per label and vector, with its ``ids`` least ids."""
    least = Window.partitionBy("label", "vec", "is_anchor").orderBy("vec_id")
    few = rows.withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= ids)
    nodes = few.groupBy("label", "vec").agg(
        F.slice(F.sort_array(F.collect_list("vec_id")), 1, ids).alias("ids"), F.max("is_anchor").alias("is_query")
    )
    return nodes.select(F.monotonically_increasing_id().alias("node"), "label", "vec", "ids", "is_query")


def sample_vectors(nodes: DataFrame, most: int) -> list[list[int]]:
    """At most ``most`` vectors of nodes, those with the smallest hashes of a share of all.

    The share is such that a few times as many reach the driver, whatever the number of tasks:
    without it, every task would send ``most`` of its own.
    """
    share = F.lit(max(1, nodes.count() // (2 * most)))
    hashed = nodes.select("vec", F.xxhash64("label", "vec").alias("hash"), "node")
    some = hashed.where(F.pmod("hash", share) == 0).orderBy("hash", "node").limit(most)
    return [r["vec"] for r in some.select("vec").collect()]


def fit_directions(sample: list[np.ndarray], count: int, seed: int = 13) -> np.ndarray:
    """Unit directions near the centres of a sample's clusters. Any directions give right bounds."""
    x = np.array(sample, float)
    norms = np.linalg.norm(x, axis=1)
    x = x[norms > 0] / norms[norms > 0, None]
    if not x.size:
        return np.zeros((0, x.shape[1]))
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:count]]
    for _ in range(8):
        nearest = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centres)
    return centres


def directions_of(fitted: dict[int, np.ndarray], size: int, count: int) -> np.ndarray:
    """``count`` directions for vectors of this length: fitted ones, and random ones for the rest."""
    have = fitted.get(size, np.zeros((0, size)))
    more = np.random.default_rng([13, size]).standard_normal((count - len(have), size))
    return np.concatenate([have, more / np.maximum(np.linalg.norm(more, axis=1), 1e-9)[:, None]])


def angles_to(directions: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles of vectors to directions, and the vectors' norms. A zero vector is at a right angle."""
    x = vectors.astype(float)
    norms = np.linalg.norm(x, axis=1)
    cosines = x @ directions.T / np.maximum(norms, 1e-300)[:, None]
    return np.arccos(np.clip(cosines, -1, 1)).astype(np.float32), norms


def score_bounds(
    angles: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, largest: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest scores of each query with the vectors of each window.

    ``low`` and ``high`` are the windows' angles to the directions, ``least`` and ``largest``
    their norms. The bounds are widened by more than the rounding of angles and products.
    """
    apart = np.zeros((len(angles), len(low)), np.float32)
    within = np.full_like(apart, np.pi)
    for r in range(angles.shape[1]):
        a = angles[:, r, None]
        np.maximum(apart, np.maximum(low[:, r] - a, a - high[:, r]), out=apart)
        np.minimum(within, np.minimum(a + high[:, r], np.float32(2 * np.pi) - a - low[:, r]), out=within)
    top, bottom = np.cos(apart.astype(float)), np.cos(within.astype(float))
    slack = 1 + 1e-5 * norms[:, None] * largest
    upper = norms[:, None] * np.where(top > 0, largest, least) * top + slack
    lower = norms[:, None] * np.where(bottom > 0, least, largest) * bottom - slack
    return lower, upper


def largest_score(queries: np.ndarray, vectors: np.ndarray) -> int:
    """No score of these integer vectors is larger or more negative."""
    peaks = (max(-int(v.min(initial=0)), int(v.max(initial=0))) for v in (queries, vectors))
    return math.prod(peaks) * vectors.shape[1]


def exact_type(queries: np.ndarray, vectors: np.ndarray) -> type:
    """A type in which all scores of these integer vectors are exact."""
    bound = largest_score(queries, vectors)
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object


def _packed(values: np.ndarray) -> bytes:
    """Integers in the fewest bytes; the first byte is their size."""
    for kind in (np.int8, np.int16, np.int32, np.int64):
        if not values.size or (values.min() >= np.iinfo(kind).min and values.max() <= np.iinfo(kind).max):
            return bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes()
    raise OverflowError("beyond 64 bits")


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"i{data[0]}", offset=1).astype(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), len(values) // max(1, len(column)))


_FLOATS = np.float32
_NODE = "node long, label long, vec array<long>, ids array<long>, is_query boolean"
_HEAD = "head_low array<float>, head_high array<float>, head_least float, head_largest float"
_HEADS = [c.split()[0] for c in _HEAD.split(", ")]
_BLOCK = (
    "block long, size int, rows int, vecs binary, labels binary, nodes binary, ids binary, held binary, "
    f"low binary, high binary, least binary, largest binary, places array<int>, floors array<long>, {_HEAD}"
)
_QUERY_BLOCK = (
    "query_block long, query_size int, query_rows int, query_nodes binary, query_labels binary, query_vecs binary, "
    "query_angles binary, query_norms binary, asked binary, lowest long, highest long, "
    + _HEAD.replace("head", "query")
)
_MATCH = "node long, asked int, score long, vec_id long, own boolean"


def _arrow(ddl: str) -> pa.Schema:
    """The Arrow form of a schema of the simple types used here."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "float": pa.float32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = (f.split() for f in ddl.split(", "))
    return pa.schema([(k, pa.list_(kinds[t[6:-1]]) if t[:6] == "array<" else kinds[t]) for k, t in fields])


class Layout:
    """The directions of vectors of each length; broadcast."""

    def __init__(self, fitted: dict[int, np.ndarray], count: int) -> None:
        self.fitted, self.count = fitted, count

    def angles(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return angles_to(directions_of(self.fitted, vectors.shape[1], self.count), vectors)


def _head(angles: np.ndarray, norms: np.ndarray, name: str = "head") -> dict:
    """The intervals of angles and norms of a whole block."""
    values = angles.min(0).tolist(), angles.max(0).tolist(), float(norms.min()), float(norms.max())
    return dict(zip((f"{name}_low", f"{name}_high", f"{name}_least", f"{name}_largest"), values))


def _place(layout: Callable[[], Layout]):
    """Adds each vector's length, nearest direction and angle to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column("vec").offsets.to_numpy())
            for size in np.unique(lengths):
                some = batch.take(pa.array(np.flatnonzero(lengths == size)))
                angles, _ = layout().angles(_matrix(some.column("vec")))
                cell = angles.argmin(1)
                columns = [pa.array(np.full(some.num_rows, size, np.int32)), pa.array(cell.astype(np.int32))]
                columns.append(pa.array(angles[np.arange(len(cell)), cell]))
                yield pa.RecordBatch.from_arrays([*some.columns, *columns], [*some.schema.names, "size", "cell", "own"])

    return run


def floors_within(vecs: np.ndarray, labels: np.ndarray, places: np.ndarray, nth: int) -> np.ndarray:
    """The nth best score of the same label within the block, for each row at ``places``."""
    kind, found = exact_type(vecs, vecs), np.full(len(places), LOWEST, np.int64)
    x = vecs.astype(kind)
    for i in range(0, len(places), 256):
        some = places[i : i + 256]
        for label in np.unique(labels[some]):
            which, mine = np.flatnonzero(labels[some] == label), np.flatnonzero(labels == label)
            if len(mine) >= nth:
                scores = np.sort(x[some[which]] @ x[mine].T, axis=1)
                found[i + which] = scores[:, len(mine) - nth].astype(np.int64)
    return found


def _blocks(layout: Callable[[], Layout], nth: int):
    """A block of nodes of consecutive places, with windows of angles and norms."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        batch = table.sort_by("place").combine_chunks().to_batches()[0]
        vecs, labels, ids = _matrix(batch.column("vec")), batch.column("label").to_numpy(), batch.column("ids")
        angles, norms = layout().angles(vecs)
        cuts = np.arange(0, len(vecs), WINDOW)
        queries = np.flatnonzero(batch.column("is_query").to_numpy(zero_copy_only=False))
        windows = {
            "low": np.minimum.reduceat(angles, cuts),
            "high": np.maximum.reduceat(angles, cuts),
            "least": np.minimum.reduceat(norms, cuts),
            "largest": np.maximum.reduceat(norms, cuts),
        }
        row = {
            "block": batch.column("place")[0].as_py(),
            "size": vecs.shape[1],
            "rows": len(vecs),
            "vecs": _packed(vecs),
            "labels": _packed(labels),
            "nodes": _packed(batch.column("node").to_numpy()),
            "ids": _packed(ids.flatten().to_numpy()),
            "held": _packed(np.diff(ids.offsets.to_numpy())),
            "places": queries.tolist(),
            "floors": floors_within(vecs, labels, queries, nth).tolist(),
        }
        row |= {k: v.astype(_FLOATS).tobytes() for k, v in windows.items()} | _head(angles, norms)
        return pa.Table.from_pylist([row], _arrow(_BLOCK))

    return run


def _query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The query nodes of blocks, each with the least score of its positives."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            at = np.array(row["places"], np.int64)
            vecs = _unpacked(row["vecs"]).reshape(row["rows"], row["size"])[at]
            ends = pa.array(np.arange(len(at) + 1) * row["size"], pa.int32())
            columns = {
                "node": _unpacked(row["nodes"])[at],
                "label": _unpacked(row["labels"])[at],
                "vec": pa.ListArray.from_arrays(ends, pa.array(vecs.reshape(-1), pa.int64())),
                "size": pa.array([row["size"]] * len(at), pa.int32()),
                "block": pa.array([row["block"]] * len(at), pa.int64()),
                "place": pa.array(row["places"], pa.int32()),
                "floor": pa.array(row["floors"], pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(columns)


_QUERY = "node long, label long, vec array<long>, size int, block long, place int, floor long"


def _query_blocks(layout: Callable[[], Layout], most: int):
    """Blocks of ``most`` queries; ``lows`` and ``highs`` are the ranges each one asks for."""

    def block(batch: pa.RecordBatch) -> dict:
        vecs, lows, highs = (batch.column(k) for k in ("vec", "lows", "highs"))
        vecs, lows, highs = _matrix(vecs), lows.to_pylist(), highs.to_pylist()
        angles, norms = layout().angles(vecs)
        width = max(map(len, lows))
        # Shorter lists are filled up with a range that nothing is in.
        asked = [[x + [fill] * (width - len(x)) for x in xs] for xs, fill in ((lows, HIGHEST), (highs, LOWEST))]
        return {
            "query_block": batch.column("node")[0].as_py(),
            "query_size": vecs.shape[1],
            "query_rows": len(vecs),
            "query_nodes": _packed(batch.column("node").to_numpy()),
            "query_labels": _packed(batch.column("label").to_numpy()),
            "query_vecs": _packed(vecs),
            "query_angles": angles.astype(_FLOATS).tobytes(),
            "query_norms": norms.astype(_FLOATS).tobytes(),
            "asked": _packed(np.array(asked, np.int64)),
            "lowest": min(x for xs in lows for x in xs),
            "highest": max(x for xs in highs for x in xs),
        } | _head(angles, norms, "query")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        batch = table.sort_by([("block", "ascending"), ("place", "ascending")]).combine_chunks().to_batches()[0]
        rows = [block(batch.slice(i, most)) for i in range(0, batch.num_rows, most)]
        return pa.Table.from_pylist(rows, _arrow(_QUERY_BLOCK))

    return run


def _best(owner: np.ndarray, score: np.ndarray, vec_id: np.ndarray, keep: int) -> np.ndarray:
    """The places of each owner's ``keep`` first entries, by score and then the smaller id."""
    order = np.lexsort((vec_id, -score, owner))
    starts = np.flatnonzero(np.append(True, np.diff(owner[order]) != 0)) if len(order) else order
    nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[nth < keep]


def match_blocks(row: dict, same_label: bool, keep: int) -> dict[str, np.ndarray]:
    """The first ``keep`` entries of a block for each query and each range that it asks for.

    ``row`` holds a block of nodes and one of queries. ``same_label`` tells whether nodes of
    the query's label or all others are wanted.
    """
    n, m, size = row["rows"], row["query_rows"], row["size"]
    vecs, asks = _unpacked(row["vecs"]).reshape(n, size), _unpacked(row["query_vecs"]).reshape(m, size)
    labels, wanted = _unpacked(row["labels"]), _unpacked(row["query_labels"])
    nodes, mine = _unpacked(row["nodes"]), _unpacked(row["query_nodes"])
    lows, highs = _unpacked(row["asked"]).reshape(2, m, -1)
    floats = lambda k, *shape: np.frombuffer(row[k], _FLOATS).reshape(shape)
    kind = exact_type(asks, vecs)
    x, q = vecs.astype(kind), asks.astype(kind)
    beyond = 1 + largest_score(asks, vecs)
    if kind is not object:
        lows, highs = (np.clip(v, -beyond, beyond) for v in (lows, highs))
    lows, highs = lows.astype(kind), highs.astype(kind)

    def scores(queries: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        agree = (wanted[queries, None] == labels[some]) == same_label
        return q[queries] @ x[some].T, agree

    # Scores of some nodes raise what is asked for: keep of them are in the range already.
    everyone, first = np.arange(m), np.arange(0, n, max(1, n // FIRST))
    found, agree = scores(everyone, first)
    raised = lows.copy()
    if len(first) >= keep:
        for j in range(lows.shape[1]):
            inside = agree & (found >= lows[:, j, None]) & (found <= highs[:, j, None])
            nth = np.sort(np.where(inside, found, -beyond), axis=1)[:, -keep]
            raised[:, j] = np.maximum(lows[:, j], nth)
    cuts = range(0, n, WINDOW)
    angles, norms = floats("query_angles", m, -1), floats("query_norms", m).astype(float)
    windows = [floats(k, len(cuts), -1) for k in ("low", "high")]
    windows += [floats(k, len(cuts)).astype(float) for k in ("least", "largest")]
    lower, upper = score_bounds(angles, norms, *windows)
    some = lows <= highs
    need = np.where(some, raised, np.inf).min(1).astype(float), np.where(some, highs, -np.inf).max(1).astype(float)
    overlap = (upper >= need[0][:, None]) & (lower <= need[1][:, None])
    entries: list[tuple] = []
    for w, cut in enumerate(cuts):
        queries = np.flatnonzero(overlap[:, w])
        if not len(queries):
            continue
        rows = np.arange(cut, min(n, cut + WINDOW))
        found, agree = scores(queries, rows)
        for j in range(lows.shape[1]):
            a, b = np.nonzero(agree & (found >= raised[queries, j, None]) & (found <= highs[queries, j, None]))
            entries.append((queries[a], np.full(len(a), j), rows[b], found[a, b]))
    query, asked, at, score = (
        np.concatenate([e[k] for e in entries]) if entries else np.zeros(0, np.int64) for k in range(4)
    )
    score = np.array([int(v) for v in score], np.int64) if kind is object else score.astype(np.int64)
    # Each node stands for its rows of least ids.
    held = _unpacked(row["held"])
    copies, begin = np.minimum(held, keep)[at], (np.cumsum(held) - held)[at]
    entry = np.repeat(np.arange(len(at)), copies)
    nth = np.arange(len(entry)) - np.repeat(np.cumsum(copies) - copies, copies)
    vec_id = _unpacked(row["ids"])[begin[entry] + nth]
    owner = query[entry] * lows.shape[1] + asked[entry]
    best = _best(owner, score[entry], vec_id, keep)
    entry, vec_id = entry[best], vec_id[best]
    return {
        "node": mine[query[entry]],
        "asked": asked[entry].astype(np.int32),
        "score": score[entry],
        "vec_id": vec_id,
        "own": nodes[at[entry]] == mine[query[entry]],
    }


def _apart() -> Column:
    """The least angle that a vector of one block and one of the other can be apart."""
    sides = ("head_low", "query_high"), ("query_low", "head_high")
    gaps = (F.array_max(F.zip_with(*side, lambda a, b: a - b)) for side in sides)
    return F.greatest(F.lit(0.0), *gaps)


def _within() -> Column:
    """The largest angle that they can be apart."""
    most = F.array_min(F.zip_with("head_high", "query_high", lambda a, b: a + b))
    least = F.array_max(F.zip_with("head_low", "query_low", lambda a, b: a + b))
    return F.least(F.lit(math.pi), most, F.lit(2 * math.pi) - least)


def overlapping_blocks(blocks: DataFrame, query_blocks: DataFrame) -> DataFrame:
    """query_block, block: pairs of blocks whose score bounds overlap the ranges asked for.

    Only the blocks' heads meet here, the queries' in lanes of LANE blocks, one task each.
    """
    lanes = -(-query_blocks.count() // LANE)
    lane = F.pmod(F.xxhash64("query_block"), F.lit(max(1, lanes))).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(max(1, lanes) - 1)))
    bounds = [c.replace("head", "query") for c in _HEADS]
    asked = query_blocks.select("query_block", "query_size", "lowest", "highest", *bounds, lane.alias("lane"))
    heads = blocks.select("block", "size", *_HEADS, every.alias("lane"))
    largest, least = F.col("head_largest") * F.col("query_largest"), F.col("head_least") * F.col("query_least")
    top, bottom, slack = F.cos(_apart()), F.cos(_within()), 1 + 1e-5 * largest
    upper = F.when(top > 0, largest).otherwise(least) * top + slack
    lower = F.when(bottom > 0, least).otherwise(largest) * bottom - slack
    met = heads.join(asked, (heads["lane"] == asked["lane"]) & (heads["size"] == asked["query_size"]))
    return met.where((upper >= F.col("lowest")) & (lower <= F.col("highest"))).select("query_block", "block")


def best_matches(blocks: DataFrame, query_blocks: DataFrame, same_label: bool, keep: int) -> DataFrame:
    """node, asked, score, vec_id, own: the first ``keep`` entries of each query and range.

    Pairs of blocks are dealt out one at a time. Entries are cut to ``keep`` for each pair,
    again before the shuffle and again after it.
    """

    def match(key: tuple, table: pa.Table) -> pa.Table:
        found = match_blocks(table.to_pylist()[0], same_label, keep)
        return pa.table({k: pa.array(v) for k, v in found.items()}, _arrow(_MATCH))

    pairs = overlapping_blocks(blocks, query_blocks)
    met = pairs.join(blocks.drop("places", "floors", *_HEADS), "block").join(query_blocks, "query_block")
    found = met.groupBy("query_block", "block").applyInArrow(match, _MATCH)
    order = Window.partitionBy("node", "asked").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= keep)


def _percent(value: Column, percent: int) -> Column:
    """So many percent of an integer, rounded down, without a product beyond 64 bits."""
    rest = F.pmod(value, F.lit(100))
    hundreds = F.call_function("div", value - rest, F.lit(100))
    return hundreds * percent + F.call_function("div", rest * percent, F.lit(100))


def mine(
    embeddings: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    lowest: int = 50,
    highest: int = 95,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``embeddings`` has vec_id, embedding and label; ``anchors`` is a condition on vec_id. Scores
    are integer inner products of floor(scale * component). An anchor's positives are its
    first other rows of the same label, by score and then the smaller id, and each one's
    negatives the first rows of another label whose score is from ``lowest`` to ``highest``
    percent of the positive's. Fewer are returned where there are fewer.

    Rows with a null id, label, vector or component, or a non-finite one, take no part. Only
    vectors of one length have a score with each other. Repeated rows are rows of their own;
    of an anchor's copies that agree in id, label and vector, one is the anchor itself. An
    empty table gives no rows; other columns are ignored. Components and scores beyond 64
    bits end the job.
    """
    spark = embeddings.sparkSession
    rows = usable_rows(embeddings, scale).withColumn("is_anchor", F.coalesce(anchors, F.lit(False)))
    most = positives + 1  # with the anchor itself
    nodes, _ = write_table(distinct_nodes(rows, most), "nodes")
    by_size: dict[int, list] = {}
    for vec in sample_vectors(nodes, SAMPLE):
        by_size.setdefault(len(vec), []).append(vec)
    fitted = {size: fit_directions(vecs, DIRECTIONS) for size, vecs in by_size.items()}
    shared = spark.sparkContext.broadcast(Layout(fitted, DIRECTIONS))
    layout = lambda: shared.value
    placed = nodes.mapInArrow(_place(layout), _NODE + ", size int, cell int, own float")
    # A node's number parts vectors that are alike.
    order = [F.col(c) for c in ("size", "cell", "own", "node")]
    numbered = with_positions(placed, order, "place").withColumn("nth", F.floor(F.col("place") / BLOCK))
    blocks = numbered.groupBy("size", "nth").applyInArrow(_blocks(layout, most), _BLOCK)
    blocks, _ = write_table(blocks, "blocks")
    queries, _ = write_table(blocks.mapInArrow(_query_rows, _QUERY), "queries")

    def asking(df: DataFrame) -> DataFrame:
        some = df.withColumn("nth", F.floor(F.col("block") / (QUERY_BLOCKS * BLOCK)))
        made = some.groupBy("size", "nth").applyInArrow(_query_blocks(layout, QUERIES), _QUERY_BLOCK)
        return write_table(made, "asked")[0]

    first = asking(queries.withColumns({"lows": F.array("floor"), "highs": F.array(F.lit(HIGHEST))}).drop("floor"))
    near = best_matches(blocks, first, same_label=True, keep=most)
    entry = F.struct((-F.col("score")).alias("down"), "vec_id", "own", "score")
    near = near.groupBy("node").agg(F.sort_array(F.collect_list(entry)).alias("near"))  # most entries of each
    near, _ = write_table(near, "positives")
    # The scores of the positives of any of a node's anchors: a node of one row is none of its own.
    others = F.filter("near", lambda e: ~e.own | (F.size(F.filter("near", lambda o: o.own)) > 1))
    score = F.array_distinct(F.transform(others, lambda e: e.score))
    asked = queries.drop("floor").join(near.select("node", score.alias("scores")), "node").where(F.size("scores") > 0)
    low = F.transform("scores", lambda s: -_percent(-s, lowest))
    high = F.transform("scores", lambda s: _percent(s, highest))
    second = asking(asked.withColumns({"lows": low, "highs": high}).drop("scores"))
    far = best_matches(blocks, second, same_label=False, keep=negatives)
    entry = F.struct("asked", (-F.col("score")).alias("down"), F.col("vec_id").alias("negative_id"))
    far = far.groupBy("node").agg(F.sort_array(F.collect_list(entry)).alias("far"))
    found = near.join(far, "node").withColumn("scores", score)  # a bounded row for each query
    keys = nodes.where("is_query").select("node", "label", "vec")
    own = splittable_join(rows.where("is_anchor"), keys, ["label", "vec"]).select(F.col("vec_id").alias("anchor_id"), "node")
    full = splittable_join(own, found, ["node"], lane=1)
    me = F.array_position(F.transform("near", lambda e: e.own & (e.vec_id == F.col("anchor_id"))), True)
    full = full.withColumn("me", me)
    rest = F.filter("near", lambda e, i: i + 1 != F.col("me"))
    pair = full.select("anchor_id", "scores", "far", F.explode(F.slice(rest, 1, positives)).alias("positive"))
    at = (F.array_position("scores", F.col("positive.score")) - 1).cast("int")
    pair = pair.withColumn("at", at)
    mined = pair.select(
        "anchor_id",
        F.col("positive.vec_id").alias("positive_id"),
        F.col("positive.score").alias("positive_score"),
        F.posexplode(F.filter("far", lambda e: e.asked == F.col("at"))).alias("place", "negative"),
    )
    return mined.select(
        "anchor_id",
        "positive_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("negative.negative_id").alias("negative_id"),
        "positive_score",
        (-F.col("negative.down")).alias("negative_score"),
    )
