"""Exact Jaccard join of word n-gram sets by a token-group matrix.

1. Each text becomes the set of its shingles' 64-bit hashes. Shingles are ordered from rare to
   frequent by counts, over all documents, in a hashed table of fixed size; any total order
   gives right results, so that hash collisions only cost time.
2. Documents are sorted by the least hash of their set, which puts similar ones side by side.
   Identical sets collapse to one representative. Within a run of equal least hashes each
   representative is compared with the run's first members and joins the first one that it
   links to: a group of linked documents. Groups that share another least hash are brought
   together by comparing one or two members of each with the first document that has it. The
   matrix holds, for each token of a group's union
   that any link to a member must go through, a cell with bounds of its members' sizes and of
   the tokens they have after it.
3. Documents query the matrix with the tokens that any link must go through. A cell whose
   bounds allow the needed overlap makes its group qualify. Queries of documents that already
   belong to the group are left out, so that copies of one text cost no pairs. Frequent
   tokens carry more, to tell near misses apart: a token that comes after the same token in
   the query and in all the cell's members is not the first one in common and is left out;
   and sets differ at least by the number of places in which their bitmaps differ, which
   bounds the overlap with a group of one member.
4. Qualifying groups are opened in two steps: first one promising pair for each two groups,
   since a link makes one group of them, then every pair whose groups are still apart. Each
   pair is verified on the whole sets. Components follow from the links.

The tokens a link must go through: with at least 85 % of the union in common, the first token
in common, in the order above, lies in the first n - ceil(0.85 n) + 1 tokens of either set,
and in the first n - ceil(2 * 85 / 185 n) + 1 of the smaller one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctmart.llm.common import give_back, keep_rows, slices, text_key, write_table
from acctmart.operators.joins import splittable_join

SHINGLE, PERCENT = 4, 85
#: Bits of the table of hashed shingle counts: 2**21 counts of four bytes.
SKETCH_BITS = 21
_BLOCK = 1 << 12
#: First members of a run that later ones are compared with. Links it misses are found later.
LEADERS = 32
#: Bits of a set's bitmap; a token is frequent from FREQUENT times the mean count on.
BITS, FREQUENT = 1024, 3
#: Further least hashes by which groups that came apart are brought together.
SIGNS = 3
#: Word hashes that a task keeps; it starts anew beyond them.
_CACHED = 100_000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_SIGN_FACTORS = np.random.default_rng(5).integers(0, 1 << 63, SIGNS, dtype=np.uint64) | np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; of fewer words, one for all of them."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_HASHES) > _CACHED:
        _HASHES.clear()
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    mixed = np.full(n, width, np.uint64)
    for i in range(width):
        mixed = (mixed ^ h[i : i + n]) * _M1
        mixed ^= mixed >> np.uint64(29)
    mixed *= _M2
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = overlap(a, b)
    return 100 * common >= percent * (len(a) + len(b) - common)


def bitmap(tokens: np.ndarray) -> list[int]:
    """For each of BITS places whether an odd number of the set's tokens fall on it."""
    places = ((tokens * _M1) >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)
    odd = np.bincount(places, minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def query_length(n: int, percent: int = PERCENT) -> int:
    """Tokens of a set of ``n`` that it queries the matrix with."""
    return n - -(-percent * n // 100) + 1


def index_length(n: int, percent: int = PERCENT) -> int:
    """Tokens of a set of ``n`` that stand for it in the matrix, for queries not smaller."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


def _features(width: int):
    """Rows of sets, and rows with the task's shingle counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for part in slices(batch, "text"):
                packed, sizes, prints, least, signs = [], [], [], [], []
                for text in part.column("text").to_pylist():
                    tokens = shingle_set(text, width)
                    np.add.at(counts, (tokens & np.uint64(len(counts) - 1)).astype(np.int64), 1)
                    packed.append(compress(text.encode()) if len(tokens) else None)
                    sizes.append(len(tokens))
                    prints.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                    lows = [int((tokens * f).min()) - (1 << 63) for f in (_M2, *_SIGN_FACTORS) if len(tokens)]
                    least.append(lows[0] if lows else 0)
                    signs.append(lows[1:])
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("doc_id"),
                        part.column("key"),
                        pa.array(packed, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.array(prints, pa.binary()),
                        pa.array(least, pa.int64()),
                        pa.array(signs, pa.list_(pa.int64())),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.binary()),
                    ],
                    _FEATURE_NAMES,
                )
        give_back(_HASHES)
        blocks = [i for i in range(len(counts) // _BLOCK) if counts[i * _BLOCK : (i + 1) * _BLOCK].any()]
        n = len(blocks)
        longs, data, lists = (pa.nulls(n, t) for t in (pa.int64(), pa.binary(), pa.list_(pa.int64())))
        small = [counts[i * _BLOCK : (i + 1) * _BLOCK].astype("<i4").tobytes() for i in blocks]
        own = [pa.array(blocks, pa.int32()), pa.array(small, pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [longs, longs, longs, data, longs, data, longs, lists, *own], _FEATURE_NAMES
        )

    return run


_FEATURES = (
    "row long, doc_id long, key long, packed binary, n long, print binary, least long, "
    "signs array<long>, block int, counts binary"
)
_FEATURE_NAMES = ["row", "doc_id", "key", "packed", "n", "print", "least", "signs", "block", "counts"]


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the count blocks that come to this task, one row for each."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sums[block] = sums.get(block, 0) + np.frombuffer(data, "<i4").astype(np.int64)
    rows = [np.minimum(s, (1 << 31) - 1).astype("<i4").tobytes() for s in sums.values()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array(rows, pa.binary())], ["block", "counts"]
    )


def shingle_counts(features: DataFrame) -> np.ndarray:
    """The table of hashed counts over all documents; its size does not depend on theirs."""
    blocks = features.where("block IS NOT NULL").select("block", "counts")
    summed = blocks.repartition("block").mapInArrow(_sum_blocks, "block int, counts binary")
    table = np.zeros(1 << SKETCH_BITS, np.int32)
    for row in summed.collect():
        table[row["block"] * _BLOCK : (row["block"] + 1) * _BLOCK] = np.frombuffer(row["counts"], "<i4")
    return table


_GROUPS = (
    "row long, doc_id long, key long, n long, print binary, member_of long, "
    "frequent_from int, signs array<long>, bits array<long>, "
    "tokens array<long>, "
    "cell_tokens array<long>, cell_least array<long>, cell_most array<long>, cell_after array<long>, "
    "cell_row array<long>, cell_before array<long>"
)
_LONGS = pa.list_(pa.int64())
_CELL = ("cell_least", "cell_most", "cell_after", "cell_row", "cell_before")
_GROUP_SCHEMA = pa.schema(
    [(c, pa.int64()) for c in ("row", "doc_id", "key", "n")]
    + [("print", pa.binary()), ("member_of", pa.int64()), ("frequent_from", pa.int32())]
    + [(c, _LONGS) for c in ("signs", "bits", "tokens", "cell_tokens", *_CELL)]
)


class _Run:
    """A run of sets with the same least hash: its leaders and its groups' cells."""

    def __init__(self) -> None:
        self.leaders: list[tuple[int, np.ndarray]] = []
        self.cells: dict[int, dict[int, list[int]]] = {}
        #: Of groups of one member its bitmap and the place of its first frequent token.
        self.single: dict[int, dict] = {}

    def group(self, row: int, tokens: np.ndarray, percent: int) -> int:
        for leader, other in self.leaders:
            if linked(tokens, other, percent):
                return leader
        if len(self.leaders) < LEADERS:
            self.leaders.append((row, tokens))
        return row

    def add(self, group: int, row: int, n: int, indexed: list[int], more: dict) -> None:
        if group in self.cells:
            self.single.pop(group, None)
        else:
            self.single[group] = more
        cells = self.cells.setdefault(group, {})
        for place, token in enumerate(indexed):
            after = n - place - 1
            before = indexed[place - 1] if place and place >= more["frequent_from"] else None
            cell = cells.get(token)
            if cell is None:
                cells[token] = [n, n, after, row, before]
            else:
                cell[0], cell[1] = min(cell[0], n), max(cell[1], n)
                if after > cell[2]:
                    cell[2:4] = [after, row]
                if before != cell[4]:
                    cell[4] = None  # the members do not agree

    def rows(self) -> list[dict]:
        return [
            {"member_of": group, "cell_tokens": list(cells)}
            | self.single.get(group, {})
            | {name: [c[i] for c in cells.values()] for i, name in enumerate(_CELL)}
            for group, cells in self.cells.items()
        ]


def _group_rows(shared, width: int, percent: int):
    """Sorted sets to rows of documents with their group, and rows of the groups' cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        frequent = FREQUENT * table.mean() + 8
        unpack = zstandard.ZstdDecompressor().decompress
        run, least, last_print, group, out = _Run(), None, None, None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["least"] != least:
                    out += run.rows()
                    run, least, last_print = _Run(), r["least"], None
                doc = {k: r[k] for k in ("row", "doc_id", "key", "n", "print")}
                if r["print"] != last_print:
                    last_print = r["print"]
                    tokens = shingle_set(unpack(r["packed"]).decode(), width)
                    group = run.group(r["row"], tokens, percent)
                    n = len(tokens)
                    counts = table[(tokens & np.uint64(len(table) - 1)).astype(np.int64)]
                    head = np.lexsort((tokens, counts))[: query_length(n, percent)]
                    ordered = tokens[head].view(np.int64).tolist()
                    rare = int((counts[head] < frequent).sum())
                    more = {"frequent_from": rare, "bits": bitmap(tokens)}
                    run.add(group, r["row"], n, ordered[: index_length(n, percent)], more)
                    doc |= {"tokens": ordered, "signs": [least, *r["signs"]]} | more
                out.append(doc | {"member_of": group})
            if len(out) > 500:
                yield pa.RecordBatch.from_pylist(out, _GROUP_SCHEMA)
                out = []
        yield pa.RecordBatch.from_pylist(out + run.rows(), _GROUP_SCHEMA)
        give_back(_HASHES)

    return run


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: the smallest node that each node of the edges reaches.

    Labels spread to neighbours, and from label to label, until none changes; each round is
    written to the shared folder.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    both, _ = write_table(edges.union(edges.select("b", "a")).distinct(), "edges")
    lowest = both.groupBy("a").agg(F.min("b").alias("b"))
    lowest = lowest.select(F.col("a").alias("node"), F.least("a", "b").alias("label"))
    labels, _ = write_table(lowest, "labels")
    while not labels.isEmpty():
        near = splittable_join(both, labels, ["b"], right_on=["node"])
        near = near.groupBy("a").agg(F.min("label").alias("near"))
        spread = splittable_join(labels, near, ["node"], right_on=["a"]).select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("label")
        )
        jumped = spread.join(
            labels.select(F.col("node").alias("label"), F.col("label").alias("jump")), "label"
        ).select("node", "before", F.least("label", "jump").alias("label"))
        jumped, _ = write_table(jumped, "labels")
        labels = jumped.select("node", "label")
        if jumped.where("label <> before").isEmpty():
            break
    return labels


def _verify(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            kept, last, tokens = [], None, None
            packed = (batch.column(c).to_pylist() for c in ("packed_a", "packed_b"))
            for i, (x, y) in enumerate(zip(*packed)):
                if x != last:
                    last, tokens = x, shingle_set(unpack(x).decode(), width)
                if linked(tokens, shingle_set(unpack(y).decode(), width), percent):
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))
        give_back(_HASHES)

    return run


def _labelled(df: DataFrame, group: str, labels: DataFrame, name: str) -> DataFrame:
    """``df`` with the present component of a group: its label, or else itself."""
    found = splittable_join(df, labels, [group], "left", right_on=["node"])
    return found.withColumn(name, F.coalesce("label", group)).drop("label")


def jaccard_components(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, key: one row per row of ``docs``.

    ``key`` is a hash of the text, which with doc_id finds the row again. Words are separated
    by ASCII white space, A-Z counts as a-z. Two documents link when 100 * common shingles >= ``percent`` * shingles of either. ``component_id`` is the
    smallest doc_id reachable by links, itself included, null ids being left out where there
    are others. A null text, or one without words, has no shingles and links with nothing;
    repeated rows link with each other. Other columns are ignored.
    """
    return _components_of(docs, width, percent).drop("component")


def _components_of(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """As ``jaccard_components``, with the component's own number, null for a row without shingles."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_key(), text)
    features, _ = write_table(rows.mapInArrow(_features(width), _FEATURES), "features")
    counts = shingle_counts(features)
    texts = features.where("n > 0").select("row", "doc_id", "key", "packed", "n", "print", "least", "signs")
    by_least = ["least", "print", "row"]
    stored, _ = write_table(
        texts.repartitionByRange(*by_least)
        .sortWithinPartitions(*by_least)
        .mapInArrow(_group_rows(spark.sparkContext.broadcast(counts), width, percent), _GROUPS),
        "groups",
    )
    labels = _link_groups(stored, texts, width, percent)
    members = stored.where("row IS NOT NULL").select("doc_id", "key", "n", "member_of")
    labelled = _labelled(members, "member_of", labels, "component")
    smallest = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    done = splittable_join(labelled, smallest, ["component"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "key", "component"
    )
    alone = features.where("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "key", F.lit(None).alias("component")
    )
    return done.union(alone)


def _links_of(pairs: DataFrame, packed: DataFrame, width: int, percent: int) -> DataFrame:
    """Of pairs a, b of rows those that link, as links a, b of their groups."""
    pairs, _ = write_table(pairs, "pairs")
    packed_a, packed_b = (packed.withColumnRenamed("packed", f"packed_{x}") for x in "ab")
    left = splittable_join(pairs.select("a", "b").distinct(), packed_a, ["a"], right_on=["row"])
    both = splittable_join(left, packed_b, ["b"], right_on=["row"])
    found = both.mapInArrow(_verify(width, percent), "a long, b long")
    found = found.withColumnsRenamed({"a": "_a", "b": "_b"})
    same = (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))
    kept = pairs.join(found, same).select(F.col("group_a").alias("a"), F.col("group_b").alias("b"))
    return write_table(kept, "links")[0]


def _shared_signs(first: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of rows by which groups that share a least hash may link: a few for each group.

    Of each group with the hash two members are compared with the first row that has it.
    """
    rows = _labelled(first.select("row", "member_of", "signs"), "member_of", labels, "group")
    rows = rows.select("row", "group", F.posexplode("signs").alias("kind", "sign"))
    hash_ = ["kind", "sign"]
    hubs = (
        rows.groupBy(*hash_)
        .agg(
            F.min(F.struct("row", "group")).alias("hub"),
            F.min("group").alias("least"),
            F.max("group").alias("most"),
        )
        .where("least <> most")
        .select(*hash_, F.col("hub.row").alias("b"), F.col("hub.group").alias("group_b"))
    )
    ends = rows.groupBy(*hash_, "group").agg(F.min("row").alias("low"), F.max("row").alias("high"))
    return (
        splittable_join(ends.withColumnRenamed("group", "group_a"), hubs, hash_)
        .where("group_a <> group_b")
        .select(F.explode(F.array("low", "high")).alias("a"), "b", "group_a", "group_b")
        .distinct()
    )


def _matrix(stored: DataFrame, labels: DataFrame) -> DataFrame:
    """token, group_b, least, most, after_b, b, before_b, bits_b: the token-group matrix's cells.

    Cells that groups brought together have for the same token become one.
    """
    names = ["cell_tokens", "cell_least", "cell_most", "cell_after", "cell_row", "cell_before"]
    groups = stored.where("cell_tokens IS NOT NULL").select("member_of", "bits", "frequent_from", *names)
    groups = splittable_join(groups, labels, ["member_of"], "left", right_on=["node"])

    def cells(of: DataFrame, group: str) -> DataFrame:
        one = of.select(
            F.col(group).alias("group_b"),
            "bits",
            "frequent_from",
            F.posexplode(F.arrays_zip(*names)).alias("place", "cell"),
        )
        return one.select(
            F.col("cell.cell_tokens").alias("token"),
            "group_b",
            F.col("cell.cell_least").alias("least"),
            F.col("cell.cell_most").alias("most"),
            F.col("cell.cell_after").alias("after_b"),
            F.col("cell.cell_row").alias("b"),
            F.col("cell.cell_before").alias("before_b"),
            F.when(F.col("place") >= F.col("frequent_from"), F.col("bits")).alias("bits_b"),
        )

    together = cells(groups.where("label IS NOT NULL"), "label").groupBy("token", "group_b").agg(
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.max(F.struct("after_b", "b")).alias("after"),
        F.when(
            (F.count("before_b") == F.count("*")) & (F.min("before_b") == F.max("before_b")),
            F.min("before_b"),
        ).alias("before_b"),
    )
    together = together.select(
        "token", "group_b", "least", "most", "after.after_b", "after.b", "before_b",
        F.lit(None).cast("array<long>").alias("bits_b"),
    )
    return cells(groups.where("label IS NULL"), "member_of").union(together)


def _places(tokens: Column | str) -> Column:
    """A row for each token: its place, the token itself and the one before it."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    place = lambda token, i: F.struct(i.alias("place"), token.alias("token"))
    before = F.slice(F.concat(F.array(F.lit(None).cast("long")), tokens), 1, F.size(tokens))
    return F.explode(F.arrays_zip(F.transform(tokens, place).alias("at"), before.alias("before")))


def _place(side: str) -> list[Column]:
    """Columns of a row of ``_places``. Only a frequent token needs the one before it."""
    frequent = F.col("token.at.place") >= F.col("frequent_from")
    return [
        F.col("token.at.place").alias(f"place_{side}"),
        F.col("token.at.token").alias("token"),
        F.when(frequent, F.col("token.before")).alias(f"before_{side}"),
    ]


def _link_groups(stored: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """node, label: components of the groups that links join. Groups not in it stand alone."""
    first = stored.where("tokens IS NOT NULL")
    # Copies of one set that were sorted into different tasks.
    same = (
        first.groupBy("print")
        .agg(F.min("member_of").alias("a"), F.collect_set("member_of").alias("b"))
        .where("size(b) > 1")
        .select("a", F.explode("b").alias("b"))
        .where("a <> b")
    )
    links, _ = write_table(same, "links")
    pairs, _ = write_table(_shared_signs(first, components(links)), "pairs")
    needed = pairs.select("a").union(pairs.select("b")).distinct()
    texts = texts.select("row", "packed")
    packed = splittable_join(texts, needed, ["row"], "left_semi", right_on=["a"])
    links = links.union(_links_of(pairs, packed, width, percent))
    labels = components(links)

    # From here on the groups are those brought together so far.
    whole = 100 + percent
    documents = first.select("row", "n", "member_of", "tokens", "bits", "frequent_from")
    grouped = _labelled(documents, "member_of", labels, "group")
    queries = grouped.withColumn("token", _places("tokens")).select(
        F.col("row").alias("a"),
        F.col("n").alias("n_a"),
        F.nullif("group", "row").alias("group_a"),  # null, which takes no space, for most
        *_place("a"),
        F.when(F.col("token.at.place") >= F.col("frequent_from"), F.col("bits")).alias("bits_a"),
    )
    cells = _matrix(stored, labels)
    # Whether a member as large as the bounds allow could still have the overlap that a link
    # with the query needs, the cell's token being the first in common.
    first_in_common = F.coalesce(F.col("before_a") != F.col("before_b"), F.lit(True))
    n_b = F.greatest("least", F.ceil(F.col("n_a") * percent / 100))
    reach = 1 + F.least(F.col("n_a") - F.col("place_a") - 1, F.col("after_b"))
    differing = F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(differing, F.lit(0), lambda n, x: n + x)
    both_n = F.col("n_a") + F.col("least")  # bitmaps are of groups of one member, of that size
    alike = F.coalesce(whole * (both_n - differ) >= 2 * percent * both_n, F.lit(True))
    qualifying, _ = write_table(
        splittable_join(queries, cells, ["token"])
        .withColumn("group_a", F.coalesce("group_a", "a"))
        .where(F.col("group_a") != F.col("group_b"))
        .where(first_in_common)
        .where((100 * F.col("most") >= percent * F.col("n_a")) & (F.col("least") <= F.col("n_a")))
        .where(whole * reach >= percent * (F.col("n_a") + n_b))
        .where(alike)
        .drop("bits_a", "bits_b"),
        "qualifying",
    )
    if qualifying.isEmpty():
        return labels
    # Texts that may have to be compared: the queries, and members of the groups they open.
    opened = qualifying.select("token", "group_b").distinct()
    length = F.col("n") - F.ceil(2 * percent * F.col("n") / whole) + 1
    index_tokens = F.slice("tokens", 1, length.cast("int"))
    indexed = grouped.withColumn("token", _places(index_tokens)).select(
        F.col("row").alias("b"), F.col("n").alias("n_b"), F.col("group").alias("group_b"), *_place("b")
    )
    members, _ = write_table(splittable_join(indexed, opened, ["token", "group_b"], "left_semi"), "members")
    needed = qualifying.select("a").union(members.select("b")).distinct()
    packed, _ = write_table(splittable_join(texts, needed, ["row"], "left_semi", right_on=["a"]), "packed")

    def apart(df: DataFrame) -> DataFrame:
        both = _labelled(_labelled(df, "group_a", labels, "label_a"), "group_b", labels, "label_b")
        return both.where("label_a <> label_b")

    # The most promising pair of each two groups that are still apart, then any other one.
    for rank in (F.count(F.lit(1)), F.max(F.xxhash64("a", "b"))):
        promising = (
            apart(qualifying)
            .groupBy("label_a", "label_b", "a", "b", "group_a", "group_b")
            .agg(rank.alias("rank"))
            .groupBy(F.least("label_a", "label_b").alias("x"), F.greatest("label_a", "label_b").alias("y"))
            .agg(F.max(F.struct("rank", "a", "b", "group_a", "group_b")).alias("best"))
            .select("best.a", "best.b", "best.group_a", "best.group_b")
        )
        more = _links_of(promising, packed, width, percent)
        if more.isEmpty():
            break
        links = links.union(more)
        labels = components(links)
    # Every pair whose groups are still apart.
    still = apart(qualifying).select("token", "a", "n_a", "place_a", "before_a", "group_a", "group_b")
    still = still.withColumnsRenamed({"token": "_token", "group_b": "_group"})
    reach = 1 + F.least(F.col("n_a") - F.col("place_a") - 1, F.col("n_b") - F.col("place_b") - 1)
    pairs = (
        splittable_join(members, still, ["token", "group_b"], right_on=["_token", "_group"])
        .where((F.col("n_b") <= F.col("n_a")) & (100 * F.col("n_b") >= percent * F.col("n_a")))
        .where(whole * reach >= percent * (F.col("n_a") + F.col("n_b")))
        .where(first_in_common)
        .select("a", "b", "group_a", "group_b")
        .distinct()
    )
    more = _links_of(pairs, packed, width, percent)
    return labels if more.isEmpty() else components(links.union(more))


def one_of_each_component(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component, that of the smallest doc_id, with all its columns.

    Of several rows with that id, and of a component of null ids only, the one with the
    smallest text hash stays. Rows without shingles stay as they are, identical rows being one.
    """
    found = _components_of(docs, width, percent)
    alone = F.col("n_shingles") == 0
    chosen = found.where(~alone & F.col("doc_id").eqNullSafe(F.col("component_id")))
    nameless = F.when(F.col("doc_id").isNull(), F.col("component")).alias("nameless")
    kept = chosen.groupBy("doc_id", nameless).agg(F.min("key").alias("key")).select("doc_id", "key")
    kept = kept.union(found.where(alone).select("doc_id", "key"))
    return keep_rows(docs, kept, text_key())
