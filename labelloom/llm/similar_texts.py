"""N-gram Jaccard join: a count-vector R-tree over hashed shingles, exact at the end.

A text is the set of its distinct shingles (runs of four words, A-Z lowered). Shingles are
hashed into ``GROUPS`` groups; the numbers per group are the text's point. Two sets share at
most the sum of the lesser coordinates of their points, and boxes of points are bounded in
the same way, which lets an R-tree drop whole branches of pairs. What survives is verified
on the shingles.

A single R-tree over all points would be of no use at scale (points of unlike texts of one
size lie close in every coordinate), and it would have to sit somewhere. So the space is cut
first: two sets that are similar enough share one of the first shingles in any fixed order
(each has to lack the other's first ``n - least + 1`` to share too few), and a tree is built
in every block of texts with a shingle in common there. The order puts shingles last that a
sample of texts shows to be frequent, then goes by hash; any order gives the same result.

Copies, near copies and frequent passages:

* equal sets become one node before anything is joined;
* a first round links every node to the first of its block, verified, which joins groups of
  near copies without looking at their pairs;
* the second round looks in each block for pairs of different components only, and a block
  of one component is dropped by its counts alone. Trees of small points find the members
  that may have a partner; these come with their texts to trees of finer points, and what is
  left is verified. Large groups are dealt out as pairs of pieces, so that no task holds one.
  No link between different components is lost.

Defined results: a null text or one without words has an empty set, is linked with nothing
and is its own component. Rows that repeat a ``doc_id`` are separate documents. A component
whose ids are all null has a null id. An empty table gives an empty result. Columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.deploy import ship_package
from labelloom.llm.components import components
from labelloom.llm.scoring import Names, find, mix, words_in
from labelloom.llm.shared import fresh, read_table, small_enough, written

WIDTH = 4
PERCENT = 85
GROUPS = 32
#: Texts (about) whose shingles show which ones are frequent, and times that make them so.
SAMPLE_TEXTS, FREQUENT_TIMES = 5_000, 3
#: First shingles of a set that the first round compares.
FIRST_ROUND = 12
#: Members of a block that one task holds; larger blocks are dealt out.
PIECE = 500
LEAF, FANOUT, LEAVES_AT_ONCE = 32, 8, 400
COUNTS_AT_ONCE = 1 << 22
CHUNK_TOKENS = 500_000
BROADCAST_ROWS = 1_000_000

ONE = np.uint64(1)


# -- sets ---------------------------------------------------------------------------


def shingles_of(names: Names, text: bytes | None, width: int) -> np.ndarray:
    """Hashes of a text's shingles, with repeats; the whole text if it has fewer words."""
    words = words_in(text)
    if not words:
        return np.empty(0, np.uint64)
    tokens = np.fromiter(map(names.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    out = mix(tokens[: len(tokens) - width + 1] + np.uint64(width))
    for k in range(1, width):
        out = mix(out + tokens[k : len(tokens) - width + 1 + k])
    return out


def least_shared(a, b, percent: int):
    """Shingles that sets of these sizes must share: percent * union <= 100 * shared."""
    return -(-percent * (a + b) // (100 + percent))


def _chunks(batches: Iterator[pa.RecordBatch], width: int):
    """Columns but the last, and the texts' shingles, some million at a time."""
    names, keys, texts, size = Names(), [], [], 0
    for batch in batches:
        for *key, text in zip(*(c.to_pylist() for c in batch.columns[:-1]), batch.columns[-1],
                              strict=True):
            texts.append(shingles_of(names, text.as_py(), width))
            keys.append(key)
            size += len(texts[-1])
            if size > CHUNK_TOKENS:
                yield keys, texts
                keys, texts, size = [], [], 0
    if texts:
        yield keys, texts


def _distinct(texts: list[np.ndarray], last: np.ndarray):
    """Owner and hash of all distinct shingles: per text, those in ``last`` at the end."""
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    hashes = np.concatenate([*texts, np.empty(0, np.uint64)])
    late = find(last, hashes)[1]
    order = np.lexsort((hashes, owner * 2 + late))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[new], hashes[new]


def _count_sample(width: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _chunks(batches, width):
            hashes, n = np.unique(
                _distinct(texts, np.empty(0, np.uint64))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(n)], names=["hash", "n"])

    return count


def frequent_shingles(texts: DataFrame, width: int) -> np.ndarray:
    """Hashes of shingles that a sample shows to be in many texts: a bounded number."""
    rows = texts.count()
    share = min(1.0, SAMPLE_TEXTS / max(rows, 1))
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < round(share * 1_000_000)
    counted = (
        texts.where(chosen).select("text").mapInArrow(_count_sample(width), "hash long, n long")
        .groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_TIMES)
        .select("hash").toPandas()
    )
    return np.sort(counted["hash"].to_numpy(np.int64).view(np.uint64))


SETS = (
    "doc_id {id}, text_key long, n_shingles long, print1 long, print2 long, "
    "point array<int>, cells binary, first array<bigint>"
)


def _cells(owner: np.ndarray, hashes: np.ndarray, n: np.ndarray) -> pa.Array:
    """Finer points, of about eight shingles a group: counts of two bytes, as one value."""
    bits = np.clip(np.ceil(np.log2(np.maximum(n, 1) / 8)), 5, 16).astype(np.int64)
    ends = np.cumsum(1 << bits)
    start = ends - (1 << bits)
    cell = start[owner] + (hashes >> (64 - bits)[owner].astype(np.uint64)).astype(np.int64)
    counts = np.bincount(cell, minlength=int(ends[-1]) if len(ends) else 0).astype("<u2")
    offsets = np.append(0, 2 * ends).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(counts)])


def _make_sets(shared, width: int, percent: int, id_type: pa.DataType):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _chunks(batches, width):
            owner, hashes = _distinct(texts, shared.value)
            n = np.bincount(owner, minlength=len(texts))
            ends = np.cumsum(n)
            spread = mix(hashes)
            zeros = np.zeros(len(texts), np.uint64)
            print1, print2 = zeros.copy(), zeros.copy()
            full = np.flatnonzero(n)
            if len(full):
                print1[full] = np.add.reduceat(spread, (ends - n)[full])
                print2[full] = np.bitwise_xor.reduceat(mix(spread + ONE), (ends - n)[full])
            cells = owner * GROUPS + (hashes >> np.uint64(59)).astype(np.int64)
            points = np.bincount(cells, minlength=len(texts) * GROUPS).astype(np.int32)
            taken = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
            place = np.arange(len(owner)) - np.repeat(ends - n, n)
            first = hashes[place < np.repeat(taken, n)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], id_type),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array(n.astype(np.int64)),
                    pa.array(print1.view(np.int64)),
                    pa.array(print2.view(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(texts) + 1, dtype=np.int32) * GROUPS),
                        pa.array(points)),
                    _cells(owner, hashes, n),
                    pa.ListArray.from_arrays(
                        pa.array(np.r_[0, np.cumsum(taken)].astype(np.int32)),
                        pa.array(first.view(np.int64))),
                ],
                names=["doc_id", "text_key", "n_shingles", "print1", "print2", "point", "cells",
                       "first"],
            )

    return make


# -- verification -------------------------------------------------------------------


def _verify(width: int, percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, last, own = Names(), None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = np.zeros(len(a), bool)
            for i in range(len(a)):
                if a[i] != last:
                    last = a[i]
                    own = np.unique(shingles_of(names, batch.column(2)[i].as_py(), width))
                other = np.unique(shingles_of(names, batch.column(3)[i].as_py(), width))
                shared = int(find(own, other)[1].sum())
                keep[i] = 100 * shared >= percent * (len(own) + len(other) - shared)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return verify


def texts_of(rows: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``row`` and ``text`` of some nodes."""
    keys = nodes.join(rows, "row", "left_semi").select(
        "row", F.col("doc_id").alias("id_"), "text_key")
    keys = small_enough(written(keys, "needed-texts"), BROADCAST_ROWS)
    known = written(
        texts.join(keys, "text_key")
        .where(F.col("doc_id").eqNullSafe(F.col("id_")))
        .select("row", "text"),
        "texts",
    )
    if known.count() > keys.count():  # rows that occur more than once
        known = written(known.groupBy("row").agg(F.first("text").alias("text")), "texts")
    return known


def verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int):
    """Those (a, b) pairs of nodes whose shingles are similar enough."""
    needed = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
    known = texts_of(needed, nodes, texts)
    return (
        pairs.join(known.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
        .join(known.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_verify(width, percent), "a long, b long")
        .distinct()
    )


# -- the tree -----------------------------------------------------------------------


class CountTree:
    """An R-tree of points packed by size: leaves of ``LEAF``, boxes of ``FANOUT``."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int):
        self.order = np.argsort(sizes, kind="stable")
        self.points, self.sizes, self.percent = points[self.order], sizes[self.order], percent
        starts = np.arange(0, len(sizes), LEAF)
        high = np.maximum.reduceat(self.points, starts)
        low = self.sizes[starts]
        top = self.sizes[np.r_[starts[1:], len(sizes)] - 1]
        self.levels = [(high, low, top)]
        while len(self.levels[-1][1]) > 1:
            high, low, top = self.levels[-1]
            starts = np.arange(0, len(low), FANOUT)
            self.levels.append((
                np.maximum.reduceat(high, starts), low[starts],
                top[np.r_[starts[1:], len(top)] - 1]))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of points whose bound allows enough overlap, as places in the input."""
        left = right = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, 0, -1):
            keep = self._may(*self.levels[depth], left, right)
            left, right = self._children(
                left[keep], right[keep], FANOUT, len(self.levels[depth - 1][1]))
        keep = self._may(*self.levels[0], left, right)
        left, right = left[keep], right[keep]
        found_a, found_b = [], []
        for at in range(0, len(left), LEAVES_AT_ONCE):
            part = slice(at, at + LEAVES_AT_ONCE)
            a, b = self._children(left[part], right[part], LEAF, len(self.sizes))
            keep = (a != b) & self._may(self.points, self.sizes, self.sizes, a, b)
            found_a.append(a[keep])
            found_b.append(b[keep])
        empty = [np.empty(0, np.int64)]
        return (self.order[np.concatenate(found_a + empty)],
                self.order[np.concatenate(found_b + empty)])

    def _may(self, high, low, top, left, right) -> np.ndarray:
        """Whether a pair of boxes (left is not after right) may hold similar sets."""
        keep = top[left] * 100 >= low[right] * self.percent
        some = np.flatnonzero(keep)
        for part in np.array_split(some, len(some) * high.shape[1] // COUNTS_AT_ONCE + 1):
            bound = np.minimum(high[left[part]], high[right[part]]).sum(axis=1)
            keep[part] = bound >= least_shared(low[left[part]], low[right[part]], self.percent)
        return keep

    @staticmethod
    def _children(left, right, fan: int, below: int):
        a = (left[:, None] * fan + np.arange(fan)).repeat(fan, axis=1)
        b = np.tile(right[:, None] * fan + np.arange(fan), fan)
        a, b = a.ravel(), b.ravel()
        keep = (a <= b) & (b < below)
        return a[keep], b[keep]


def _groups(batches: Iterator[pa.RecordBatch], names: int) -> Iterator[pa.Table]:
    """Whole groups of rows that are sorted by their first ``names`` columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(i).to_numpy() for i in range(names)], axis=1)
        if held:
            last = held[-1].slice(held[-1].num_rows - 1)
            if any(last.column(i)[0].as_py() != key[0, i] for i in range(names)):
                yield pa.Table.from_batches(held)
                held = []
        edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(key)]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            if start:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _survivors(percent: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members of a group that may be similar to one of another component."""
        for group in _groups(batches, 3):
            row, part, size = (group.column(i).to_numpy() for i in (3, 4, 5))
            points = [np.frombuffer(c.as_py(), "<u2") for c in group.column(6)]
            groups = np.array([len(p) for p in points])
            near = np.zeros(len(row), bool)
            # Sizes of similar sets differ little: their groups are as many, or twice so.
            for some in np.unique(groups):
                own = np.flatnonzero((groups == some) | (groups == 2 * some))
                if (part[own] == part[own[0]]).all():
                    continue
                folded = np.stack([points[i].reshape(some, -1).sum(axis=1) for i in own])
                a, b = CountTree(folded.astype(np.uint16), size[own], percent).pairs()
                other = part[own[a]] != part[own[b]]
                near[own[a[other]]] = near[own[b[other]]] = True
            found = row[near]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), group.column(0)[0].as_py())), pa.array(found)],
                names=["head", "row"])

    return search


def _points(sets: list[np.ndarray]) -> np.ndarray:
    """Points of as many groups as there are shingles to keep apart, twice over."""
    sizes = np.array([len(x) for x in sets])
    bits = int(np.clip(int(2 * sizes.max()).bit_length(), 5, 13))
    owner = np.repeat(np.arange(len(sets)), sizes) << bits
    cells = owner + (np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.int64)
    return np.bincount(cells, minlength=len(sets) << bits).astype(np.uint16).reshape(
        len(sets), 1 << bits)


def _links_between_components(width: int, percent: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of a group's members that join components, checked on whole sets."""
        names = Names()
        for group in _groups(batches, 3):
            row, part = (group.column(i).to_numpy() for i in (3, 4))
            sets = [np.unique(shingles_of(names, t.as_py(), width)) for t in group.column(5)]
            sizes = np.array([len(x) for x in sets])
            points = _points(sets)
            a, b = CountTree(points, sizes, percent).pairs()
            other = part[a] != part[b]
            a, b = a[other], b[other]
            joined: dict[int, int] = {}

            def top(x: int) -> int:
                while x in joined:  # noqa: B023
                    x = joined[x]  # noqa: B023
                return x

            links = []
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                x, y = top(part[i]), top(part[j])
                if x != y:
                    shared = int(find(sets[i], sets[j])[1].sum())
                    if 100 * shared >= percent * (sizes[i] + sizes[j] - shared):
                        joined[max(x, y)] = min(x, y)
                        links.append((row[i], row[j]))
            found = np.array(links, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return search


# -- the join -----------------------------------------------------------------------


def _allowed(percent: int):
    """The bound for two nodes ``x`` and ``y``, as a condition."""
    lesser = F.zip_with("x.point", "y.point", lambda a, b: F.least(a, b))
    shared = F.aggregate(lesser, F.lit(0).cast("bigint"), lambda s, v: s + v)
    return shared * (100 + percent) >= (F.col("x.n_shingles") + F.col("y.n_shingles")) * percent


def _dealt(met: DataFrame) -> DataFrame:
    """(head, row) members as (head, low, high, row): groups, or pairs of pieces of large ones."""
    sizes = met.groupBy("head").count().where(F.col("count") > PIECE).select(
        "head", F.ceil(F.col("count") / PIECE).cast("int").alias("pieces"))
    pieces = F.coalesce("pieces", F.lit(1))
    return (
        met.join(small_enough(written(sizes, "large-groups"), BROADCAST_ROWS), "head", "left")
        .withColumn("piece", F.pmod(F.xxhash64("row"), pieces).cast("long"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), pieces.cast("long") - 1)))
        .select("head", F.least("piece", "other").alias("low"),
                F.greatest("piece", "other").alias("high"), "row")
    )


def _sorted_groups(rows: DataFrame) -> DataFrame:
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "head", "low", "high").sortWithinPartitions(
        "head", "low", "high")


def component_roots(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles``, ``root``: rows with their component's name."""
    spark = ship_package(docs.sparkSession)
    kind = "long" if dict(docs.dtypes)["doc_id"] in ("bigint", "int") else "string"
    texts = docs.select(
        F.col("doc_id").cast(kind).alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.col("text").cast("binary").alias("text"),
    )
    frequent = spark.sparkContext.broadcast(
        frequent_shingles(docs.select("doc_id", F.col("text").cast("binary").alias("text")), width))
    id_type = pa.int64() if kind == "long" else pa.string()
    sets = written(
        texts.mapInArrow(_make_sets(frequent, width, percent, id_type), SETS.format(id=kind))
        .withColumn("row", F.monotonically_increasing_id()),
        "sets",
    )
    same = ["n_shingles", "print1", "print2"]
    classes = written(
        sets.where("n_shingles > 0").groupBy(*same).agg(F.min("row").alias("node")), "classes"
    )
    nodes = written(
        sets.join(classes.select(F.col("node").alias("row")), "row", "left_semi"), "nodes"
    )

    # First round: each node with the first node of its blocks.
    few = nodes.select("row", F.explode(F.slice("first", 1, FIRST_ROUND)).alias("shingle"))
    heads = written(
        few.groupBy("shingle").agg(F.min("row").alias("head"), F.count("*").alias("n"))
        .where("n > 1").select("shingle", "head"),
        "heads",
    )
    near = (
        few.join(small_enough(heads, BROADCAST_ROWS), "shingle").where("row != head")
        .select(F.col("head").alias("a"), F.col("row").alias("b")).distinct()
    )
    slim = nodes.select("row", "n_shingles", "point")
    first = written(
        near.join(slim.alias("x"), F.col("a") == F.col("x.row"))
        .join(slim.alias("y"), F.col("b") == F.col("y.row"))
        .where(_allowed(percent)).select("a", "b"),
        "first-pairs",
    )
    links = written(verified(first, nodes, texts, width, percent), "first-links")
    parts = components(links)

    # Second round: different components that meet in a block. Blocks with the same first
    # node are searched as one group, which holds each of its members once.
    member = written(
        nodes.join(parts, F.col("row") == F.col("node"), "left").select(
            "row", F.coalesce("root", "row").alias("part"), "n_shingles", "cells", "first"),
        "members",
    )
    placed = member.select("row", "part", F.explode("first").alias("shingle"))
    mixed = written(
        placed.groupBy("shingle")
        .agg(F.min("part").alias("least"), F.max("part").alias("most"), F.min("row").alias("head"))
        .where("least != most").select("shingle", "head"),
        "mixed-blocks",
    )
    met = written(
        placed.join(small_enough(mixed, BROADCAST_ROWS), "shingle").select("head", "row").distinct(),
        "met",
    )
    slim = member.select("row", "part", "n_shingles", "cells")
    searched = _dealt(met).join(slim, "row").select(
        "head", "low", "high", "row", "part", "n_shingles", "cells")
    left = written(
        _sorted_groups(searched).mapInArrow(_survivors(percent), "head long, row long").distinct(),
        "survivors",
    )
    known = texts_of(left.select("row").distinct(), nodes, texts)
    searched = (
        _dealt(left).join(member.select("row", "part"), "row").join(known, "row")
        .select("head", "low", "high", "row", "part", "text")
    )
    links = links.unionByName(written(
        _sorted_groups(searched)
        .mapInArrow(_links_between_components(width, percent), "a long, b long"),
        "second-links",
    ))
    parts = components(links)

    # Components of documents: the nodes', through the classes.
    owned = classes.join(parts, "node", "left").select(
        *same, F.coalesce("root", "node").alias("root")
    )
    owned = written(owned, "class-components")
    return written(
        sets.select("doc_id", "text_key", "row", *same).join(owned, same, "left").select(
            "doc_id", "text_key", "n_shingles",
            F.coalesce("root", F.lit(-1) - F.col("row")).alias("root")),
        "rooted",
    )


def similar_components(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of all documents."""
    rooted = component_roots(docs, width, percent)
    ids = written(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "ids")
    return rooted.join(ids, "root").select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``docs`` with one document of every component: the one with the least id, null last."""
    rooted = component_roots(docs, width, percent)
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("least")
    kept_id, kept_key = fresh(docs, "kept_id_"), fresh(docs, "kept_key_")
    stays = written(
        rooted.groupBy("root").agg(least).select(
            F.col("least.doc_id").alias(kept_id), F.col("least.text_key").alias(kept_key)),
        "kept",
    )
    key = F.xxhash64("text")
    kept = docs.join(
        small_enough(stays, BROADCAST_ROWS),
        F.col("doc_id").eqNullSafe(F.col(kept_id)) & (key == F.col(kept_key)),
        "left_semi",
    )
    if kept.select("doc_id").count() > stays.count():  # rows that are there more than once
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept


def op6_similar_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(read_table(spark, sf_dir, "documents"))
