"""SimHash near-duplicates: pigeonhole blocks of fingerprints, joined, verified by distance.

A text's shingles are runs of three words (A-Z lowered), repeats included, hashed to 64 bits
(XXH64, seed 42, of the words joined by a blank). A bit of its fingerprint is set if more than
half of the hashes set it. Fingerprints within ``RADIUS`` differing bits are linked.

Fingerprints are cut into blocks of bits. Two that differ in at most ``RADIUS`` bits agree in
all but ``RADIUS`` blocks at least, so every choice of that many blocks is a key, and linked
pairs share one. With more blocks there are more keys, each of more bits: the number is chosen
by how many different fingerprints there are, so that chance brings few together. Any number
gives the same links.

Work is on different fingerprints, whatever their copies. Those sharing a key are compared
where they lie, in sorted order, and pairs verified by their differing bits; of the links found
in one key only those that join what was apart are handed on, so a group of near copies costs
its size in rows, not its pairs. Keys with more than ``PIECE`` fingerprints are dealt out as
pairs of pieces: no task holds one, and no link is lost.

Defined results: a text with fewer words than a shingle is one shingle; a null text or one
without words has the fingerprint zero and is linked like any other. Rows that repeat a
``doc_id`` are separate documents; a component whose ids are all null has a null id. Very long
texts are read whole, one at a time. An empty table gives an empty result. Columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.deploy import ship_package
from labelloom.llm.components import components
from labelloom.llm.shared import read_table, small_enough, written

WIDTH = 3
RADIUS = 3
SEED = 42
BITS = 64
#: Fingerprints that chance brings together under one key, at most on average.
BY_CHANCE = 16
#: Fingerprints of a key that one task compares with each other.
PIECE = 1024
CHUNK_SHINGLES = 400_000
#: Rows compared at once, about; whole keys are kept together.
CHUNK_ROWS = 200_000
BROADCAST_ROWS = 500_000

LANES = np.uint64(0x0101010101010101)


# -- fingerprints -------------------------------------------------------------------


def shingle_hashes(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Hashes of a text's shingles, in order, with repeats."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashed = xxhash.xxh64_intdigest
    runs = zip(*(words[i:] for i in range(min(width, len(words)))))
    return np.fromiter((hashed(run, SEED) for run in map(b" ".join, runs)), np.uint64)


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A fingerprint for each stretch of ``sizes`` hashes: bits set in over half of them.

    Eight counters of eight bits lie in one word, so hashes are added up in runs of 255.
    """
    prints = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return prints
    sizes = sizes[full]
    starts = np.cumsum(sizes) - sizes
    runs = -(-sizes // 255)
    first = np.cumsum(runs) - runs
    run = np.arange(runs.sum()) - np.repeat(first, runs)
    cuts = np.repeat(starts, runs) + 255 * run
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & LANES, cuts)
        for byte in range(8):
            counts = (lanes >> np.uint64(8 * byte)) & np.uint64(255)
            set_in = np.add.reduceat(counts.astype(np.int64), first)
            prints[full] |= (2 * set_in > sizes).astype(np.uint64) << np.uint64(8 * byte + bit)
    return prints


def _print_texts(width: int):
    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            prints = majority(
                np.concatenate([*hashes, np.empty(0, np.uint64)]),
                np.array([len(h) for h in hashes], np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(ids), pa.array(prints.view(np.int64))],
                names=["doc_id", "fingerprint"])

        ids, hashes, size = [], [], 0
        for batch in batches:
            done = 0
            for i, text in enumerate(batch.column(1)):
                hashes.append(shingle_hashes(text.as_py(), width))
                size += len(hashes[-1])
                if size > CHUNK_SHINGLES:
                    ids.append(batch.column(0)[done : i + 1])
                    yield made()
                    ids, hashes, size, done = [], [], 0, i + 1
            if done < batch.num_rows:
                ids.append(batch.column(0)[done:])
        if ids:
            yield made()

    return batches_of


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id``, ``fingerprint`` (64 bits as a long) of all documents; no shuffle."""
    ship_package(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        _print_texts(width), f"doc_id {kind}, fingerprint long")


# -- links --------------------------------------------------------------------------


def block_masks(different: int, radius: int = RADIUS) -> list[int]:
    """Masks of the bits of every key, for a number of different fingerprints."""
    blocks = radius + 1
    while blocks < BITS:
        edges = [BITS * i // blocks for i in range(blocks + 1)]
        own = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
        masks = [sum(chosen) for chosen in combinations(own, blocks - radius)]
        if different <= BY_CHANCE << min(m.bit_count() for m in masks):
            return masks
        blocks += 1
    raise ValueError("more different fingerprints than blocks can tell apart")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


class Groups:
    """Which rows are joined, by number; a group is named by its least row."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def top(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = i = self.root[self.root[i]]
        return i

    def join(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Places of the pairs that joined two groups."""
        news = []
        for place, (i, j) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            i, j = self.top(i), self.top(j)
            if i != j:
                self.root[max(i, j)] = min(i, j)
                news.append(place)
        if news:  # all rows name their group, for those that follow
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]
        return news


def joining_links(group: np.ndarray, prints: np.ndarray, radius: int):
    """Of rows in order of group: (a, b) within the radius that span what a group joins."""
    joined, found = Groups(len(group)), []
    here, step = np.arange(len(group)), 0
    while len(here):
        step += 1
        here = here[here + step < len(group)]
        here = here[group[here] == group[here + step]]
        near = np.bitwise_count(prints[here] ^ prints[here + step]) <= radius
        a = here[near]
        b = a + step
        apart = joined.root[a] != joined.root[b]
        a, b = a[apart], b[apart]
        news = joined.join(a, b)
        found.append((prints[a[news]], prints[b[news]]))
    return tuple(np.concatenate(side) for side in zip(*found)) if found else (prints[:0],) * 2


def _link_rows(radius: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key number, key, low, high, fingerprint) in order of key, to (a, b)."""
        kept = [np.empty(0, np.int64)] * 5

        def made(columns):
            change = np.zeros(len(columns[0]), bool)
            for column in columns[:4]:
                change[1:] |= column[1:] != column[:-1]
            a, b = joining_links(np.cumsum(change), columns[4].view(np.uint64), radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            kept = [np.concatenate(pair) for pair in zip(kept, new, strict=True)]
            if len(kept[0]) >= CHUNK_ROWS:
                last = np.ones(len(kept[0]), bool)
                for column in kept[:4]:
                    last &= column == column[-1]
                cut = len(last) - int(last.sum())  # the last key may go on
                if cut:
                    yield made([c[:cut] for c in kept])
                    kept = [c[cut:] for c in kept]
        if len(kept[0]):
            yield made(kept)

    return link


def near_prints(different: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a``, ``b``: links that join all of the different fingerprints within the radius."""
    keys = block_masks(different.count(), radius)
    keyed = written(different.select("fingerprint", F.explode(F.array(*(
        F.struct(F.lit(number).alias("number"),
                 F.col("fingerprint").bitwiseAND(F.lit(_signed(mask))).alias("key"))
        for number, mask in enumerate(keys)))).alias("k")).select("k.*", "fingerprint"),
        "fingerprint-keys")
    counts = keyed.groupBy("number", "key").count().where("count > 1")
    large = written(counts.where(F.col("count") > PIECE).select(
        "number", "key", F.ceil(F.col("count") / PIECE).cast("int").alias("pieces")),
        "large-keys")
    dealt = keyed.join(small_enough(large, BROADCAST_ROWS), ["number", "key"], "left")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("pieces")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("pieces") - 1),
        lambda other: F.struct(F.least(own, other).alias("low"),
                               F.greatest(own, other).alias("high")))
    alone = F.array(F.struct(F.lit(0).alias("low"), F.lit(0).alias("high")))
    dealt = dealt.select("number", "key", F.explode(
        F.when(F.col("pieces").isNull(), alone).otherwise(others)).alias("p"), "fingerprint")
    order = ["number", "key", "low", "high"]
    dealt = dealt.select("number", "key", "p.low", "p.high", "fingerprint")
    return (
        dealt.repartition(*order).sortWithinPartitions(*order)
        .mapInArrow(_link_rows(radius), "a long, b long")
    )


def simhash_components(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long), ``component_id``: least id linked, of all documents."""
    prints = written(fingerprints(docs, width), "fingerprints")
    firsts = written(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")),
        "different-fingerprints")
    labels = components(written(near_prints(firsts.select("fingerprint"), radius), "near-prints"))
    rooted = firsts.join(labels, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first", "n", "root")
    heads = rooted.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("head"))
    shared = (
        rooted.where("n > 1 OR root IS NOT NULL").join(heads, "root", "left")
        .select("fingerprint", F.coalesce("head", "first").alias("head"), F.lit(True).alias("is"))
    )
    found = prints.join(
        small_enough(written(shared, "shared-fingerprints"), BROADCAST_ROWS), "fingerprint", "left")
    return found.select(
        "doc_id", "fingerprint",
        F.when(F.col("is"), F.col("head")).otherwise(F.col("doc_id")).alias("component_id"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(read_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
