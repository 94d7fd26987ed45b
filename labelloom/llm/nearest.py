"""Nearest vectors by multi-index hashing over learned binary codes.

Codes are signs of centred, rotated vectors. The rotations are learned on a sample of at
most ``SAMPLE`` vectors (principal axes, then alternating sign and rotation steps), several
of them until there are about ``BITS`` bits. Codes are cut into bytes, and every byte is an
index of its own: if two codes differ in at most ``r`` bits, then one of their ``m`` bytes
differs in few (the first ``r % m + 1`` in at most ``r // m``, or another in one less), so
probing each index within that distance finds every code in the radius. Found codes within
the radius are ranked by distance of the vectors themselves, in double precision.

The radius is the one that holds ``SURE`` of the sample's true neighbours; more data only
brings neighbours closer. A query that finds too few within it is asked again without limit.

Vectors that are equal become one entry of the index, with as many of its smallest ids as a
result can show, so groups of copies cost no more than one vector. The index is cut into
blocks; the queries (a stated set) go to all of them in chunks, each block returns its
nearest, and those are merged.

Defined results: vectors that are null, zero, hold a null or a number that is not finite, or
have another length than most (the shorter on a tie), and rows without id take no part. Rows
with the query's own id are not its candidates. Ties in distance go to the smaller id. An
empty table gives an empty result. Columns other than id and vector are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelloom.deploy import ship_package
from labelloom.llm.shared import read_table, written

SAMPLE, SAMPLE_QUERIES = 8_000, 200
BITS, STEPS = 256, 25
SURE = 0.99
LEAST_BLOCK, MOST_BLOCK, QUERY_CHUNK = 1_024, 50_000, 1_024
BLOCKS = 48

#: Differing bits of two bytes.
BIT_COUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
BYTES = np.arange(256)
DIFFERENT = BIT_COUNT[BYTES[:, None] ^ BYTES[None, :]]


@dataclass
class Codes:
    """What turns vectors into codes, and the radius to search."""

    mean: np.ndarray
    turn: np.ndarray  # dimensions x bits
    radius: int = 0

    @property
    def bits(self) -> int:
        return self.turn.shape[1]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        return np.packbits((vectors - self.mean) @ self.turn > 0, axis=1)


def learn_codes(sample: np.ndarray, neighbours: int) -> Codes:
    """Rotations and radius from a sample of distinct vectors."""
    dice = np.random.default_rng(11)
    mean = sample.mean(axis=0)
    centred = sample - mean
    axes = np.linalg.svd(centred.T @ centred)[0][:, :BITS]
    low = centred @ axes
    turns = []
    for _ in range(max(1, round(BITS / axes.shape[1]))):
        turn = np.linalg.qr(dice.normal(size=(axes.shape[1],) * 2))[0]
        for _ in range(STEPS):
            u, _, v = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
            turn = (u @ v).T
        turns.append(axes @ turn)
    turn = np.concatenate(turns, axis=1)
    spare = -turn.shape[1] % 8  # whole bytes: some directions once more
    codes = Codes(mean, np.concatenate([turn, turn[:, :spare]], axis=1))
    asked = dice.permutation(len(sample))[:SAMPLE_QUERIES]
    packed, far = codes.of(sample), []
    for i in asked:
        distance = ((sample - sample[i]) ** 2).sum(axis=1)
        distance[i] = np.inf
        near = np.argsort(distance)[: min(neighbours, len(sample) - 1)]
        far.append(DIFFERENT[packed[near], packed[i]].sum(axis=1))
    far = np.concatenate(far)
    codes.radius = int(np.quantile(far, SURE, method="higher")) if len(far) else codes.bits
    return codes


class MultiIndex:
    """One index per byte of the codes: rows in order of the byte, and where its values start."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed
        self.rows = np.argsort(packed, axis=0, kind="stable")
        counts = [np.bincount(column, minlength=256) for column in packed.T]
        self.starts = np.concatenate([np.zeros((len(counts), 1), int), np.cumsum(counts, 1)], 1)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows of all codes that differ from ``code`` in at most ``radius`` bits."""
        found = np.zeros(len(self.packed), bool)
        each, rest = divmod(radius, len(code))
        for j, byte in enumerate(code):
            limit = each if j <= rest else each - 1
            if limit < 0 or found.all():
                break
            values = np.flatnonzero(DIFFERENT[byte] <= limit)
            start, end = self.starts[j, values], self.starts[j, values + 1]
            n = end - start
            at = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
            found[self.rows[at, j]] = True
        rows = np.flatnonzero(found)
        return rows[DIFFERENT[self.packed[rows], code].sum(axis=1) <= radius]


def _search(shared, most: int):
    def search(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(index) and len(queries):
            codes: Codes = shared.value
            vectors = np.stack(index["vector"]).astype(np.float64)
            asked = np.stack(queries["vector"]).astype(np.float64)
            names = index["entry"].to_numpy()
            tables, packed = MultiIndex(codes.of(vectors)), codes.of(asked)
            for query, radius, vector, code in zip(
                queries["query"], queries["radius"], asked, packed, strict=True
            ):
                rows = tables.within(code, radius)
                distance = np.sqrt(((vectors[rows] - vector) ** 2).sum(axis=1))
                best = np.lexsort((names[rows], distance))[:most]
                out += [(query, names[rows[i]], distance[i]) for i in best]
        return pd.DataFrame(out, columns=["query", "entry", "score"]).astype(
            {"query": "int64", "entry": "int64", "score": "float64"})

    return search


def usable(vector: Column) -> Column:
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, sound) & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame, asked: Column, k: int = 10, id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest of rows ``asked``."""
    spark = ship_package(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
        asked.alias("asked"),
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(
        F.desc("count"), "n").first()
    shape = "query_id long, rank int, vec_id long, score double"
    if not length:
        return spark.createDataFrame([], shape)
    rows = rows.where(F.size("vector") == length.n)
    # One entry for equal vectors, named by the least of its k + 1 least ids.
    place = F.row_number().over(W.partitionBy("vector").orderBy("vec_id"))
    entries = written(
        rows.select("vector", "vec_id").withColumn("place", place).where(F.col("place") <= k + 1)
        .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("entry"), "vector", "ids"),
        "entries",
    )
    total = entries.count()
    sampled = entries.where(
        F.pmod(F.xxhash64("entry"), F.lit(1 << 20)) < round(min(1, SAMPLE / total) * (1 << 20))
    ).select("vector").limit(2 * SAMPLE).toPandas()
    if not len(sampled):
        sampled = entries.select("vector").limit(1).toPandas()
    codes = learn_codes(np.stack(sampled["vector"]).astype(np.float64), k)
    shared = spark.sparkContext.broadcast(codes)

    named = entries.select("entry", F.col("vector").alias("v"))
    queries = written(
        rows.where("asked").select("vec_id", "vector")
        .join(named, F.col("vector") == F.col("v")).select("vec_id", "entry"),
        "queries",
    )
    wanted = written(
        entries.join(queries.select("entry").distinct(), "entry").select(
            F.col("entry").alias("query"), "vector"),
        "query-vectors",
    )
    size = min(MOST_BLOCK, max(LEAST_BLOCK, total // BLOCKS))
    blocks, chunks = -(-total // size), max(1, -(-wanted.count() // QUERY_CHUNK))
    key = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    def search(chosen: DataFrame, radius: int, name: str) -> DataFrame:
        index = entries.select(
            "entry", "vector", key("entry", blocks).alias("block"),
            F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
        dealt = chosen.select(
            "query", "vector", F.lit(radius).alias("radius"), key("query", chunks).alias("chunk"),
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        found = index.groupBy("block", "chunk").cogroup(dealt.groupBy("block", "chunk")) \
            .applyInPandas(_search(shared, k + 1), "query long, entry long, score double")
        best = F.row_number().over(W.partitionBy("query").orderBy("score", "entry"))
        return written(
            found.withColumn("place", best).where(F.col("place") <= k + 1).drop("place"), name)

    found = search(wanted, codes.radius, "found")
    held = found.join(entries.select("entry", F.size("ids").alias("n")), "entry")
    enough = held.groupBy("query").agg(F.sum("n").alias("n")).where(F.col("n") > k)
    short = written(wanted.join(enough, "query", "left_anti"), "short-queries")
    if short.limit(1).count():
        again = search(short, codes.bits, "found-again")
        found = found.join(short.select("query"), "query", "left_anti").unionByName(again)

    offered = found.join(entries.select("entry", "ids"), "entry").select(
        "query", "score", F.explode("ids").alias("vec_id"))
    ranked = (
        queries.select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query"))
        .distinct().join(offered, "query").where("vec_id != query_id")
        .withColumn("rank", F.row_number().over(
            W.partitionBy("query_id").orderBy("score", "vec_id")))
    )
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
