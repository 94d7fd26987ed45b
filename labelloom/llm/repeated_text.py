"""Repeated strings removed, by external induced sorting of the text that can hold any.

A byte is removed when a string of ``LENGTH`` bytes over it also starts earlier: in a smaller
``doc_id``, or earlier in the same document. Matches end at documents' ends.

Suffixes of the whole corpus cannot be sorted in one place, and need not be. Every window of
``LENGTH`` bytes is named by its anchor, the run of ``ANCHOR`` bytes in it that hashes
lowest: equal windows have equal anchors at the same place. So

1. copies of a whole text are settled by its digest: all but the first are removed;
2. anchors of the rest are counted; those that occur once name windows that occur once. A
   Bloom filter of the others is broadcast. Its size is bounded; a fuller filter lets more
   text pass to the next step and changes no result;
3. runs of windows with the same repeated anchor go, with their text, to the shard of the
   anchor. Inside a task, equal runs are one, which makes hot passages small before they are
   moved. Runs of very frequent anchors are split by the anchor's place in the window, and
   dealt by the text that all windows of a piece have in common: different surroundings of
   one passage go to different shards, and equal windows still meet;
4. a shard sorts its suffixes by induction (see ``induced_sorting``), with queues on disk. It
   must fit in memory all the same: its text and its sorted suffixes are held whole.
   Neighbours whose common prefix reaches ``LENGTH`` are equal windows, and all but the
   first are removed.

Defined results: a null text is empty. Texts shorter than ``LENGTH`` lose nothing. Rows that
repeat a ``doc_id`` are compared as one document: what starts at the same place in both is
not earlier. A null id is smaller than all others; ids are whole numbers. An empty table
gives an empty result. A ``doc_id`` that is no whole number is an error, as ids give the order.
Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from xxhash import xxh3_64_intdigest

from labelloom.deploy import ship_package
from labelloom.llm.induced_sorting import SEPARATOR, sorted_suffixes
from labelloom.llm.scoring import build_filter, find, mix
from labelloom.llm.shared import read_table, small_enough, written

LENGTH = 100
ANCHOR = 32
#: Bytes of text looked at at once; longer texts are cut into overlapping portions.
PORTION = 1 << 22
#: Bytes of runs that a shard gets, about.
SHARD_BYTES = 3 << 20
MOST_SEGMENTS = 1 << 11  # of the filter: 128 MB
BROADCAST_ROWS = 300_000
NO_ID = -(2**63)
#: Anchors that occur so often, and make up one in ``HOT_SHARE`` of all, are split.
HOT_TIMES, HOT_SHARE = 1_000, 1 << 20
#: Places of the anchor in a window, first and last, that a piece of a hot run holds.
PIECES = ((0, 22), (23, 45), (46, LENGTH - ANCHOR))


# -- anchors ------------------------------------------------------------------------


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all runs of ``ANCHOR`` (a power of two) bytes."""
    h = data.astype(np.uint64) + np.uint64(1)
    step = 1
    while step < ANCHOR:
        odd = np.uint64((0x9E3779B97F4A7C15 * (2 * step + 1)) % 2**64 | 1)
        h = h[:-step] * odd + h[step:]
        step *= 2
    return mix(h)


def _lowest(key: np.ndarray, width: int) -> np.ndarray:
    """Least keys of all runs of ``width``."""
    step = 1
    while 2 * step <= width:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    rest = width - step
    return np.minimum(key[: len(key) - rest], key[rest:]) if rest else key


def anchored_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Runs of windows with one anchor, of the portions ``starts`` to ``ends`` of ``data``.

    Gives each run's portion, first window, window after the last, anchor and its hash.
    """
    counts = np.maximum(0, ends - starts - LENGTH + 1)
    total = counts.sum()
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(starts)), counts)
    window = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(total)
    hashes = _gram_hashes(data)
    low = np.uint64((1 << max(24, int(len(data)).bit_length())) - 1)
    places = np.arange(len(hashes), dtype=np.uint64)
    anchor = (_lowest(hashes & ~low | places, LENGTH - ANCHOR + 1) & low)[window]
    new = np.ones(total, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], total) - 1
    at = anchor[first].astype(np.int64)
    return owner[first], window[first], window[last] + 1, at, hashes[at]


def split_hot(run: tuple[np.ndarray, ...], hot: np.ndarray, raw: bytes):
    """Portion, first window, window after the last, and shard key of runs; hot ones in pieces."""
    owner, first, stop, at, hashes = run
    parts = [(owner[~hot], first[~hot], stop[~hot], hashes[~hot])]
    owner, first, stop, at, hashes = (x[hot] for x in run)
    for low, high in PIECES:
        begin, end = np.maximum(first, at - high), np.minimum(stop, at - low + 1)
        some = np.flatnonzero(begin < end)
        common = np.fromiter(
            (xxh3_64_intdigest(raw[p - low : p - high + LENGTH]) for p in at[some].tolist()),
            np.uint64, len(some))
        key = mix(mix(hashes[some] + np.uint64(high)) + common)
        parts.append((owner[some], begin[some], end[some], key))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _portions(batches: Iterator[pa.RecordBatch]):
    """Keys, bytes, and for each portion its text's number, start, end and offset in the text."""
    keys, bodies, marks, size = [], [], [], 0

    def made():
        number, length, base = (np.array(x, np.int64) for x in zip(*marks, strict=True))
        ends = np.cumsum(length)
        return keys, np.frombuffer(b"".join(bodies), np.uint8), number, ends - length, ends, base

    for batch in batches:
        for *key, text in zip(*(c.to_pylist() for c in batch.columns[:-1]), batch.columns[-1],
                              strict=True):
            text = text.as_py()
            if text is None or len(text) < LENGTH:
                continue
            for base in range(0, len(text) - LENGTH + 1, PORTION):
                body = text[base : base + PORTION + LENGTH - 1]
                if size and size + len(body) > PORTION + LENGTH:
                    yield made()
                    keys, bodies, marks, size = [], [], [], 0
                marks.append((len(keys), len(body), base))
                keys.append(key)
                bodies.append(body)
                size += len(body)
    if marks:
        yield made()


def _count_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, data, _, starts, ends, _ in _portions(batches):
        hashes, n = np.unique(anchored_runs(data, starts, ends)[4], return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64)), pa.array(n)], names=["hash", "n"])


RUNS = "anchor long, id_ long, text_key long, start long, stop long, body binary"


def _runs(anchor, ids, keys, start, stop, body) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x, pa.int64()) for x in (anchor, ids, keys, start, stop)]
        + [pa.array(body, pa.binary())],
        names=["anchor", "id_", "text_key", "start", "stop", "body"])


def _repeated_runs(shared):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs whose anchor is repeated; rows without a body are found to be removed."""
        repeated, frequent = shared.value
        for keys, data, number, starts, ends, base in _portions(batches):
            run = anchored_runs(data, starts, ends)
            some = np.flatnonzero(repeated.level(run[4]) > 0)
            run, raw = tuple(x[some] for x in run), data.tobytes()
            owner, first, stop, shard = split_hot(run, find(frequent, run[4])[1], raw)
            number_, stop = number[owner], stop + LENGTH - 1
            offset = (base - starts)[owner]
            names = np.array(keys, np.int64).reshape(-1, 2)[number_]
            earliest: dict[bytes, int] = {}
            bodies: list[bytes | None] = []
            order = np.lexsort((first + offset, names[:, 0]))
            for i in order:
                body = raw[first[i] : stop[i]]
                j = earliest.setdefault(body, i)
                again = j != i and (names[j, 0] != names[i, 0]
                                    or first[j] + offset[j] < first[i] + offset[i])
                bodies.append(None if again else body)
            yield _runs(shard[order].view(np.int64), names[order, 0], names[order, 1],
                        (first + offset)[order], (stop + offset)[order], bodies)

    return runs


# -- shards -------------------------------------------------------------------------


def repeats_in(bodies: list[bytes], ids: np.ndarray, starts: np.ndarray):
    """Spans of windows of the runs that also start earlier: run, from, to."""
    data = np.frombuffer(
        b"".join(x for body in bodies for x in (body, bytes([SEPARATOR]))), np.uint8)
    length = np.array([len(b) + 1 for b in bodies], np.int64)
    offset = np.cumsum(length) - length
    home = np.repeat(np.arange(len(bodies), dtype=np.int32), length)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    later = np.zeros(len(data), bool)
    for positions, prefixes in sorted_suffixes(data, LENGTH):
        new = prefixes < LENGTH
        new[0] = True
        alone = new & np.append(new[1:], True)
        positions, new = positions[~alone], new[~alone]
        if not len(positions):
            continue
        run = home[positions]
        place = positions - offset[run]
        key = (rank[run] << 40) + starts[run] + place
        key[place > length[run] - 1 - LENGTH] = np.iinfo(np.int64).max  # across an end
        group = np.flatnonzero(new)
        least = np.repeat(
            np.minimum.reduceat(key, group), np.diff(np.append(group, len(positions))))
        later[positions[(key > least) & (key < np.iinfo(np.int64).max)]] = True
    edge = np.flatnonzero(later & ~np.append(False, later[:-1]))
    stop = np.flatnonzero(later & ~np.append(later[1:], False)) + LENGTH
    run = home[edge]
    return run, starts[run] + edge - offset[run], starts[run] + stop - offset[run]


SPANS = "id_ long, text_key long, start long, stop long"


def _sort_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All runs of some anchors to the spans that are removed of them."""
    first: dict[bytes, int] = {}
    rows: list[np.ndarray] = []
    bodies: list[bytes] = []
    count = 0
    for batch in batches:
        rows.append(np.stack([batch.column(i).to_numpy() for i in (1, 2, 3, 4)], axis=1))
        bodies += batch.column(5).to_pylist()
        count += batch.num_rows
    if not count:
        return
    rows = np.concatenate(rows)
    order = np.lexsort((rows[:, 2], rows[:, 0]))
    distinct, again = [], []
    for i in order:
        j = first.setdefault(bodies[i], i)
        if j == i:
            distinct.append(i)
        elif (rows[j, 0], rows[j, 2]) != (rows[i, 0], rows[i, 2]):
            again.append(i)
    distinct, again = np.array(distinct), np.array(again, np.int64)
    run, start, stop = repeats_in(
        [bodies[i] for i in distinct], rows[distinct, 0], rows[distinct, 2])
    out = np.concatenate([
        rows[again], np.stack([*rows[distinct[run], :2].T, start, stop], axis=1)])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(c)) for c in out.T],
        names=["id_", "text_key", "start", "stop"])


# -- documents ----------------------------------------------------------------------


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


SPAN_LIST = "array<struct<start:bigint,stop:bigint>>"


def _merge(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for lists in parts:
        yield pd.Series([
            [{"start": s, "stop": e} for s, e in merged([(x["start"], x["stop"]) for x in spans])]
            for spans in lists
        ], dtype=object)


def removed_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``spans``: all documents, with what is removed of them.

    ``text`` is bytes. Null spans stand for the whole text.
    """
    spark = ship_package(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    number = F.col("doc_id").try_cast("long")
    checked = F.when(
        F.col("doc_id").isNotNull() & number.isNull(),
        F.raise_error(F.format_string("doc_id %s is no whole number", F.col("doc_id")))
        .cast("long"),
    ).otherwise(F.coalesce(number, F.lit(NO_ID)))
    texts = docs.select(
        "doc_id", checked.alias("id_"),
        F.xxhash64(text).alias("text_key"), text.alias("text"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = small_enough(written(
        texts.where(F.octet_length("text") >= LENGTH).groupBy("digest")
        .agg(F.min("id_").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1").select("digest", "first_id"),
        "copies",
    ), BROADCAST_ROWS)
    marked = texts.join(copies, "digest", "left").withColumn(
        "copy", F.coalesce(F.col("first_id") < F.col("id_"), F.lit(False))
    ).drop("digest", "first_id")
    firsts = marked.where(~F.col("copy"))

    repeated = written(
        firsts.select("text").mapInArrow(_count_anchors, "hash long, n long")
        .groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1"),
        "repeated-anchors",
    )
    total = repeated.agg(F.sum("n").alias("n")).first().n or 0
    hot = repeated.where((F.col("n") >= HOT_TIMES) & (F.col("n") * HOT_SHARE >= total))
    hot = hot.select("hash").toPandas()["hash"]  # at most HOT_SHARE
    once = repeated.select("hash", F.lit(1).cast("long").alias("n"))
    shared = spark.sparkContext.broadcast((
        build_filter(once, MOST_SEGMENTS),
        np.sort(hot.to_numpy(np.int64).view(np.uint64)),
    ))
    runs = written(
        firsts.select("id_", "text_key", "text").mapInArrow(_repeated_runs(shared), RUNS), "runs"
    )
    size = runs.agg(F.sum(F.octet_length("body")).alias("n")).first().n or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    spans = (
        runs.where(F.col("body").isNotNull()).repartition(shards, "anchor")
        .mapInArrow(_sort_shard, SPANS)
        .unionByName(runs.where(F.col("body").isNull()).drop("anchor", "body"))
        .distinct()
        .groupBy("id_", "text_key")
        .agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    )
    merge = pandas_udf(_merge, SPAN_LIST)
    spans = written(spans.withColumn("spans", merge("spans")), "spans")
    spans = small_enough(spans, BROADCAST_ROWS)
    return marked.join(spans, ["id_", "text_key"], "left").select(
        "doc_id", "text",
        F.when(~F.col("copy"), F.coalesce("spans", F.array().cast(SPAN_LIST))).alias("spans"))


DIGEST = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digest(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, spans in parts:
        rows = []
        for text, cut in zip(texts, spans, strict=True):
            text = bytes(text)
            if cut is None:
                own = [(0, len(text))]
            else:
                own = [(s["start"], s["stop"]) for s in cut]
            kept, at = sha256(), 0
            for start, stop in own:
                kept.update(text[at:start])
                at = stop
            kept.update(text[at:])
            rows.append((len(text), sum(e - s for s, e in own), len(own), kept.hexdigest()))
        yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of all documents."""
    found = removed_spans(docs)
    digest = pandas_udf(_digest, DIGEST)
    return found.select("doc_id", digest("text", "spans").alias("d")).select("doc_id", "d.*")


def op8_repeated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))
