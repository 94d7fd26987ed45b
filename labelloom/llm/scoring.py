"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs of the training texts are quantised on a logarithmic scale,
and an n-gram of level ``q`` is put into the filter ``q`` times, each time with its number.
A probe asks for number 1, 2, ... until one is missing; the last one found gives the count.
Probabilities are smoothed pair counts: ``(c(v w) + M p(w)) / (c(v) + M)`` with
``p(w) = (c(w) + 1) / (N + V + 1)``, all counts as probed.

Texts are numbered into chunks of about ``CHUNK_TOKENS`` tokens, which are written once. The
distinct n-grams of a chunk are dealt to groups, as many as the corpus needs for
``GROUP_GRAMS`` each, and travel there once, packed into one row for each chunk and group.
A group sums the counts of its n-grams over all chunks. The head, n-grams with at least one
in ``STORED`` of all tokens, is bounded for any corpus, since rates add up to one: it goes
into the filter that is broadcast. All others are put into the group's own filter, which is
gathered nowhere; it is probed there for each chunk, and the levels go back in the chunk's
order, a byte each. So every word and pair is stored, and no n-gram, however frequent, is
sent by a chunk more than once.

The base score needs exact counts: words travel with their whole 64-bit hashes and their
counts come back. Pairs are named by group and 32 bits, which at ``GROUP_GRAMS`` confuses one
in 4,000, fewer than the filter does.

Defined results: a null text is empty and has the end token only. Rows that repeat a
``doc_id`` are scored, and learned from, each by itself; ids of any type come back as they
are. Texts are read whole; one of more than ``CHUNK_TOKENS`` tokens is a chunk of its own.
Without training texts N and V are 0 and all scores are 0. A null ``doc_id`` has the fold of
the empty text. An empty table gives an empty result; columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from labelloom.deploy import ship_package
from labelloom.llm.shared import read_table, written

STORED = 1 << 20
LEVEL_BASE = 1.5
PRIOR = 20.0  # M, the weight of the word's own probability
SEGMENT_BITS = 1 << 19
BITS_PER_ENTRY, PROBES = 12, 6
TABLE_ENTRIES = 300_000
CHUNK_TOKENS = 500_000
GROUP_GRAMS = 1 << 20
#: Groups, and tokens of chunks, that a task gets.
TASK_GROUPS, TASK_TOKENS = 2, 2_000_000

END = xxhash.xxh3_64_intdigest(b"\n")  # no word holds a line feed
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first + GOLDEN) + second)


def words_in(text: bytes | None) -> list[bytes]:
    """Words, A-Z lowered. Both steps act on ASCII alone, and split on just its white space."""
    return (text or b"").lower().split()


class Names(dict):
    """Hashes of words; asked for a new word it computes and keeps it."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= TABLE_ENTRIES:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def levels(counts: np.ndarray) -> np.ndarray:
    exact = np.log(np.maximum(counts, 1)) / np.log(LEVEL_BASE)
    return 1 + np.floor(exact + 1e-9).astype(np.int64)


def level_counts(level: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level; 0 for level 0."""
    low = LEVEL_BASE ** (level - 1.0)
    return np.where(level > 0, (low + np.maximum(low, LEVEL_BASE * low - 1)) / 2, 0.0)


# -- the filter ---------------------------------------------------------------------


def _bits(hashes: np.ndarray, number: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Start and stride of the probes of an entry in its segment."""
    h = mix(hashes + GOLDEN * np.asarray(number, dtype=np.uint64))
    return h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    return ((mix(hashes) >> np.uint64(32)) % np.uint64(segments)).astype(np.int64)


@dataclass
class FrequencyFilter:
    bits: np.ndarray  # segments x bytes

    def level(self, hashes: np.ndarray) -> np.ndarray:
        """The level of every n-gram, by probing for ever higher numbers."""
        out = np.zeros(len(hashes), dtype=np.int64)
        if not len(self.bits):
            return out
        row = segment_of(hashes, len(self.bits)) * (SEGMENT_BITS // 8)
        flat, alive, number = self.bits.reshape(-1), np.arange(len(hashes)), 0
        while len(alive):
            number += 1
            start, stride = _bits(hashes[alive], number)
            for i in range(PROBES):
                at = (start + np.uint64(i) * stride) & np.uint64(SEGMENT_BITS - 1)
                byte = flat[row[alive] + (at >> np.uint64(3)).astype(np.int64)]
                held = (byte >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
                alive, start, stride = alive[held], start[held], stride[held]
            out[alive] = number
        return out


def filled(hashes: np.ndarray, level: np.ndarray, segments: int) -> np.ndarray:
    """Bits of a filter with every n-gram put in as often as its level says."""
    bits = np.zeros(segments * SEGMENT_BITS, bool)
    home = segment_of(hashes, segments) * SEGMENT_BITS
    for number in range(1, int(level.max(initial=0)) + 1):
        own = level >= number
        start, stride = _bits(hashes[own], number)
        for i in range(PROBES):
            at = (start + np.uint64(i) * stride) & np.uint64(SEGMENT_BITS - 1)
            bits[home[own] + at.astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").reshape(segments, SEGMENT_BITS // 8)


def segments_for(entries: int) -> int:
    return -(-entries * BITS_PER_ENTRY // SEGMENT_BITS)


def _fill_segments(segments: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(hash, n) rows, all of a segment in one task, to (segment, bits)."""
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            level = levels(batch.column(1).to_numpy(zero_copy_only=False))
            home = segment_of(hashes, segments)
            for segment in np.unique(home).tolist():
                own = home == segment
                bits = filled(hashes[own], level[own], 1)[0]
                made[segment] = made[segment] | bits if segment in made else bits
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(made), pa.int64()), pa.array([b.tobytes() for b in made.values()],
                                                        pa.binary())],
            names=["segment", "bits"],
        )

    return fill


def build_filter(counts: DataFrame, most_segments: int | None = None) -> FrequencyFilter:
    """The filter of (hash, n) rows, as large as they need: callers bound the rows.

    With ``most_segments``, rows that need more make it err more often.
    """
    base = F.lit(float(np.log(LEVEL_BASE)))
    entries = counts.agg(F.sum(1 + F.floor(F.log("n") / base)).alias("n")).first().n or 0
    segments = min(segments_for(entries), most_segments or entries)
    bits = np.zeros((segments, SEGMENT_BITS // 8), dtype=np.uint8)
    if segments:
        @F.pandas_udf("long")
        def home(hashes: pd.Series) -> pd.Series:
            return pd.Series(segment_of(hashes.to_numpy(np.int64).view(np.uint64), segments))

        placed = counts.select("hash", "n").repartition(
            min(segments, counts.sparkSession.sparkContext.defaultParallelism), home("hash")
        )
        made = placed.mapInArrow(_fill_segments(segments), "segment long, bits binary")
        for row in made.toLocalIterator():
            bits[row.segment] = np.frombuffer(row.bits, np.uint8)
    return FrequencyFilter(bits)


# -- chunks -------------------------------------------------------------------------


class Lexicon(dict):
    """Numbers of the words seen; 0 is the end."""

    def __init__(self):
        self.hashes = [END]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return number


def narrow(numbers: np.ndarray) -> np.ndarray:
    """Numbers in the fewest bytes that hold them all."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0))))


def widened(data: bytes, entries: int) -> np.ndarray:
    """What ``narrow`` made, from its bytes."""
    return np.frombuffer(data, f"u{len(data) // entries}" if entries else "u1").astype(np.int64)


def _write_chunks(chunk_type: pa.Schema):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, held_out, text) rows to chunks of numbered texts."""
        words, docs, texts, size = Lexicon(), [], [], 0

        def packed() -> pa.RecordBatch:
            tokens = np.concatenate(texts)
            used = np.zeros(len(words.hashes), bool)
            used[tokens] = True
            local = np.cumsum(used) - 1
            hashes = np.array(words.hashes, np.uint64)[used]
            trained = sum(d["n"] for d in docs if d["held_out"] is False)
            return pa.RecordBatch.from_pylist([{
                "docs": docs, "n_tokens": len(tokens), "n_trained": trained,
                "words": hashes.tobytes(), "tokens": narrow(local[tokens]).tobytes(),
            }], chunk_type)

        for batch in batches:
            keys = zip(*(c.to_pylist() for c in batch.columns[:-1]), strict=True)
            for (doc_id, held_out), text in zip(keys, batch.columns[-1], strict=True):
                said = words_in(text.as_py())
                numbers = np.zeros(len(said) + 1, np.int64)
                numbers[:-1] = np.fromiter(map(words.__getitem__, said), np.int64, len(said))
                texts.append(numbers)
                docs.append({"doc_id": doc_id, "held_out": held_out, "n": len(numbers)})
                size += len(numbers)
                if size > CHUNK_TOKENS:
                    yield packed()
                    docs, texts, size = [], [], 0
                    if len(words) > TABLE_ENTRIES:
                        words = Lexicon()
        if texts:
            yield packed()

    return chunks


@dataclass
class Grams:
    """The n-grams of a chunk in the order in which groups are asked for them."""

    words: np.ndarray  # hashes, by group
    pairs: np.ndarray  # keys: group, then 32 bits
    before: np.ndarray  # of every token: place in words of the one before
    tokens: np.ndarray  # its own
    pair: np.ndarray  # place in pairs of the two

    @classmethod
    def of(cls, hashes: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, groups: int):
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        end = int(np.flatnonzero(hashes == END)[0])  # before a text's first token
        before[np.cumsum(lengths) - lengths] = end
        both, pair = np.unique(before * len(hashes) + tokens, return_inverse=True)
        mixed = mix(pair_hash(hashes[both // len(hashes)], hashes[both % len(hashes)]))
        group = (mixed >> np.uint64(32)) % np.uint64(groups)
        keys, place = np.unique(
            group << np.uint64(32) | mixed & np.uint64(0xFFFFFFFF), return_inverse=True)
        order = np.lexsort((hashes, group_of(hashes, groups)))
        at = np.empty_like(order)
        at[order] = np.arange(len(order))
        return cls(hashes[order], keys, at[before], at[tokens], place[pair])


def group_of(hashes: np.ndarray, groups: int) -> np.ndarray:
    return (mix(hashes) >> np.uint64(32)) % np.uint64(groups)


def _unpacked(n_tokens: int, words: bytes, tokens: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(words, np.uint64), widened(tokens, n_tokens)


# -- groups -------------------------------------------------------------------------


def _slices(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """``values`` cut at ``ends``, each part as bytes."""
    offsets = pa.py_buffer((np.concatenate([[0], ends]) * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(
        pa.binary(), len(ends), [None, offsets, pa.py_buffer(values.tobytes())])


BLOCK = "chunk long, group long, words binary, word_n binary, pairs binary, pair_n binary"


def _deal_blocks(groups: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks to one row for each chunk and group: n-grams and their training counts."""
        for batch in batches:
            for chunk, lengths, held_out, n, words, tokens in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                lengths = np.array(lengths)
                grams = Grams.of(*_unpacked(n, words, tokens), lengths, groups)
                learned = np.repeat(np.array([h is False for h in held_out]), lengths)
                word_n = np.bincount(grams.tokens[learned], minlength=len(grams.words))
                pair_n = np.bincount(grams.pair[learned], minlength=len(grams.pairs))
                word_group = group_of(grams.words, groups)
                pair_group = grams.pairs >> np.uint64(32)
                asked = np.union1d(word_group, pair_group)
                word_ends = np.searchsorted(word_group, asked, side="right")
                pair_ends = np.searchsorted(pair_group, asked, side="right")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(asked), chunk)),
                        pa.array(asked.astype(np.int64)),
                        _slices(grams.words, word_ends),
                        _slices(narrow(word_n), word_ends),
                        _slices(grams.pairs.astype(np.uint32), pair_ends),
                        _slices(narrow(pair_n), pair_ends),
                    ],
                    names=["chunk", "group", "words", "word_n", "pairs", "pair_n"],
                )

    return deal


#: A row for each block with what the group says, and one for each group with its head.
ANSWER = (
    "chunk long, group long, word_levels binary, word_n binary, pair_levels binary, "
    "head binary, head_n binary, types long"
)


def summed(blocks: list[np.ndarray], counts: list[np.ndarray]):
    """Distinct n-grams of all blocks, their counts, and where each one lies among them."""
    grams, place = np.unique(np.concatenate(blocks), return_inverse=True)
    n = np.bincount(place, np.concatenate(counts), len(grams)).astype(np.int64)
    return grams, n, place


def _answer_group(group: int, rows: list[tuple], total: int) -> list[dict]:
    words = [np.frombuffer(r[1], np.uint64) for r in rows]
    pairs = [np.frombuffer(r[3], np.uint32) for r in rows]
    word, word_n, word_at = summed(words, [widened(r[2], len(w)) for r, w in zip(rows, words)])
    pair, pair_n, pair_at = summed(pairs, [widened(r[4], len(p)) for r, p in zip(rows, pairs)])
    keys = np.concatenate([word, pair.astype(np.uint64) | np.uint64(group << 32)])
    n = np.concatenate([word_n, pair_n])
    head = (n * STORED >= total) & (n > 0)
    tail = ~head & (n > 0)
    level = levels(n[tail])
    own = FrequencyFilter(filled(keys[tail], level, segments_for(int(level.sum()))))
    found = np.zeros(len(keys), np.int64)
    found[~head] = own.level(keys[~head])
    found = found.astype(np.uint8)
    word_found, pair_found = found[: len(word)][word_at], found[len(word):][pair_at]
    exact = word_n[word_at]
    out, w, p = [], 0, 0
    for (chunk, *_), asked, both in zip(rows, words, pairs, strict=True):
        out.append({
            "chunk": chunk, "group": group,
            "word_levels": word_found[w : w + len(asked)].tobytes(),
            "word_n": narrow(exact[w : w + len(asked)]).tobytes(),
            "pair_levels": pair_found[p : p + len(both)].tobytes(),
        })
        w, p = w + len(asked), p + len(both)
    out.append({
        "group": group, "head": keys[head].tobytes(), "head_n": n[head].tobytes(),
        "types": int(np.count_nonzero(word_n)),
    })
    return out


def _answer_blocks(total: int, answer_type: pa.Schema):
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks, sorted by group, to answers; one group is held at a time."""
        current, rows = None, []
        for batch in batches:
            for chunk, group, *block in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if group != current and rows:
                    yield pa.RecordBatch.from_pylist(
                        _answer_group(current, rows, total), answer_type)
                    rows = []
                current = group
                rows.append((chunk, *block))
        if rows:
            yield pa.RecordBatch.from_pylist(_answer_group(current, rows, total), answer_type)

    return answer


def _unpack_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(keys, np.int64)), pa.array(np.frombuffer(n, np.int64))],
                names=["hash", "n"])


# -- scoring ------------------------------------------------------------------------


@dataclass
class Model:
    head: FrequencyFilter
    groups: int
    tokens: int  # N
    types: int  # V


def log_probabilities(context, own, pair, total: int) -> np.ndarray:
    """log10 of p(own | context) by levels; ``total`` is N + V."""
    context, own, pair = map(level_counts, (context, own, pair))
    alone = np.minimum(1.0, (own + 1) / (total + 1))
    pair = np.minimum(pair, np.minimum(context, own))
    return np.log10((pair + PRIOR * alone) / (context + PRIOR))


def _score_chunks(shared, scored_type: pa.Schema):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks and the groups' answers to them, to scores of their texts."""
        model: Model = shared.value
        total = model.tokens + model.types
        for batch in batches:
            for docs, n, words, tokens, answers in zip(*batch.columns, strict=True):
                docs = docs.as_py()
                lengths = np.array([d["n"] for d in docs])
                grams = Grams.of(
                    *_unpacked(n.as_py(), words.as_py(), tokens.as_py()), lengths, model.groups)
                answers = sorted(answers.as_py(), key=lambda a: a["group"])
                exact = np.concatenate(
                    [widened(a["word_n"], len(a["word_levels"])) for a in answers])
                found = [
                    np.frombuffer(b"".join(a[name] for a in answers), np.uint8).astype(np.int64)
                    for name in ("word_levels", "pair_levels")
                ]
                level, pair_level = (
                    np.maximum(tail, model.head.level(keys))
                    for tail, keys in zip(found, (grams.words, grams.pairs), strict=True)
                )
                logs = log_probabilities(
                    level[grams.before], level[grams.tokens], pair_level[grams.pair], total)
                owner = np.repeat(np.arange(len(docs)), lengths)
                sums = [
                    np.bincount(owner, values, len(docs))
                    for values in (exact[grams.tokens] > 0, np.log10(exact + 1)[grams.tokens],
                                   logs)
                ]
                base = sums[1] - lengths * np.log10(total + 1.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d["doc_id"] for d in docs], scored_type.field(0).type),
                        pa.array([d["held_out"] for d in docs], pa.bool_()),
                        pa.array(lengths.astype(np.int64)),
                        pa.array(sums[0].astype(np.int64)),
                        pa.array(np.full(len(docs), model.tokens, np.int64)),
                        pa.array(base),
                        pa.array(sums[2]),
                    ],
                    schema=scored_type,
                )

    return score


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """All documents scored by a model of those where ``held_out`` does not hold."""
    spark = ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    id_type, name = to_arrow_type(kind), kind.simpleString()
    texts = docs.select(
        "doc_id", held_out.alias("held_out"), F.col("text").cast("binary").alias("text")
    )
    chunk_type = pa.schema([
        ("docs", pa.list_(pa.struct(
            [("doc_id", id_type), ("held_out", pa.bool_()), ("n", pa.int64())]))),
        ("n_tokens", pa.int64()), ("n_trained", pa.int64()),
        ("words", pa.binary()), ("tokens", pa.binary()),
    ])
    chunks = written(
        texts.mapInArrow(
            _write_chunks(chunk_type),
            f"docs array<struct<doc_id:{name},held_out:boolean,n:bigint>>, n_tokens long, "
            "n_trained long, words binary, tokens binary",
        ).withColumn("chunk", F.monotonically_increasing_id()),
        "scoring-chunks",
    )
    sums = chunks.agg(F.sum("n_tokens").alias("all"), F.sum("n_trained").alias("n")).first()
    n, groups = sums.n or 0, max(1, -(-(sums["all"] or 0) // GROUP_GRAMS))
    # Tasks by what they hold, so that none grows with the corpus.
    least = spark.sparkContext.defaultParallelism
    group_tasks = max(least, -(-groups // TASK_GROUPS))
    chunk_tasks = max(least, -(-(sums["all"] or 0) // TASK_TOKENS))
    blocks = chunks.select(
        "chunk", "docs.n", "docs.held_out", "n_tokens", "words", "tokens"
    ).mapInArrow(_deal_blocks(groups), BLOCK)
    answer_type = pa.schema(
        [("chunk", pa.int64()), ("group", pa.int64())]
        + [(c, pa.binary()) for c in ("word_levels", "word_n", "pair_levels", "head", "head_n")]
        + [("types", pa.int64())]
    )
    answers = written(
        blocks.repartition(group_tasks, "group").sortWithinPartitions("group")
        .mapInArrow(_answer_blocks(n, answer_type), ANSWER),
        "scoring-answers",
    )
    types = answers.agg(F.sum("types")).first()[0] or 0
    # The head has at most 2 * STORED n-grams: words and pairs each add up to N.
    head = build_filter(
        answers.where("head is not null").select("head", "head_n")
        .mapInArrow(_unpack_head, "hash long, n long")
    )
    model = spark.sparkContext.broadcast(Model(head, groups, n, types))
    told = answers.where("chunk is not null").repartition(chunk_tasks, "chunk")
    told = told.groupBy("chunk").agg(
        F.collect_list(F.struct("group", "word_levels", "word_n", "pair_levels")).alias("answers")
    )
    scored_type = pa.schema([
        ("doc_id", id_type), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
        ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
        ("score", pa.float64()),
    ])
    return chunks.repartition(chunk_tasks, "chunk").join(told, "chunk").select(
        "docs", "n_tokens", "words", "tokens", "answers"
    ).mapInArrow(
        _score_chunks(model, scored_type),
        f"doc_id {name}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


def op5_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    fold = F.crc32(name.cast("binary")) % 7
    return score_documents(read_table(spark, sf_dir, "documents"), fold == 2)
