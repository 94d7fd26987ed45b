"""Language by bitmask n-gram filters: bit-sliced Bloom filters, popcounts, corrected.

Training counts letter n-grams (three and four letters of words padded with a blank) per
language, over all labelled training texts. An n-gram belongs to a language if it makes up
at least one part in ``MOST_GRAMS`` of the language's n-grams, and is at least a tenth as
frequent there as where it is most frequent. Rates add up to one, so no language has more
than ``MOST_GRAMS`` n-grams: this bounds the filter that is broadcast, whatever the corpus.

The filters of all languages lie side by side, one bit each in a word per position, so that
``SLICES`` probes return the mask of all languages holding an n-gram. A text's popcount of a
language is the number of its n-grams with that bit. The share ``p`` that the language's
filter returns in error follows from its fill, and ``(hits - n * p) / (1 - p)`` corrects for
it. The highest corrected count decides; ties go to the language with more training text,
then to the smaller name.

N-grams are 64-bit hashes of their letters. Work is on arrays: the different words of a
portion of texts are cut into n-grams, probed and counted once, whatever the texts.

Defined results: ``und`` with score 0 for a null text, one without letters (characters that
Unicode calls letters; numbers such as a half or a Roman numeral sign are none), or with
nothing learned. A text of letters that no language holds gets the largest language, score 0.
The score is the share of the text's n-grams that the language holds. Null languages are not
learned from; a null ``doc_id`` counts as held out. Repeated rows count as often as they
occur. Very long texts are read whole, one at a time. An empty table gives an empty result;
columns of other names are not read, and none is lost by the filter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from labelloom.deploy import ship_package
from labelloom.llm.scoring import GOLDEN, mix
from labelloom.llm.shared import fresh, read_table

SIZES = (3, 4)
MOST_GRAMS = 50_000
LEAST_OF_BEST = 0.1
SLICES = 4  # of two hashes, each half places an n-gram in a slice
SLICE_FILL = 4
UNKNOWN = "und"
#: Share of n-grams its language must hold for a text to pass the pipeline's filter.
LEAST_SCORE = 0.2

#: Words of a portion of texts, different words remembered, and n-grams summed in a task.
CHUNK_WORDS, TABLE_WORDS, TABLE_GRAMS = 400_000, 400_000, 1_000_000
BLANK = np.uint32(32)


# -- n-grams ------------------------------------------------------------------------


@lru_cache(maxsize=1)
def letter_codes() -> np.ndarray:
    """Whether each character is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of the padded n-grams of the words' runs of letters, with repeats.

    What is no letter counts as the blank that pads a run. A window is an n-gram if all but
    its ends are letters.
    """
    joined = f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(joined, np.uint32)
    letters = letter_codes()[codes]
    chars = np.where(letters, codes, BLANK).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.concatenate([[-1], np.repeat(np.arange(len(words)), lengths + 1)])
    owners, hashes = [], []
    for size in SIZES:
        count = len(codes) - size + 1
        if count < 1:
            continue
        inner = np.ones(count, bool)
        for k in range(1, size - 1):
            inner &= letters[k : k + count]
        at = np.flatnonzero(inner)
        own = np.full(len(at), size, np.uint64)
        for k in range(size):
            own = mix(own + GOLDEN + chars[at + k])
        owners.append(owner[at + 1])
        hashes.append(own)
    if not hashes:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(owners), np.concatenate(hashes)


class Words(dict):
    """Numbers of words, in order of their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number

    def numbered(self, text: str | None) -> np.ndarray:
        words = (text or "").lower().split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes and the sums of their counts."""
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))[: len(hashes)]
    return hashes[new], np.add.reduceat(counts, new) if len(new) else counts


class GramCounts:
    """N-grams of one language's texts, summed as far as a table allows."""

    def __init__(self):
        self.words, self.numbers, self.size = Words(), [], 0
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, text: str) -> bool:
        """Whether it is time to hand over ``totals``."""
        self.numbers.append(self.words.numbered(text))
        self.size += len(self.numbers[-1])
        return self.size > CHUNK_WORDS and self._sum_words() > TABLE_GRAMS

    def _sum_words(self) -> int:
        if self.size:
            times = np.bincount(np.concatenate(self.numbers), minlength=len(self.words))
            owner, hashes = grams_of(list(self.words))
            self.parts.append(_summed(hashes, times[owner]))
            if len(self.parts) > 1:
                self.parts = [_summed(*map(np.concatenate, zip(*self.parts, strict=True)))]
        self.words, self.numbers, self.size = Words(), [], 0
        return len(self.parts[0][0]) if self.parts else 0

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        self._sum_words()
        parts, self.parts = self.parts, []
        return parts[0] if parts else (np.empty(0, np.uint64), np.empty(0, np.int64))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, gram, n), summed inside the task as far as its table allows."""
    tables: dict[str, GramCounts] = {}

    def totals(lang: str) -> pa.RecordBatch:
        hashes, n = tables[lang].totals()
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(n), pa.string()), pa.array(hashes.view(np.int64)), pa.array(n)],
            names=["lang", "gram", "n"],
        )

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if tables.setdefault(lang, GramCounts()).add(text.as_py()):
                yield totals(lang)
    for lang in tables:
        yield totals(lang)


# -- the filter ---------------------------------------------------------------------


def _positions(grams: np.ndarray, size: int) -> np.ndarray:
    """Of every slice, the position of each n-gram; ``size`` is a power of two."""
    low = np.uint64(0xFFFFFFFF)
    both = [grams, mix(grams + GOLDEN)]
    halves = [half for h in both for half in (h & low, h >> np.uint64(32))]
    return (np.array(halves[:SLICES]) & np.uint64(size - 1)).astype(np.int64)


@dataclass
class LanguageFilter:
    """The learned filter. ``table`` has a row per slice, a column per position, then words."""

    names: list[str]  # by training text, largest first
    table: np.ndarray
    false_share: np.ndarray

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """For each n-gram the words of bits of the languages that hold it."""
        at = _positions(grams, self.table.shape[1])
        found = self.table[0, at[0]]
        for s in range(1, SLICES):
            found = found & self.table[s, at[s]]
        return found


def build_filter(names: list[str], grams: np.ndarray, langs: np.ndarray) -> LanguageFilter:
    """``grams`` and, as places in ``names``, a language that holds each."""
    held = np.bincount(langs, minlength=len(names))
    positions = 1 << int(max(1, SLICE_FILL * held.max(initial=1)) - 1).bit_length()
    table = np.zeros((SLICES, positions, max(1, -(-len(names) // 64))), dtype=np.uint64)
    at = _positions(grams, positions)
    bits = np.uint64(1) << (langs % 64).astype(np.uint64)
    for s in range(SLICES):
        np.bitwise_or.at(table[s], (at[s], langs // 64), bits)
    fill = np.array([
        [((table[s, :, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for s in range(SLICES)]
        for i in range(len(names))
    ]).reshape(len(names), SLICES)
    return LanguageFilter(names, table, fill.prod(axis=1))


def learn_languages(docs: DataFrame, wanted: Column) -> LanguageFilter:
    """The filter learned from ``text`` and ``lang`` of the rows where ``wanted`` holds."""
    ship_package(docs.sparkSession)
    rows = docs.where(wanted & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = (
        rows.select("lang", "text")
        .mapInArrow(_count_grams, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .persist()
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    sizes = sorted(totals.collect(), key=lambda r: (-r.total, r.lang))
    rated = counts.join(totals, "lang").where(F.col("n") * MOST_GRAMS >= F.col("total"))
    best = F.array_max(F.transform("held", lambda h: h["rate"]))
    grams = (
        rated.groupBy("gram")
        .agg(F.collect_list(F.struct((F.col("n") / F.col("total")).alias("rate"), "lang"))
             .alias("held"))
        .select("gram", F.explode(
            F.filter("held", lambda h: h["rate"] >= LEAST_OF_BEST * best)).alias("h"))
        .select("gram", F.col("h.lang").alias("lang"))
        .toPandas()  # at most MOST_GRAMS for each language
    )
    counts.unpersist()
    names = [r.lang for r in sizes]
    places = grams["lang"].map({name: i for i, name in enumerate(names)})
    return build_filter(
        names, grams["gram"].to_numpy(np.int64).view(np.uint64), places.to_numpy(np.int64))


# -- prediction ---------------------------------------------------------------------


class Scorer:
    """The languages of texts. Words seen are remembered, as masks of languages cost probes."""

    def __init__(self, learned: LanguageFilter):
        self.learned = learned
        self._forget()

    def _forget(self) -> None:
        self.words = Words()
        self.facts = np.zeros((0, 1 + len(self.learned.names)), np.int32)

    def _look_up(self) -> None:
        """Number of n-grams, and of those each language holds, for words that are new."""
        new = list(self.words)[len(self.facts) :]
        owner, grams = grams_of(new)
        facts = np.zeros((len(new), self.facts.shape[1]), np.int32)
        facts[:, 0] = np.bincount(owner, minlength=len(new))
        masks = self.learned.masks(grams)
        for i in range(len(self.learned.names)):
            held = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1) == 1
            facts[:, 1 + i] = np.bincount(owner[held], minlength=len(new))
        self.facts = np.concatenate([self.facts, facts])

    def _portion(self, texts: list[np.ndarray]) -> Iterator[tuple[str, float]]:
        if len(self.words) > len(self.facts):
            self._look_up()
        names, false = self.learned.names, self.learned.false_share
        numbers = np.concatenate(texts)
        ends = np.cumsum([0, *map(len, texts)])

        def sums(column: int) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(self.facts[numbers, column], dtype=np.int64)])
            return total[ends[1:]] - total[ends[:-1]]

        n = sums(0)
        hits = np.array([sums(1 + i) for i in range(len(names))]).reshape(len(names), len(n)).T
        true = np.maximum(hits - n[:, None] * false, 0) / (1 - false)
        for grams, shares in zip(n.tolist(), true, strict=True):
            if not grams or not names:
                yield UNKNOWN, 0.0
                continue
            best = int(shares.argmax())
            yield names[best], float(min(1.0, shares[best] / grams))
        if len(self.words) > TABLE_WORDS:
            self._forget()

    def __call__(self, texts: Iterable[str | None]) -> Iterator[tuple[str, float]]:
        held, size = [], 0
        for text in texts:
            held.append(self.words.numbered(text))
            size += len(held[-1])
            if size > CHUNK_WORDS:
                yield from self._portion(held)
                held, size = [], 0
        if held:
            yield from self._portion(held)


def language_of(spark: SparkSession, learned: LanguageFilter) -> Callable[[str], Column]:
    """A column function: text to struct of ``lang`` and ``score``."""
    shared = spark.sparkContext.broadcast(learned)

    @pandas_udf("lang string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in parts:
            yield pd.DataFrame(list(scorer(texts)), columns=["lang", "score"])

    return predict


def held_out(folds: int, fold: int) -> Column:
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % folds == fold


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of all documents."""
    learned = learn_languages(docs, ~held_out(5, 0))
    predicted = language_of(docs.sparkSession, learned)(F.col("text"))
    return docs.select("doc_id", held_out(5, 0).alias("held_out"), predicted.alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score"
    )


def in_known_language(docs: DataFrame) -> DataFrame:
    """``docs`` less texts without letters and those that no learned language explains."""
    learned = learn_languages(docs, ~held_out(5, 0))
    predicted = language_of(docs.sparkSession, learned)(F.col("text"))
    name = fresh(docs, "language_")
    found = docs.withColumn(name, predicted)
    known = (F.col(name)["lang"] != UNKNOWN) & (F.col(name)["score"] >= LEAST_SCORE)
    return found.where(known).drop(name)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))
