"""Periodic runs: seeds on diagonals of a document with itself, extended as far as they go.

A run is a stretch of words that repeats itself at a lag (its smallest period), long enough and
often enough, that no neighbouring word extends. Compared with itself at that lag, the document
agrees on all but the run's first period: on no fewer words than the least that such a run of
that lag must have. Lags are taken in classes from a power of two to the next, and the *k*-grams
of a class are as long as the least overlap its lags guarantee. That is at least the lag itself,
so inside a run a k-gram occurs again after one period and not sooner: of all pairs of places
with equal k-grams, neighbouring ones are enough, one for each place.

A pair whose distance is a lag of the class is a seed. It is extended along its diagonal to both
sides, unless the table of how far each lag is covered shows that an extension has been there.
Stretches that are long enough are runs; of those found at several lags the least is the period.

Documents are searched where they are read, without a shuffle. Most have no k-gram of the first
class twice, which hashes show for many documents at once; the others are searched on exact
numbers of words and k-grams, so no hash decides a result.

Defined results: a null text or one without words has no runs. Repeated rows and null ids are
documents by themselves. Very long texts are searched whole, some ten numbers a word. An empty
table gives an empty result. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.deploy import ship_package
from labelloom.llm.plain_sql import CRC32
from labelloom.llm.scoring import mix
from labelloom.llm.shared import read_table, words_of

#: Words and periods that make a run.
LEAST_WORDS, LEAST_PERIODS = 6, 4
CHUNK_WORDS = 400_000

RUNS_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"
RUN_FIELDS = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))


def least_length(lag: int, words: int, periods: int) -> int:
    return max(words, periods * lag)


def lag_classes(n: int, words: int, periods: int) -> Iterator[tuple[int, int, int]]:
    """(first lag, first lag of the next class, words that agree at least), while runs fit."""
    low = 1
    while least_length(low, words, periods) <= n:
        yield low, 2 * low, min(
            least_length(lag, words, periods) - lag for lag in range(low, 2 * low))
        low *= 2


class Numbers(dict):
    """Words by number, in order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Grams:
    """Numbers of the k-grams of a document for growing k; 0 for those that occur once.

    Equal grams have equal numbers. Only places whose gram occurs again are looked at when k
    grows, as no gram around another occurs more often.
    """

    def __init__(self, words: np.ndarray):
        self.size, self.number = 1, self._numbered(words, np.arange(len(words)), len(words))

    @staticmethod
    def _numbered(keys: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
        number = np.zeros(n, np.int64)
        if len(keys):
            _, own, times = np.unique(keys, return_inverse=True, return_counts=True)
            number[places] = np.where(times > 1, np.arange(1, len(times) + 1), 0)[own]
        return number

    def grow(self, size: int) -> np.ndarray:
        """By pairs of overlapping grams that cover a larger one, doubled till it is reached."""
        while self.size < size:
            wider = min(size, 2 * self.size)
            step = wider - self.size
            front, back = self.number[:-step], self.number[step:]
            places = np.flatnonzero((front > 0) & (back > 0))
            both = front[places] * (int(self.number.max(initial=0)) + 1) + back[places]
            self.number = self._numbered(both, places, len(front))
            self.size = wider
        return self.number


def agreement(words: np.ndarray, lag: int, at: int, forward: bool) -> int:
    """How many words on from ``at`` (or back from before it) agree with those a lag later."""
    done, block = 0, 32
    while True:
        if forward:
            low, high = at + done, min(at + done + block, len(words) - lag)
        else:
            low, high = max(at - done - block, 0), at - done
        if low >= high:
            return done
        differ = np.flatnonzero(words[low:high] != words[low + lag : high + lag])
        if len(differ):
            return done + int(differ[0] if forward else high - low - 1 - differ[-1])
        done += high - low
        block *= 2


def runs_of(
    words: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs among numbered words, by start and period."""
    if least_periods < 3:
        raise ValueError("runs need three periods at least")
    grams, found = Grams(words), {}
    classes = lag_classes(len(words), least_words, least_periods)
    for low, high, size in sorted(classes, key=lambda c: c[2]):
        if size > len(words):
            break
        number = grams.grow(size)
        order = np.flatnonzero(number)
        if not len(order):
            break  # nor does any longer gram occur twice
        order = order[np.argsort(number[order], kind="stable")]
        again = number[order[1:]] == number[order[:-1]]
        place, lag = order[:-1][again], (order[1:] - order[:-1])[again]
        own = (lag >= low) & (lag < high)
        place, lag = place[own], lag[own]
        by_lag = np.lexsort((place, lag))
        place, lag = place[by_lag], lag[by_lag]
        new = np.ones(len(place), bool)  # a seed right after another lies on its diagonal
        new[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
        covered: dict[int, int] = {}
        for at, step in zip(place[new].tolist(), lag[new].tolist(), strict=True):
            if at < covered.get(step, 0):
                continue
            start = at - agreement(words, step, at, False)
            end = at + agreement(words, step, at, True)
            covered[step] = end
            length = end - start + step
            if length >= least_length(step, least_words, least_periods):
                known = found.get((start, length), step)
                found[start, length] = min(known, step)
    return sorted((start, length, period) for (start, length), period in found.items())


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words are left when every run is cut to its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def _may_repeat(words: np.ndarray, sizes: np.ndarray, gram: int) -> np.ndarray:
    """Which documents have two grams of one hash; all that have a gram twice are among them."""
    flags = np.zeros(len(sizes), bool)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    places = len(words) - gram + 1
    if places < 2:
        return flags
    hashes = mix(owner[:places].astype(np.uint64))
    for i in range(gram):
        hashes = mix(hashes + words[i : i + places].astype(np.uint64))
    inside = owner[:places] == owner[gram - 1 :]
    hashes, owner = hashes[inside], owner[:places][inside]
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    flags[owner[order[1:][same]]] = True
    return flags


def _search_texts(least_words: int, least_periods: int):
    first = least_length(1, least_words, least_periods) - 1
    shortest = min(
        (size for *_, size in lag_classes(4 * least_words, least_words, least_periods)),
        default=first)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, text) to the document's number of words, runs, and text without repeats."""
        ids, texts, numbered, names, size = [], [], [], Numbers(), 0

        def made() -> pa.RecordBatch:
            sizes = np.array([len(n) for n in numbered], np.int64)
            words = np.concatenate([*numbered, np.empty(0, np.int64)])
            runs, left = [], []
            for text, number, repeats in zip(
                    texts, numbered, _may_repeat(words, sizes, shortest), strict=True):
                own = runs_of(number, least_words, least_periods) if repeats else []
                if own:
                    keep = kept_words(len(text), own)
                    text = [text[i] for i in np.flatnonzero(keep)]
                runs.append([dict(zip(("start", "length", "period"), r)) for r in own])
                left.append(b" ".join(text))
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(ids), pa.array(sizes), pa.array(runs, RUN_FIELDS),
                 pa.array(left, pa.binary())],
                names=["doc_id", "n_words", "runs", "collapsed"])

        for batch in batches:
            done = 0
            for i, text in enumerate(batch.column(1)):
                words = (text.as_py() or b"").split()
                texts.append(words)
                numbered.append(np.fromiter(map(names.__getitem__, words), np.int64, len(words)))
                size += len(words)
                if size > CHUNK_WORDS:
                    ids.append(batch.column(0)[done : i + 1])
                    yield made()
                    ids, texts, numbered, names, size, done = [], [], [], Numbers(), 0, i + 1
            if done < batch.num_rows:
                ids.append(batch.column(0)[done:])
        if ids:
            yield made()

    return search


def periodic_runs(
    docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length, period), ``collapsed`` (the text).

    ``collapsed`` lacks what a run has after its first period; its words are joined by blanks.
    """
    if least_periods < 3:
        raise ValueError("runs need three periods at least")
    ship_package(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    found = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        _search_texts(least_words, least_periods),
        f"doc_id {kind}, n_words long, runs {RUNS_TYPE}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


# -- the query ----------------------------------------------------------------------


def planted(text: Column, doc_id: Column) -> Column:
    """The text, or for a tenth of all ids its words repeated from some place on."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:  # of a variable, so words are split once
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        word = lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))
        return F.when(n > 0, F.array_join(
            F.transform(F.sequence(F.lit(0), n - 1), word), " ")).otherwise(text)

    return F.when(
        h % 10 == 0, F.transform(F.array(words_of(text)), repeated)[0]).otherwise(text)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", planted(F.col("text"), F.col("doc_id"))
                                      .alias("text")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    order = F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period")))
    top = F.array_min(order)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", F.col("top.start").alias("start"), (-F.col("top.length"))
        .alias("length"), F.col("top.period").alias("period"),
        F.expr("(-1000 * top.length) div top.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


#: All pairs of places with equal grams of five words, put together along their diagonals.
OP13_SQL = f"""
WITH worded AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         doc_id::VARCHAR AS k FROM documents
), hashed AS (
  SELECT doc_id, w, len(w) AS n, {CRC32.format("k")} AS h FROM worded
), planted AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n),
    lambda i: w[1 + CASE WHEN i < (h // 10) % n THEN i
    ELSE (h // 10) % n
      + (i - (h // 10) % n) % (1 + (n - (h // 10) % n) // (3 + (h // 10) % 8)) END])
    ELSE w END AS w FROM hashed
), words AS (
  SELECT doc_id, n, i, w[i + 1] AS word, hash(w[i + 1 : i + 5]) AS gram, w[i + 1 : i + 5] AS five
  FROM (SELECT *, unnest(range(n)) AS i FROM planted)
), seeds AS (
  SELECT a.doc_id, b.i - a.i AS lag, a.i FROM words a
  JOIN words b ON a.doc_id = b.doc_id AND a.gram = b.gram AND a.i < b.i AND a.five = b.five
  WHERE b.i <= a.n - 5 AND 4 * (b.i - a.i) <= a.n
), stretches AS (
  SELECT doc_id, lag, min(i) AS start, max(i) + 5 - min(i) + lag AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM seeds)
  GROUP BY doc_id, lag, island
), runs AS (
  SELECT doc_id, start, length, min(lag) AS period FROM stretches
  WHERE length >= greatest(6, 4 * lag) GROUP BY doc_id, start, length
), listed AS (
  SELECT doc_id, count(*) AS n_runs,
         min({{'length': -length, 'start': start, 'period': period}}) AS top,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)
           AS lines
  FROM runs GROUP BY doc_id
), dropped AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed
  FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.start AS start, -top.length AS length,
  top.period AS period, -1000 * top.length // top.period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
