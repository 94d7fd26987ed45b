import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import numpy as np
from labelloom.llm import periodic_runs as module
from labelloom.llm.periodic_runs import (
    OP13_SQL,
    kept_words,
    op13_runs,
    periodic_runs,
    runs_of,
)
from oracle_check import compare, connect


def brute_force(words, least_words=6, least_periods=4):
    """All runs, by comparing the words at every lag."""
    found = {}
    for lag in range(1, len(words) // least_periods + 1):
        start = None
        for i in range(len(words) - lag + 1):
            if i < len(words) - lag and words[i] == words[i + lag]:
                start = i if start is None else start
            elif start is not None:
                length = i - start + lag
                if length >= max(least_words, least_periods * lag):
                    found.setdefault((start, length), lag)
                start = None
    return sorted((s, n, p) for (s, n), p in found.items())


def words_with_runs(rng):
    letters = rng.choice([1, 2, 2, 3, 8])
    words = [rng.randrange(letters) for _ in range(rng.randint(0, 60))]
    for _ in range(rng.randint(0, 3)):
        unit = [rng.randrange(letters) for _ in range(rng.randint(1, 20))]
        at = rng.randint(0, len(words))
        words[at:at] = unit * rng.randint(2, 6) + unit[: rng.randint(0, len(unit))]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(7)
    for _ in range(3000):
        words = words_with_runs(rng)
        assert runs_of(np.array(words, np.int64)) == brute_force(words), words


@pytest.mark.parametrize("least", [(1, 3), (10, 3), (40, 4), (2, 9)])
def test_other_bounds(least):
    rng = random.Random(8)
    for _ in range(500):
        words = words_with_runs(rng)
        assert runs_of(np.array(words, np.int64), *least) == brute_force(words, *least), words
    with pytest.raises(ValueError):
        runs_of(np.array([1, 1]), 6, 2)


def test_covered_diagonals_are_not_extended_again(monkeypatch):
    calls = []
    agreement = module.agreement
    monkeypatch.setattr(
        module, "agreement", lambda *args: calls.append(args) or agreement(*args))
    assert runs_of(np.zeros(20_000, np.int64)) == [(0, 20_000, 1)]
    assert len(calls) == 2
    unit = np.arange(700)
    assert runs_of(np.tile(unit, 30)) == [(0, 21_000, 700)]
    assert len(calls) == 4


def test_only_the_first_period_is_kept():
    words = ["x", *"abab" * 3, "b", "y"]
    numbers = np.unique(words, return_inverse=True)[1]
    assert runs_of(numbers) == [(1, 12, 2)]
    assert [words[i] for i in np.flatnonzero(kept_words(len(words), [(1, 12, 2)]))] == list("xabby")


def digests(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute_force(words)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    kept = [w for i, w in enumerate(words)
            if not any(s + p <= i < s + n for s, n, p in runs)]
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (doc_id, len(runs), *top, top[0] is not None and 1000 * top[1] // top[2] or None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def test_query_equals_brute_force(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(digests(*t) for t in texts if len((t.text or "").split()) < 2500)
    short = {w[0] for w in want}
    got = sorted(tuple(r) for r in op13_runs(spark, sf_dir).collect() if r.doc_id in short)
    assert got == want and any(w[1] for w in want)


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf_dir), sf_dir, op13_runs, OP13_SQL) == 1000


def test_texts_of_all_kinds(documents, monkeypatch):
    monkeypatch.setattr(module, "CHUNK_WORDS", 50)
    long = "a b c " * 40_000
    rows = [(1, None), (2, ""), (3, " \t\x0b"), (None, "z z z z z z"), (4, "z\x0bz z\nz z z"),
            (4, "z\x0bz z\nz z z"), (5, long), (6, "é½ " * 5), (7, "Z z z z z z")]
    docs = documents(rows).withColumns({"runs": F.lit(1), "n_words": F.lit("x")})
    got = sorted(map(tuple, periodic_runs(docs).collect()), key=repr)
    one = [(0, 6, 1)]
    assert got == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 6, one, "z"), (4, 6, one, "z"),
        (4, 6, one, "z"), (5, 120_000, [(0, 120_000, 3)], "a b c"), (6, 5, [], "é½ é½ é½ é½ é½"),
        (7, 6, [], "Z z z z z z")], key=repr)


def test_empty(documents):
    assert periodic_runs(documents([])).count() == 0
