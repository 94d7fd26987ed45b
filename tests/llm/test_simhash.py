import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from labelloom.llm import simhash
from labelloom.llm.simhash import (
    block_masks,
    fingerprints,
    joining_links,
    majority,
    near_prints,
    op12_simhash,
    shingle_hashes,
    simhash_components,
)


def print_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints, radius=3):
    """The least place linked with each of the prints, by comparing all of them."""
    x = np.array(prints, np.uint64)
    root = np.arange(len(x))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[:i] ^ x[i]) <= radius):
            a, b = top(i), top(int(j))
            root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(x))]


def brute_force(rows):
    prints = [print_of(t) for _, t in rows]
    root = roots(prints)
    least = {}
    for (d, _), r in zip(rows, root, strict=True):
        least.setdefault(r, [])
        if d is not None:
            least[r].append(d)
    return sorted(((d, p, min(least[r], default=None))
                   for (d, _), p, r in zip(rows, prints, root, strict=True)), key=repr)


def got(docs):
    return sorted(((r.doc_id, r.fingerprint % 2**64, r.component_id)
                   for r in simhash_components(docs).collect()), key=repr)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet")
            .select("doc_id", "text").collect()]
    want = [(d, f"{p:016x}", c) for d, p, c in brute_force(rows)]
    assert sorted(map(tuple, op12_simhash(spark, sf_dir).collect()), key=repr) == want
    assert any(d != c for d, _, c in want)


def test_hash_is_the_one_of_the_engine(spark):
    text = "Ää b  c\x0bD e\n½"
    words = ["Ää", "b", "c", "d", "e", "½"]
    runs = spark.createDataFrame([(i, " ".join(words[i : i + 3])) for i in range(4)], "i int, r string")
    want = [r.h % 2**64 for r in runs.orderBy("i").select(F.xxhash64("r").alias("h")).collect()]
    assert shingle_hashes(text.encode()).tolist() == want


def test_majority_of_many_hashes():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**64, 2000, np.uint64)
    sizes = np.array([0, 1, 2, 255, 256, 0, 700, 786, 0])
    want, at = [], 0
    for n in sizes:
        own = [int(h) for h in hashes[at : at + n]]
        at += n
        want.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in own) > n))
    assert majority(hashes, sizes).tolist() == want


def clustered(rng, n):
    """Fingerprints some of which are a few bits from another."""
    out = [rng.getrandbits(64) for _ in range(n // 4)]
    while len(out) < n:
        out.append(rng.choice(out) ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 4))))
    return list(dict.fromkeys(x % 2**64 for x in out))


@pytest.mark.parametrize("chance", [16, 0.005, 0.00001])
def test_links_equal_brute_force_for_any_number_of_blocks(spark, monkeypatch, chance):
    different = len(block_masks(400))
    monkeypatch.setattr(simhash, "BY_CHANCE", 16)
    prints = clustered(random.Random(2), 400)
    masks = block_masks(int(len(prints) * 16 / chance))
    monkeypatch.setattr(simhash, "block_masks", lambda *args: masks)
    assert chance == 16 or len(masks) > different
    check_links(spark, prints)


def check_links(spark, prints):
    df = spark.createDataFrame(
        [(x - 2**64 if x >> 63 else x,) for x in prints], "fingerprint long")
    place = {x: i for i, x in enumerate(prints)}
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in near_prints(df).collect():
        a, b = a % 2**64, b % 2**64
        assert (a ^ b).bit_count() <= 3
        i, j = top(place[a]), top(place[b])
        root[max(i, j)] = min(i, j)
    assert [top(i) for i in range(len(prints))] == roots(prints)


def test_dealt_out_keys_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 5)
    monkeypatch.setattr(simhash, "CHUNK_ROWS", 30)
    base = random.Random(3).getrandbits(64)
    ball = {base ^ 1 << i ^ 1 << j for i in range(0, 64, 3) for j in range(1, 64, 5)}
    check_links(spark, sorted(ball | set(clustered(random.Random(4), 100))))


def test_a_group_hands_on_fewer_links_than_members():
    x = np.array([7 ^ 1 << i for i in range(64)], np.uint64)
    a, b = joining_links(np.zeros(64, np.int64), x, 3)
    assert len(a) == 63


def test_keys_miss_no_pair():
    rng = random.Random(5)
    for different in (100, 10**7, 10**10):
        masks = block_masks(different)
        for _ in range(300):
            flips = sum(1 << b for b in rng.sample(range(64), 3))
            assert any(flips & m == 0 for m in masks)


def test_texts_of_all_kinds(documents, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK_SHINGLES", 20)
    long = " ".join(f"w{i % 999}" for i in range(60_000))
    rows = [(5, None), (9, ""), (7, " \n"), (None, "a b"), (3, "A\tb"), (3, "a b c d"),
            (4, "a b c d"), (4, "a b c d"), (8, long), (2, long + " end"), (None, "ü"),
            (1, "x y z. " * 40)]
    docs = documents(rows).withColumns({"fingerprint": F.lit(1), "n": F.lit("x")})
    assert got(docs) == brute_force(rows)


def test_empty(documents):
    assert simhash_components(documents([])).count() == 0
    assert fingerprints(documents([])).count() == 0
