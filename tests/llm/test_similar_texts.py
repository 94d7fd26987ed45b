import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import similar_texts
from labelloom.llm.components import components
from labelloom.llm.similar_texts import (
    CountTree,
    least_shared,
    op6_similar_texts,
    similar_components,
)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    width = min(4, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_force(rows):
    """(doc_id, n, component) of (doc_id, text) rows, by an inverted index and all its pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    posted = defaultdict(list)
    for i, s in enumerate(sets):
        near = {j for x in s for j in posted[x]}
        for j in near:
            if 100 * len(s & sets[j]) >= 85 * len(s | sets[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
        for x in s:
            posted[x].append(i)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)].append(d)
    return sorted(
        ((d, len(s), min(least[top(i)], default=None)) for i, ((d, _), s)
         in enumerate(zip(rows, sets, strict=True))), key=repr)


def got(docs):
    return sorted(map(tuple, similar_components(docs).collect()), key=repr)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in
            spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op6_similar_texts(spark, sf_dir).collect()), key=repr) == brute_force(
        rows)


@pytest.mark.parametrize("piece", [500, 7])
def test_chains_families_and_a_passage_that_many_share(documents, monkeypatch, piece):
    monkeypatch.setattr(similar_texts, "PIECE", piece)
    dice = random.Random(piece)
    word = lambda: f"w{dice.randint(0, 10**6)}"
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(3):  # families in which texts drift, so that links form chains
        text = [word() for _ in range(120)]
        for _ in range(25):
            text = list(text)
            for _ in range(dice.randint(0, 3)):
                text[dice.randrange(len(text))] = word()
            texts.append(" ".join(text))
    for _ in range(60):
        texts.append(" ".join(passage + [word() for _ in range(dice.randint(0, 30))]))
    texts += [" ".join(passage)] * 20 + ["one two", "one two", "ONE  two\n", "one", "", None, " \t"]
    dice.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, "one two"), (None, "x"), (5, "lone"), (5, "q " * 40_000)]
    docs = documents(rows).withColumns({"row": F.lit("x"), "a": F.lit(1), "root": F.lit(2)})
    assert got(docs) == brute_force(rows)


def test_empty(documents):
    assert similar_components(documents([])).count() == 0


def test_tree_keeps_every_pair_that_the_bound_allows():
    dice = np.random.default_rng(3)
    base = dice.poisson(6, (40, similar_texts.GROUPS))
    points = np.concatenate([np.maximum(0, base + dice.integers(-1, 2, base.shape))
                             for _ in range(12)])
    sizes = points.sum(axis=1)
    a, b = CountTree(points, sizes, 85).pairs()
    found = {(min(x), max(x)) for x in zip(a.tolist(), b.tolist(), strict=True)}
    wanted = {
        (i, j) for i in range(len(points)) for j in range(i)
        if np.minimum(points[i], points[j]).sum() >= least_shared(sizes[i], sizes[j], 85)
        and min(sizes[i], sizes[j]) * 100 >= 85 * max(sizes[i], sizes[j])
    }
    assert found == {(j, i) for i, j in wanted} and len(found) < len(points) ** 2 / 8


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == {
        **{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}}
