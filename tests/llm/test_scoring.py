import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import scoring
from labelloom.llm.scoring import (
    FrequencyFilter,
    build_filter,
    level_counts,
    levels,
    op5_scoring,
    score_documents,
)


def tokens_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "\n"]


@pytest.mark.parametrize("grams", [1 << 20, 50])  # 50: groups of few n-grams
def test_base_scores_are_exact_and_the_model_beats_them(spark, sf_dir, monkeypatch, grams):
    monkeypatch.setattr(scoring, "GROUP_GRAMS", grams)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    held = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 7 == 2 for d in docs}
    counts = Counter(t for d in docs if not held[d.doc_id] for t in tokens_of(d.text))
    n, v = sum(counts.values()), len(counts)
    rows = {r.doc_id: r for r in op5_scoring(spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        r, tokens = rows[d.doc_id], tokens_of(d.text)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[d.doc_id], len(tokens), n)
        assert r.n_known == sum(counts[t] > 0 for t in tokens)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert -20 * len(tokens) < r.score <= 0
    if grams > 50:
        own = [r for r in rows.values() if r.held_out]
        assert sum(r.score for r in own) > sum(r.base_score for r in own)


def test_filter_gives_levels_and_few_false_ones(spark):
    dice = np.random.default_rng(1)
    hashes = dice.integers(0, 2**63, 20_000)
    counts = (dice.pareto(1.0, 20_000) * 3 + 1).astype(np.int64)
    df = spark.createDataFrame(
        [(int(h), int(c)) for h, c in zip(hashes, counts)], "hash long, n long")
    stored = build_filter(df)
    got = stored.level(hashes.view(np.uint64))
    assert (got >= levels(counts)).all() and (got == levels(counts)).mean() > 0.98
    strange = stored.level(dice.integers(0, 2**63, 20_000).view(np.uint64))
    assert (strange > 0).mean() < 0.02
    exact = level_counts(levels(counts)) / counts
    assert 0.6 < exact.min() and exact.max() < 1.6


def test_empty_filter():
    empty = FrequencyFilter(np.zeros((0, 1), np.uint8))
    assert empty.level(np.array([1, 2], np.uint64)).tolist() == [0, 0]


def test_nulls_repeats_and_clashing_columns(documents):
    docs = documents([(1, "A b"), (1, "a b"), (2, None), (3, ""), (None, "b " * 50_000)])
    docs = docs.withColumns({"score": F.lit("x"), "row": F.lit(1), "hash": F.lit(0)})
    rows = score_documents(docs, F.col("doc_id") == 3).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [
        (0, 50_001), (1, 2), (1, 3), (2, 1), (3, 1)]
    assert {r.train_tokens for r in rows} == {6}  # a null fold is in neither part
    assert score_documents(documents([]), F.lit(False)).count() == 0
    alone = score_documents(documents([(1, "a")]), F.lit(True)).first()
    assert (alone.base_score, alone.score, alone.train_tokens) == (0.0, 0.0, 0)


@pytest.mark.parametrize("stored", [1 << 23, 300, 1])  # 1: all is in the tail
def test_rare_words_and_pairs_count(spark, sf_dir, monkeypatch, stored):
    monkeypatch.setattr(scoring, "STORED", stored)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    held = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 7 == 2 for d in docs}
    words, pairs = Counter(), Counter()
    for d in docs:
        if not held[d.doc_id]:
            tokens = tokens_of(d.text)
            words.update(tokens)
            pairs.update(zip(["\n", *tokens], tokens))
    n, v = sum(words.values()), len(words)
    count = lambda c: float(level_counts(levels(np.array([c])))[0]) if c else 0.0
    off = []
    for r in op5_scoring(spark, sf_dir).collect():
        tokens = tokens_of(next(d.text for d in docs if d.doc_id == r.doc_id))
        want = 0.0
        for a, b in zip(["\n", *tokens], tokens):
            c, own = count(words[a]), count(words[b])
            pair = min(count(pairs[a, b]), c, own)
            alone = min(1.0, (own + 1) / (n + v + 1))
            want += math.log10((pair + 20 * alone) / (c + 20))
        off.append(abs(r.score - want) / abs(want))
    assert max(off) < 0.05 and sum(off) / len(off) < 0.01


@pytest.mark.parametrize("kind", ["int", "decimal(20,0)", "string", "bigint"])
def test_ids_come_back_as_they_are(spark, documents, kind):
    docs = documents([(1, "a b"), (2, "c")]).withColumn("doc_id", F.col("doc_id").cast(kind))
    scored = score_documents(docs, F.lit(False))
    assert dict(scored.dtypes)["doc_id"] == kind
    assert sorted(int(r.doc_id) for r in scored.collect()) == [1, 2]


def test_scores_do_not_depend_on_chunks_and_groups(documents, monkeypatch):
    """A third of the texts share words that no training text has; one text is very long."""
    texts = [(i, "new words here " * 3 if i % 3 else f"old {i % 7} text {i}") for i in range(60)]
    docs = documents([*texts, (60, "old text 1 " * 4_000)])
    held = F.col("doc_id") % 3 != 0
    want = {r.doc_id: r for r in score_documents(docs, held).collect()}
    monkeypatch.setattr(scoring, "CHUNK_TOKENS", 40)
    monkeypatch.setattr(scoring, "GROUP_GRAMS", 100)
    monkeypatch.setattr(scoring, "STORED", 50)
    for r in score_documents(docs, held).collect():
        assert (r.n_tokens, r.n_known) == (want[r.doc_id].n_tokens, want[r.doc_id].n_known)
        assert r.base_score == pytest.approx(want[r.doc_id].base_score)
        assert r.score == pytest.approx(want[r.doc_id].score, rel=0.1)
