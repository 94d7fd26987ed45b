import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from labelloom.llm import language
from labelloom.llm.language import (
    Scorer,
    build_filter,
    grams_of,
    identify,
    in_known_language,
    learn_languages,
    op1_language,
)


def test_held_out_accuracy(spark, sf_dir):
    rows = op1_language(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    lang = {r.doc_id: r.lang for r in docs}
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def exact_languages(rows):
    """(lang, score) of (doc_id, text, lang) rows by sets of n-grams, without a filter."""
    def grams(text):
        runs = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        return [f" {r} "[i : i + n] for r in runs for n in (3, 4) for i in range(len(r) + 3 - n)]

    counts = {}
    for doc_id, text, lang in rows:
        if lang and text is not None and zlib.crc32(str(doc_id).encode()) % 5:
            counts.setdefault(lang, Counter()).update(grams(text))
    total = {lang: sum(c.values()) for lang, c in counts.items()}
    rate = {lang: {g: n / total[lang] for g, n in c.items() if n * 50_000 >= total[lang]}
            for lang, c in counts.items()}
    best = Counter()
    for rated in rate.values():
        for g, r in rated.items():
            best[g] = max(best[g], r)
    held = {lang: {g for g, r in rated.items() if r >= 0.1 * best[g]}
            for lang, rated in rate.items()}
    order = sorted(total, key=lambda lang: (-total[lang], lang))
    found = []
    for _, text, _ in rows:
        own = grams(text)
        hits = [sum(g in held[lang] for g in own) for lang in order]
        top = max(range(len(order)), key=lambda i: hits[i]) if own else None
        found.append(("und", 0.0, 0) if top is None else (
            order[top], hits[top] / len(own), hits[top] - max([*hits[:top], *hits[top + 1 :], 0])))
    return found


def test_query_equals_exact_sets(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet")
            .select("doc_id", "text", "lang").collect()]
    got = {r.doc_id: r for r in op1_language(spark, sf_dir).collect()}
    clear = 0
    for (doc_id, *_), (lang, score, lead) in zip(rows, exact_languages(rows), strict=True):
        assert abs(got[doc_id].score - score) < 0.05
        if lang == "und" or lead > 10:
            clear += 1
            assert got[doc_id].lang_pred == lang
    assert clear > 0.9 * len(rows)


def hashed(*grams):
    return np.concatenate([grams_of([g])[1] for g in grams])


def test_grams_are_padded_runs_of_letters():
    owner, hashes = grams_of(["ab1cd", "½ⅷ", "é"])
    words = [grams_of([w])[1].tolist() for w in ("ab", "cd", "é")]
    assert sorted(hashes.tolist()) == sorted(sum(words, []))
    assert sorted(owner.tolist()) == [0] * 6 + [2]
    assert len(words[0]) == 3 and len(words[2]) == 1
    assert [len(grams_of(w)[0]) for w in ([], [""], ["- ", "² ①"])] == [0, 0, 0]


def test_filter_returns_every_language_of_an_ngram():
    names = [f"l{i:02}" for i in range(70)]  # more than one word of bits
    rng = np.random.default_rng(4)
    grams = rng.integers(0, 2**64, 2000, np.uint64)
    places = np.arange(2000)
    held = [places % 70, places * 7 % 70]
    learned = build_filter(names, np.concatenate([grams, grams]), np.concatenate(held))
    masks = learned.masks(grams)
    for langs in held:
        assert ((masks[places, langs // 64] >> (langs % 64).astype(np.uint64)) & np.uint64(1)).all()
    strange = learned.masks(rng.integers(0, 2**64, 20_000, np.uint64))
    false = np.bitwise_count(strange).sum() / (20_000 * 70)
    assert abs(false - learned.false_share.mean()) < 0.005


def test_popcounts_are_corrected_for_false_hits():
    grams = hashed("hello", "world")
    learned = build_filter(["a", "b"], grams, np.zeros(len(grams), np.int64))
    learned.false_share = learned.false_share + [0.0, 0.5]
    found = list(Scorer(learned)(["hello", "zzz", None, "hello world " * 3]))
    assert found[0][0] == found[3][0] == "a"
    assert found[1][1] == 0.0 and found[2] == ("und", 0.0)


def test_small_portions_and_tables_give_the_same(spark, sf_dir, monkeypatch):
    rows = sorted(map(tuple, op1_language(spark, sf_dir).collect()))
    for bound in ("CHUNK_WORDS", "TABLE_WORDS", "TABLE_GRAMS"):
        monkeypatch.setattr(language, bound, 300)
    assert sorted(map(tuple, op1_language(spark, sf_dir).collect())) == rows


def test_numbers_are_no_letters(documents):
    docs = documents([(i, "the cat sat on the mat", "en") for i in range(9)] + [(99, "½ ② ² Ⅷ 7")])
    assert {r.doc_id: r.lang_pred for r in identify(docs).collect()}[99] == "und"


def test_nulls_empty_texts_and_clashing_columns(spark, documents):
    english, french = "the cat sat on the mat and ate " * 20, "le chat est sur la table et dort " * 20
    rows = [(i, (english, french)[i % 2], ("en", "fr")[i % 2]) for i in range(40)]
    rows += [(100, None, "en"), (101, "", "fr"), (102, " 12 - 7!", "en"), (None, english, None),
             (103, "the mat " * 60_000, None), (103, french, None), (104, "ωωω ψψψ", None)]
    docs = documents(rows).withColumns({"score": F.lit("x"), "lang_pred": F.lit(0)})
    got = {}
    for r in identify(docs).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, round(r.score, 1)))
    assert got[100] == got[101] == got[102] == [("und", 0.0)]
    assert got[None] == [("en", 1.0)] and sorted(got[103]) == [("en", 1.0), ("fr", 1.0)]
    assert got[104][0][1] == 0.0
    kept = in_known_language(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {*range(40), None, 103}


def test_nothing_to_learn_from(documents):
    docs = documents([(1, "abc", None)])
    assert [tuple(r) for r in identify(docs).collect()] == [(1, False, "und", 0.0)]
    assert identify(documents([])).count() == 0
    assert learn_languages(docs, F.lit(True)).names == []
