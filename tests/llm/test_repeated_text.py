import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import induced_sorting, repeated_text
from labelloom.llm.induced_sorting import sorted_suffixes
from labelloom.llm.repeated_text import merged, op8_repeated_text, remove_repeats


def brute_force(rows, length=100):
    """Per (doc_id, text) row, by a table of all windows' first starts."""
    order = lambda d: (d is not None, d)
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for s in range(len(data) - length + 1):
            key, at = data[s : s + length], (order(doc), s)
            if key not in first or at < first[key]:
                first[key] = at
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        spans = merged([(s, s + length) for s in range(len(data) - length + 1)
                        if first[data[s : s + length]] < (order(doc), s)])
        kept, at = b"", 0
        for s, e in spans:
            kept, at = kept + data[at:s], e
        out.append((doc, len(data), sum(e - s for s, e in spans), len(spans),
                    sha256(kept + data[at:]).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("queue_bytes", [1 << 20, 8])
def test_suffixes_and_common_prefixes(monkeypatch, queue_bytes):
    monkeypatch.setattr(induced_sorting, "QUEUE_BYTES", queue_bytes)
    for seed in range(400):
        dice = random.Random(seed)
        letters = dice.choice([b"ab", b"a", b"abcdefgh", bytes(range(250))])
        some = lambda n: bytes(dice.choice(letters) for _ in range(n))  # noqa: B023, E731
        text = b"".join(some(dice.randint(0, 30)) + b"\xfe" for _ in range(dice.randint(1, 6)))
        if seed % 3 == 0:
            part = some(40)
            text = (part + b"\xfe") * 3 + text + part[:20] + b"\xfe"
        depth = dice.choice([4, 10, 100])
        parts = list(sorted_suffixes(np.frombuffer(text, np.uint8), depth))
        at = np.concatenate([p for p, _ in parts])
        prefix = np.concatenate([c for _, c in parts])
        assert sorted(at.tolist()) == list(range(len(text)))
        for i in range(1, len(at)):
            a, b = text[at[i - 1] :], text[at[i] :]
            common = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y),
                          min(len(a), len(b)))
            assert common >= depth or a < b
            assert a[0] != b[0] or prefix[i] == min(common, depth)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in
            spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_force(rows)
    assert got(op8_repeated_text(spark, sf_dir)) == want and sum(r[2] for r in want) > 0


@pytest.mark.parametrize(("portion", "hot"), [(1 << 22, 1_000), (1 << 22, 2), (300, 4)])
def test_hard_texts(documents, monkeypatch, portion, hot):
    monkeypatch.setattr(repeated_text, "PORTION", portion)
    monkeypatch.setattr(repeated_text, "HOT_TIMES", hot)
    dice = random.Random(portion)
    line = lambda n: "".join(dice.choice("abcé \n") for _ in range(n))
    passage, other = line(150), line(99)
    rows = [(i, line(dice.randint(0, 200)) + passage[dice.randint(0, 40) :] + line(50))
            for i in range(30)]
    rows += [(50, "a" * 1000), (51, "ab" * 300), (52, "a" * 150), (53, other), (54, other),
             (55, other + "x"), (56, other + "x"), (57, passage * 3), (58, None), (59, ""),
             (None, passage), (None, line(300)), (60, passage + "1"), (60, passage + "2"),
             (61, "same" * 40), (61, "same" * 40), (-7, passage[:120]), (62, "\x00" * 250)]
    dice.shuffle(rows)
    docs = documents(rows).withColumns({"start": F.lit("x"), "spans": F.lit(1), "id_": F.lit(0)})
    assert got(remove_repeats(docs)) == brute_force(rows)


def test_ids_that_are_no_numbers_are_refused(documents):
    docs = documents([(1, "a" * 150), (2, "b")])
    texts = docs.withColumn("doc_id", F.concat(F.lit("1"), F.col("doc_id").cast("string")))
    assert remove_repeats(texts).count() == 2
    with pytest.raises(Exception, match="x1 is no whole number"):
        remove_repeats(docs.withColumn("doc_id", F.concat(F.lit("x"), F.lit("1")))).collect()


def test_empty(documents):
    assert remove_repeats(documents([])).count() == 0


def test_merged():
    assert merged([(5, 9), (0, 3), (3, 4), (8, 12)]) == [(0, 4), (5, 12)]
