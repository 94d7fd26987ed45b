import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import nearest as module
from labelloom.llm.nearest import Codes, MultiIndex, nearest, op7_nearest


def brute_force(rows, asked, k=10):
    """Nearest by plain distances, of (id, vector) rows."""
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for q in asked:
        d = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("block", [1_024, 100])
def test_recall_and_exact_scores(spark, monkeypatch, block):
    monkeypatch.setattr(module, "LEAST_BLOCK", block)
    sf_dir = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in
            spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = brute_force(rows, [i for i, _ in rows if i % 100 == 0])
    got = results(op7_nearest(spark, sf_dir))
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 10 * len(want)
    vectors = {i: np.array(v, dtype=np.float64) for i, v in rows}
    for q, found in got.items():
        for i, score in found:
            assert score == pytest.approx(float(np.linalg.norm(vectors[q] - vectors[i])), abs=1e-12)


def test_probing_finds_every_code_in_the_radius():
    dice = np.random.default_rng(5)
    packed = dice.integers(0, 256, (3000, 6)).astype(np.uint8)
    index = MultiIndex(packed)
    for radius in (0, 3, 5, 6, 13, 20, 48):
        code = packed[radius]
        want = np.flatnonzero(np.unpackbits(packed ^ code, axis=1).sum(axis=1) <= radius)
        assert index.within(code, radius).tolist() == want.tolist()


def test_copies_ties_bad_vectors_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7), 1.0]) for i in range(300)]  # seven groups of copies
    bad = [(1000, None), (1100, [0.0, 0.0]), (1200, [nan, 1.0]), (1300, [inf, 1.0]),
           (1400, [None, 1.0]), (None, [1.0, 1.0]), (1500, [1.0]), (1600, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    df = df.withColumns({"entry": F.lit("x"), "query": F.lit(1), "asked": F.lit(None)})
    got = results(nearest(df, F.col("vec_id") % 100 == 0))
    assert got == brute_force(rows, [0, 100, 200])


def test_few_candidates_are_all_returned(spark):
    rows = [(0, [1.0, 0.0]), (1, [-50.0, 3.0]), (2, [900.0, 1.0]), (100, [1.0, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert results(nearest(df, F.col("vec_id") % 100 == 0)) == brute_force(rows, [0, 100])
    assert results(nearest(df.where("vec_id = 0"), F.lit(True))) == {}
    assert nearest(df.where("false"), F.lit(True)).count() == 0


def test_codes_of_many_dimensions():
    dice = np.random.default_rng(2)
    codes = module.learn_codes(dice.normal(size=(400, 300)), 10)
    assert isinstance(codes, Codes) and codes.bits == 256
