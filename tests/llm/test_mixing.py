import random

import pytest
from pyspark.sql import functions as F

from labelloom.llm.mixing import OP10_SQL, fair_queue, op10_mixing, source_targets
from oracle_check import compare, connect


def test_query_equals_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), sf_dir, op10_mixing, OP10_SQL) == 200


def reshared(sizes, weights, share, repeats):
    """Targets by repeated sharing of what is above the caps."""
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    cap = {n: repeats * sizes[n] for n in names}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[n] for n in open_)
        over = {n for n in open_ if level * weight[n] > cap[n]}
        if not over:
            return target | {n: level * weight[n] for n in open_}
        for n in over:
            target[n] = cap[n]
            left -= cap[n]
        open_ -= over
    return target


@pytest.mark.parametrize("case", range(6))
def test_targets_equal_repeated_sharing(spark, case):
    dice = random.Random(case)
    sizes = {f"s{i}": dice.choice([0, 1, 10, 1000, 50_000]) for i in range(dice.randint(1, 9))}
    sizes[None] = 70
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in source_targets(df, (3, 1, 2), 1.5, 2).collect()}
    assert got == pytest.approx(reshared(sizes, (3, 1, 2), 1.5, 2))


def test_taken_words_come_near_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = fair_queue(docs).collect()
    longest = max(r["size"] for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * longest
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    again = fair_queue(docs.repartition(5)).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr)


def test_nulls_repeats_and_clashing_columns(documents):
    docs = documents([(1, "a b", None, "x"), (1, "a b", None, "x"), (2, None, None, None),
                      (None, "c", None, None), (4, "", None, "y"), (5, " \n", None, "y")])
    docs = docs.withColumns({"size": F.lit("?"), "target": F.lit(1), "repeat": F.lit(2)})
    rows = fair_queue(docs).collect()
    assert len(rows) == 6
    assert {r.source: r.target for r in rows}["y"] == 0
    assert fair_queue(documents([])).count() == 0


def test_one_source_is_capped(documents):
    rows = fair_queue(documents([(i, "w " * 10, None, "s") for i in range(10)])).collect()
    assert sum(r.taken for r in rows) == 150
