import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelloom.operators.positions import after_prefix, batch_plan, with_file_rank, with_rank
from labelloom.operators.resume import (
    completeness,
    orphans,
    over_complete,
    pending_ids,
    pending_rows,
    publishable,
    row_digest,
    skip_published,
)
from labelloom.settings import Settings
from labelloom.sources.corpora import part_counts

DOC = "dataset string, id string, text string, part string, pos long"


def documents(spark, rng, n=600, hot=0.4):
    """Repeated and null ids, one of them on a large share of all rows."""
    rows = []
    for i in range(n):
        key = rng.random()
        row_id = "hot" if key < hot else None if key < hot + 0.1 else f"id{rng.randrange(n // 3)}"
        rows.append((f"d{rng.randrange(3)}" if key > 0.2 else "d0", row_id, f"t{i}",
                     f"file{i // 250}", i % 250))
    return rows, spark.createDataFrame(rows, DOC)


@pytest.mark.parametrize("block_rows", [1, 7, 65_536])
def test_rank_equals_one_row_number(spark, block_rows):
    rows, df = documents(spark, random.Random(1))
    got = with_rank(df.drop("text"), ["dataset"], block_rows=block_rows).collect()
    seen = Counter()
    want = {}
    for dataset, _, _, part, pos in sorted(rows, key=lambda r: (r[3], r[4])):
        want[part, pos] = seen[dataset]
        seen[dataset] += 1
    assert {(r.part, r.pos): r["rank"] for r in got} == want


def test_no_window_holds_a_corpus(spark, capsys):
    _, df = documents(spark, random.Random(1))
    with_rank(df.drop("text"), ["dataset"]).explain("formatted")
    plan = capsys.readouterr().out
    row_windows = [line for line in plan.splitlines() if "row_number" in line and "Arguments" in line]
    assert row_windows
    assert all("_block" in line for line in row_windows)


def test_ranking_shuffles_each_row_once(spark, capsys):
    _, df = documents(spark, random.Random(1))
    with_rank(df.drop("text"), ["dataset"]).explain()
    plan = capsys.readouterr().out
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(_group" in line]
    # Rows by block; counts by block, by group, and by block again to meet the rows. The
    # rows' own partitioning serves both their window and the join.
    assert len(exchanges) == 4, plan


def test_file_rank_needs_no_shuffle_of_rows(spark):
    rows, df = documents(spark, random.Random(2))
    single = df.withColumn("dataset", F.lit("d"))
    got = with_file_rank(single, part_counts(single)).collect()
    want = {key: i for i, key in enumerate(sorted((r[3], r[4]) for r in rows))}
    assert {(r.part, r.pos): r["rank"] for r in got} == want


@pytest.fixture(params=["10MB", "-1"])
def join_limit(spark, request):
    """With and without broadcast joins."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("seed", range(2))
def test_pending_ids_is_a_multiset_difference(spark, join_limit, seed):
    rng = random.Random(seed)
    rows, df = documents(spark, rng)
    done_rows = [row for row in rows if rng.random() < 0.5]
    done = spark.createDataFrame([(r[0], r[1]) for r in done_rows], "dataset string, id string")
    left = Counter((r[0], r[1]) for r in done_rows)
    want = []
    for row in sorted(rows, key=lambda r: (r[3], r[4])):
        if left[row[0], row[1]]:
            left[row[0], row[1]] -= 1
        else:
            want.append(row)
    left_over = pending_ids(df, done)
    assert left_over._jdf.queryExecution().executedPlan().toString().count("Scan") <= 4
    got = left_over.select("dataset", "id", "text", "part", "pos").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_pending_rows_keeps_changed_and_repeated_rows(spark):
    rows, df = documents(spark, random.Random(5))
    docs = df.withColumn("version", F.lit(1)).withColumn(
        "digest", row_digest(F.col("id"), F.col("text")))
    changed = docs.withColumn("text", F.when(F.col("pos") == 3, "new").otherwise(F.col("text")))
    now = changed.withColumn("digest", row_digest(F.col("id"), F.col("text")))
    left = pending_rows(now, docs)
    assert {r.pos for r in left.collect()} == {3}
    assert orphans(docs, now).count() == left.count() == 3
    assert pending_rows(docs.withColumn("version", F.lit(2)), docs).count() == len(rows)


def test_batches(spark):
    settings = Settings("m", batch_rows=32, requests_per_task=8)
    ranked = spark.range(100).select(F.lit("a").alias("dataset"), F.col("id").alias("rank"))
    ranked = ranked.unionByName(ranked.filter("rank < 5").withColumn("dataset", F.lit("b")))

    def sizes(**n_done):
        progress = spark.createDataFrame(
            [("a", 100, n_done["a"]), ("b", 5, n_done["b"])],
            "dataset string, n_rows long, n_done long",
        )
        plan = batch_plan(ranked, progress, settings)
        return {
            (r.dataset, r.batch_id): r["count"]
            for r in plan.groupBy("dataset", "batch_id").count().collect()
        }

    assert sizes(a=0, b=0) == {
        ("a", 0): 32, ("a", 1): 32, ("a", 2): 32, ("a", 3): 4, ("b", 0): 5,
    }
    assert sizes(a=97, b=5) == {("a", 0): 3}
    done = spark.createDataFrame([("a", 97)], "dataset string, n_done long")
    assert after_prefix(ranked, done).count() == 3 + 5


def test_completeness(spark):
    expected = spark.createDataFrame(
        [("empty", 0), ("none", 2), ("partial", 2), ("complete", 2), ("over", 2)],
        "dataset string, n_rows long",
    )
    actual = spark.createDataFrame(
        [("partial", 1), ("complete", 2), ("over", 3)], "dataset string, n_rows long"
    )
    states = completeness(expected, actual)
    assert {r.dataset: r.state for r in states.collect()} == {
        "empty": "empty", "none": "none", "partial": "partial", "complete": "complete",
        "over": "over_complete",
    }
    assert [r.dataset for r in over_complete(states).collect()] == ["over"]
    assert [r.dataset for r in publishable(states).collect()] == ["complete"]


def test_skip_published(spark):
    corpora = spark.createDataFrame([("a", "p/a"), ("b", "p/b")], "dataset string, path string")
    published = spark.createDataFrame([("p/a",), ("p/a",), ("p/z",)], "path string")
    assert [r.dataset for r in skip_published(corpora, published).collect()] == ["b"]
