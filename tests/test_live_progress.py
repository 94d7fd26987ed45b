"""Counts reported while a run goes on equal what its tables say afterwards."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.operators.live import LiveProgress
from labelloom.plans.annotate import ACCEPTED, REFUSED, RETRY, AnnotationJob
from labelloom.settings import Settings
from test_job import corpus, describing_client, scan_of


def job_of(spark, tmp_path, live, **settings):
    os.makedirs(f"{tmp_path}/log", exist_ok=True)
    return AnnotationJob(
        spark, f"{tmp_path}/out", Settings("lab/annotator-1", **settings),
        describing_client(f"{tmp_path}/log"), id_type=T.StringType(), live=live,
    )


def tables_say(job):
    return {r.dataset: (r.n_accepted, r.n_refused) for r in job.progress().collect()}


def live_says(live):
    accepted, refused = live.totals(ACCEPTED), live.totals(REFUSED)
    return {name: (accepted[name], refused[name]) for name in accepted
            if accepted[name] or refused[name]}


def test_counts_of_a_run_equal_its_tables(spark, tmp_path):
    paths = [
        corpus(spark, tmp_path, "alpha", [(f"a{i}", f"text {i}") for i in range(20)], files=3),
        corpus(spark, tmp_path, "beta", [("b1", "cut short"), ("b2", "never"), ("b3", None)]),
        corpus(spark, tmp_path, "gamma", [("g1", "fine")]),
    ]
    reports = []
    live = LiveProgress(lambda *row: reports.append(row))
    job = job_of(spark, tmp_path, live, parts_per_commit=1)
    job.run(scan_of(spark, *paths))
    assert live_says(live) == tables_say(job) == {"alpha": (20, 0), "beta": (1, 2), "gamma": (1, 0)}
    # One report for each commit with rows: three of alpha's, one of each other's first attempt.
    first = [(name, sum(n.values())) for name, attempt, n in reports if attempt == 1]
    assert sorted(name for name, _ in first) == ["alpha"] * 3 + ["beta", "gamma"]
    assert sum(n for _, n in first) == 24
    assert [r for r in reports if r[1] == 2] == [("beta", 2, {ACCEPTED: 1, REFUSED: 1})]
    # A run with nothing to do reports nothing.
    again = LiveProgress()
    job_of(spark, tmp_path, again).run(scan_of(spark, *paths))
    assert live_says(again) == {}


def test_retries_of_an_earlier_run_are_counted_together(spark, tmp_path):
    scan = scan_of(spark, corpus(spark, tmp_path, "alpha", [("a1", "cut one"), ("a2", "two")]))
    job_of(spark, tmp_path, None).call_open_parts(scan)
    live = LiveProgress()
    job_of(spark, tmp_path, live).run(scan)
    assert live_says(live) == {None: (1, 0)} and live.totals(RETRY) == {None: 0}


@pytest.mark.parametrize("rows", [[], [("x", "one"), (None, "two")]])
def test_corpora_named_by_a_column_and_empty_tables(spark, tmp_path, rows):
    schema = "dataset string, outcome string"
    outcomes = spark.createDataFrame([(name, ACCEPTED) for name, _ in rows], schema)
    live = LiveProgress()
    watched, written = live.observed(outcomes, 1, ["x"], [ACCEPTED, REFUSED])
    watched.write.parquet(f"{tmp_path}/table")
    written()
    assert live.totals(ACCEPTED) == ({"x": 1, None: 1} if rows else {"x": 0})
    assert outcomes.filter(F.col("dataset") == "x").count() == len(rows) // 2
