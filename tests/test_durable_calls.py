"""Answers outlive the task that got them; requests do not wait for each other."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.operators.call_log import CallLog, TaskLog
from labelloom.operators.model_call import in_order, spread
from labelloom.plans.annotate import AnnotationJob
from labelloom.plans.publish import publish, published_manifest, published_rows
from labelloom.settings import Settings
from test_job import calls, corpus, describing_client, replace_file, scan_of


def job_of(spark, tmp_path, client, **settings):
    return AnnotationJob(
        spark, f"{tmp_path}/out", Settings("lab/annotator-1", **settings), client,
        id_type=T.StringType(),
    )


def log_of(tmp_path, name="log"):
    os.makedirs(f"{tmp_path}/{name}")
    return f"{tmp_path}/{name}"


def logged_files(tmp_path):
    return [f for _, _, files in os.walk(f"{tmp_path}/out/calls") for f in files]


def dying(factory, after):
    """A client whose worker process dies, as an executor does, after some calls."""

    def build():
        call, made = factory(), []

        def answer(*args):
            made.append(1)
            if len(made) > after:
                os._exit(1)
            return call(*args)

        return answer

    return build


def test_a_lost_task_costs_one_batch_of_second_calls(spark, tmp_path):
    rows = [(f"i{i:03}", f"text {i:03}") for i in range(300)]
    scan = scan_of(spark, corpus(spark, tmp_path, "demo", rows))
    settings = {"batch_rows": 10, "requests_per_task": 4}
    first, second = log_of(tmp_path, "first"), log_of(tmp_path, "second")
    job = job_of(spark, tmp_path, dying(describing_client(first), 200), **settings)
    with pytest.raises(Exception):
        job.run(scan)
    assert job.responses(1).count() == 0 and len(calls(first)) >= 190
    job = job_of(spark, tmp_path, describing_client(second), **settings)
    job.run(scan)
    again = {c[0] for c in calls(first)} & {c[0] for c in calls(second)}
    assert len(again) <= 10 + 4
    assert job.annotations().count() == 300 == job.responses(1).count()
    assert logged_files(tmp_path) == []


def test_answers_of_both_attempts_are_found_in_the_log(spark, tmp_path):
    """All is answered and logged, but nothing committed; the next run calls for nothing."""
    rows = [("a", "cut one"), ("b", "fine"), ("c", None), ("d", "silent")]
    scan = scan_of(spark, corpus(spark, tmp_path, "demo", rows))
    log = log_of(tmp_path)
    job = job_of(spark, tmp_path, describing_client(log))
    job.call_documents(scan.documents())
    kept = spark.read.parquet(job._attempt_path(1)).collect()
    assert len(kept) == 4 and len(logged_files(tmp_path)) > 0
    other = job_of(spark, tmp_path, describing_client(log_of(tmp_path, "none")))
    # The same rows again, as a retried task would: all come from the log.
    other.call_documents(scan.documents())
    assert calls(f"{tmp_path}/none") == []
    again = [r for r in other.responses(1).collect()]
    assert sorted(str(r.raw) for r in again) == sorted(str(r.raw) for r in [*kept, *kept])


def test_failed_calls_are_not_logged(tmp_path):
    log = TaskLog(CallLog(f"{tmp_path}/calls", 2))
    log.add(("file:/a b", 1, 5), "x")
    log.add(("file:/a b", 1, 3), None)
    log.add(("file:/other", 1, 3), "y")
    log.flush()
    log.flush()
    fresh = TaskLog(CallLog(f"{tmp_path}/calls", 2))
    assert fresh.find(("file:/a b", 1, 3)) == (True, None)
    assert fresh.find(("file:/a b", 1, 3)) == (False, None)  # given out once
    assert fresh.find(("file:/a b", 1, 5)) == (True, "x")
    assert fresh.find(("file:/a b", 2, 5)) == fresh.find(("file:/a b", 1, 4)) == (False, None)
    CallLog(f"{tmp_path}/calls", 2).forget(["file:/a b"])
    fresh = TaskLog(CallLog(f"{tmp_path}/calls", 2))
    assert fresh.find(("file:/a b", 1, 5))[0] is False
    assert fresh.find(("file:/other", 1, 3)) == (True, "y")


def test_only_files_that_cover_a_row_are_read(tmp_path):
    log = TaskLog(CallLog(f"{tmp_path}/calls", 10))
    for pos in range(100):
        log.add(("p", 1, pos), str(pos))
    fresh = TaskLog(CallLog(f"{tmp_path}/calls", 10))
    assert fresh.find(("p", 1, 55)) == (True, "55") and len(fresh.known) == 9


def test_a_task_reads_no_answers_of_its_run_s_other_tasks(tmp_path):
    """Those are for rows it never gets; its own are there for a second try of the task."""
    log = CallLog(f"{tmp_path}/calls", 3)
    tasks = [TaskLog(log), TaskLog(log)]
    for at, task in enumerate(tasks):
        task.partition = at
        for pos in range(at, 40, 2):
            task.add(("p", 1, pos), str(pos))
        task.flush()
    again = TaskLog(log)
    again.partition = 1
    assert again.find(("p", 1, 20)) == (False, None)
    assert {pos % 2 for *_, pos in again.known} == {1}
    found = again.find_all(("p", 1, pos) for pos in range(40))
    assert found == {("p", 1, pos): str(pos) for pos in range(1, 40, 2)} and not again.known


def test_tasks_log_by_run_and_partition(spark, tmp_path):
    """Whatever the tasks' number, a task of a run looks into its own folder only."""
    path = corpus(spark, tmp_path, "demo", [(f"i{i}", f"text {i}") for i in range(40)])
    job = job_of(spark, tmp_path, describing_client(log_of(tmp_path)), batch_rows=2)
    for tasks in (4, 3):
        job.call_documents(spread(scan_of(spark, path).documents(), tasks, "part", "pos"))
    (part,) = os.listdir(job.call_log(1).root.removeprefix("file:"))
    folders = [d for d, _, files in os.walk(f"{tmp_path}/out/calls") if files]
    assert all(part in d for d in folders)
    places = {tuple(d.split("/")[-2:]) for d in folders}
    # The second run found all answers of the first, however it dealt out the rows.
    assert len({run for run, _ in places}) == 1 and {at for _, at in places} == set("0123")
    assert len(calls(f"{tmp_path}/log")) == 40


def test_an_earlier_run_s_log_is_never_held_whole(tmp_path, monkeypatch):
    """Its rows were dealt out in another way: each of its files has a few for every task."""
    monkeypatch.setattr("labelloom.operators.call_log.MOST_KNOWN", 20, raising=False)
    for start in (0, 1):  # row 0 and 100, 200, ... were answered twice
        log = TaskLog(CallLog(f"{tmp_path}/calls", 10))
        for pos in range(0, 1000, 1 if start == 0 else 100):
            log.add(("p", 1, pos), None if pos % 7 == 0 else str(pos))
        log.flush()
    rows = [("p", 1, pos) for pos in range(1000)]
    for tasks in (1, 3):
        for task in range(tasks):
            own = TaskLog(CallLog(f"{tmp_path}/calls", 10))
            mixed = [row for step in range(50) for row in rows[task::tasks][step::50]]
            for start in range(0, len(mixed), 25):
                asked = mixed[start:start + 25]
                found = own.find_all(asked)
                assert found == {r: None if r[2] % 7 == 0 else str(r[2]) for r in asked}
                assert len(own.known) <= 20
            assert own.find_all(mixed) == {}


def test_a_slow_call_holds_up_no_other():
    def call(i):
        time.sleep(0.5 if i % 100 == 50 else 0.01)
        return i

    began = time.monotonic()
    assert list(in_order(call, ((i,) for i in range(400)), 8, 256)) == list(range(400))
    work = 4 * 0.5 + 396 * 0.01
    assert time.monotonic() - began < 2.2 * work / 8 + 0.5


def test_results_waiting_for_their_turn_are_bounded():
    started = []

    def call(i):
        started.append(i)
        if i == 0:
            time.sleep(0.3)
        return i

    results = in_order(call, ((i,) for i in range(1000)), 4, 20)
    assert next(results) == 0 and len(started) <= 21
    results.close()


def test_without_a_log(spark, tmp_path):
    scan = scan_of(spark, corpus(spark, tmp_path, "demo", [("a", "one")]))
    job = job_of(spark, tmp_path, describing_client(log_of(tmp_path)), log_answers=False)
    job.call_documents(scan.documents())
    assert not os.path.exists(f"{tmp_path}/out/calls") and job.responses(1).count() == 1


@pytest.mark.parametrize("publish_refused", [False, True])
def test_no_old_labels_of_corpora_whose_rows_are_all_refused(spark, tmp_path, publish_refused):
    path = corpus(spark, tmp_path, "demo", [("a", "one"), ("b", "two")])
    other = corpus(spark, tmp_path, "other", [("c", "three")])
    settings = {"publish_refused": publish_refused}
    log = log_of(tmp_path)
    job = job_of(spark, tmp_path, describing_client(log), **settings)
    job.run(scan_of(spark, path, other))
    assert job.annotations().count() == 3
    replace_file(spark, path, [("a", None), ("b", None)])
    scan = scan_of(spark, path, other)
    job.run(scan)
    assert [r.dataset for r in job.annotations().collect()] == ["other"]
    assert job.stale_corpora() == []
    assert {r.id: r.reasons for r in job.rejects().collect()} == {
        "a": ["null_text"], "b": ["null_text"]}
    target = f"{tmp_path}/published"
    names = publish(spark, job.annotations(), job.states(scan), target, job.settings,
                    job.rejects() if publish_refused else None)
    assert names == (["demo", "other"] if publish_refused else ["other"])
    assert [r.dataset for r in published_rows(spark, target).collect()] == ["other"]
    counts = {r.dataset: r.n_rows for r in published_manifest(spark, target).collect()}
    assert counts == ({"demo": 0, "other": 1} if publish_refused else {"other": 1})
    # Texts that come back are called for and their labels are there again.
    replace_file(spark, path, [("a", "one"), ("b", "new")])
    job.run(scan_of(spark, path, other))
    got = job.annotations().filter(F.col("dataset") == "demo").collect()
    assert {r.id: r.one_sentence_description for r in got} == {"a": "About one.", "b": "About new."}
    assert sorted(c[0] for c in calls(log)) == ["new", "one", "three", "two"]
