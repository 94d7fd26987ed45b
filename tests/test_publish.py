import os

import pandas as pd
import pytest

from labelloom.plans.collection import Collection
from labelloom.plans.publish import (
    MANIFEST_TYPE,
    publish,
    published_manifest,
    published_paths,
    published_rows,
)
from labelloom.settings import Settings
from labelloom.sources.corpora import UnavailableCorpora
from labelloom.stubs import CANONICAL_ANSWER
from labelloom.taxonomy import ANNOTATION_TYPE
from labelloom.streaming.incremental import IncrementalAnnotation

from test_corpora import POINTER, write_text
from test_job import (
    annotated,
    calls,
    corpus,
    describing_client,
    job_of,
    replace_file,
    scan_of,
)

PATH = "annotations/{}/lab--annotator-1.parquet"
PLACE = "annotations/model_slug=lab--annotator-1/dataset={}"


@pytest.fixture
def log(tmp_path):
    (tmp_path / "log").mkdir()
    return str(tmp_path / "log")


def collection(spark, tmp_path, log, **changes):
    given = {
        "root": f"{tmp_path}/data", "out": f"{tmp_path}/out", "target": f"{tmp_path}/target",
        "settings": Settings("lab/annotator-1", slots=2), "client_factory": describing_client(log),
    }
    return Collection(spark, **{**given, **changes})


def test_a_missing_target_has_an_empty_manifest(spark, tmp_path):
    for _ in range(2):
        manifest = published_manifest(spark, f"{tmp_path}/new")
        assert manifest.schema == MANIFEST_TYPE and manifest.count() == 0


def test_nothing_published_has_no_rows_but_all_columns(spark, tmp_path, log):
    """A corpus with a refused row is not whole; the first one that is changes no column."""
    job = job_of(spark, tmp_path, describing_client(log))
    scan = scan_of(spark, corpus(spark, tmp_path, "alpha", [("a1", "one"), ("a2", None)]))
    target = f"{tmp_path}/published"
    job.run(scan)
    assert publish(spark, job.annotations(), job.states(scan), target, job.settings) == []
    none = published_rows(spark, target, job.id_type)
    assert none.collect() == []
    other = scan_of(spark, corpus(spark, tmp_path, "beta", [("b1", "one")]))
    job.run(other)
    assert publish(spark, job.annotations(), job.states(other), target, job.settings) == ["beta"]
    published = published_rows(spark, target, job.id_type)
    assert published.count() == 1 and published.schema == none.schema


def test_collection_from_files_to_published_tables(spark, tmp_path, log):
    corpus(spark, tmp_path, "alpha", [("a1", "one"), ("a2", "two")])
    corpus(spark, tmp_path, "beta", [("b1", "never"), ("b2", "two")])
    corpus(spark, tmp_path, "default", [("d1", "no corpus")])
    write_text(tmp_path / "data" / "gamma" / "gamma.parquet", POINTER)
    corpus(spark, tmp_path / "spare", "gamma", [("g1", "spare")])
    work = collection(spark, tmp_path, log, fallback_root=f"{tmp_path}/spare/data")

    assert work.annotate("alpha") == ["alpha"]
    assert {r.path for r in published_paths(spark, work.target).collect()} == {PATH.format("alpha")}
    assert [text for text, _, _ in calls(log)] == ["one", "two"]

    assert work.annotate() == ["gamma"]
    manifest = published_manifest(spark, work.target).orderBy("dataset").collect()
    assert [tuple(r) for r in manifest] == [
        ("alpha", PATH.format("alpha"), PLACE.format("alpha"),
         "Add alpha annotations with lab/annotator-1", 2),
        ("gamma", PATH.format("gamma"), PLACE.format("gamma"),
         "Add gamma annotations with lab/annotator-1", 1),
    ]
    published = published_rows(spark, work.target)
    assert {(r.dataset, r.id) for r in published.collect()} == {
        ("alpha", "a1"), ("alpha", "a2"), ("gamma", "g1"),
    }
    made = calls(log)
    assert work.annotate() == [] and work.publish_existing() == []
    assert calls(log) == made


def test_existing_complete_annotations_are_published(spark, tmp_path, log):
    path = corpus(spark, tmp_path, "alpha", [("a1", "one")])
    other = corpus(spark, tmp_path, "beta", [("b1", "one"), ("b2", "two")])
    work = collection(spark, tmp_path, log)
    scan = scan_of(spark, path, other)
    job = work.job("string", scan)
    job.open_parts(scan)
    job.call_documents(scan.documents().filter("id <> 'b2'"))
    assert work.publish_existing("beta") == []
    assert work.publish_existing() == ["alpha"]


def test_stream_of_arriving_files(spark, tmp_path, log):
    path = corpus(spark, tmp_path, "alpha", [("a1", "one"), ("a2", "cut two")], files=2)
    job = job_of(spark, tmp_path, describing_client(log))
    schema = spark.read.parquet(path).schema

    def arrive(checkpoint):
        IncrementalAnnotation(
            job, scan_of(spark, path), f"{tmp_path}/data", schema, f"{tmp_path}/{checkpoint}", 1
        ).catch_up()

    arrive("ledger")
    assert annotated(job) == {("alpha", "a1"): "About one.", ("alpha", "a2"): "About cut two."}
    corpus(spark, tmp_path, "alpha", [("a3", "three")])
    corpus(spark, tmp_path, "beta", [("b1", "four")])
    arrive("ledger")
    assert set(annotated(job)) == {("alpha", "a1"), ("alpha", "a2"), ("alpha", "a3"), ("beta", "b1")}
    made = calls(log)
    assert len(made) == 5
    # A lost ledger replays every file; no row is called for again.
    arrive("other")
    assert calls(log) == made and job.annotations().count() == 4


def test_a_running_stream_takes_up_files_replaced_in_place(spark, tmp_path, log):
    path = corpus(spark, tmp_path, "alpha", [("a1", "one"), ("a2", "two")])
    (file,) = [f for f in os.listdir(path) if f.endswith(".parquet")]
    was = os.stat(f"{path}/{file}")
    job = job_of(spark, tmp_path, describing_client(log))
    incremental = IncrementalAnnotation(
        job, scan_of(spark, path), f"{tmp_path}/data", spark.read.parquet(path).schema,
        f"{tmp_path}/ledger",
    )
    stream = incremental.start(processingTime="0 seconds")
    try:
        stream.processAllAvailable()
        assert set(annotated(job)) == {("alpha", "a1"), ("alpha", "a2")}
        new = f"{tmp_path}/new"
        pd.DataFrame({"id": ["a1", "a2", "a3"], "text": ["one", "2", "3"]}).to_parquet(new)
        os.remove(f"{path}/.{file}.crc")  # the old content's, on local disks
        os.replace(new, f"{path}/{file}")
        stream.processAllAvailable()
        assert annotated(job) == {
            ("alpha", "a1"): "About one.", ("alpha", "a2"): "About 2.", ("alpha", "a3"): "About 3."}
        # A file that is moved in with an older time is news all the same.
        pd.DataFrame({"id": ["b1"], "text": ["four"]}).to_parquet(new)
        os.utime(new, ns=(was.st_mtime_ns - 10**12,) * 2)
        os.replace(new, f"{path}/b.parquet")
        stream.processAllAvailable()
        assert len(annotated(job)) == 4
    finally:
        stream.stop()
    assert sorted(c[0] for c in calls(log)) == ["2", "3", "four", "one", "two"]
    incremental.catch_up()  # nothing has changed since
    assert len(calls(log)) == 5 and job.annotations().count() == 4


def test_ids_of_several_types_and_refused_rows(spark, tmp_path, log):
    corpus(spark, tmp_path, "alpha", [("a1", "one"), ("a2", "never")])
    spark.range(2).selectExpr("id", "'t' AS text").write.parquet(f"{tmp_path}/data/num/num.parquet")
    assert collection(spark, tmp_path, log).annotate() == ["num"]
    settings = Settings("lab/annotator-1", slots=2, publish_refused=True)
    work = collection(spark, tmp_path, log, settings=settings)
    assert work.annotate() == ["alpha"]
    rows = {r.dataset: r.n_rows for r in published_manifest(spark, work.target).collect()}
    assert rows == {"alpha": 1, "num": 2}
    refused = spark.read.parquet(f"{work.target}/rejects").collect()
    assert [(r.dataset, r.id) for r in refused] == [("alpha", "a2")]


def test_unavailable_corpora_are_named(spark, tmp_path, log):
    corpus(spark, tmp_path, "alpha", [("a1", "one")])
    write_text(tmp_path / "data" / "gamma" / "gamma.parquet", POINTER)
    work = collection(spark, tmp_path, log)
    assert work.annotate("alpha") == ["alpha"]
    for wanted in ("gamma", "nope"):
        with pytest.raises(UnavailableCorpora, match=wanted):
            work.annotate(wanted)
    with pytest.raises(UnavailableCorpora, match="gamma"):
        work.annotate()


def test_replaced_files_are_not_published_with_old_labels(spark, tmp_path, log):
    path = corpus(spark, tmp_path, "alpha", [("a1", "one"), ("a2", "two")])
    work = collection(spark, tmp_path, log)
    scan = scan_of(spark, path)
    work.job("string", scan).run(scan)
    replace_file(spark, path, [("a1", "other"), ("a2", "two")])
    assert work.publish_existing() == []
    assert work.annotate() == ["alpha"]
    rows = {r.id: r.one_sentence_description for r in published_rows(spark, work.target).collect()}
    assert rows == {"a1": "About other.", "a2": "About two."}


def test_parts_of_an_interrupted_run_are_taken_over(spark, tmp_path, log):
    corpus(spark, tmp_path, "alpha", [("a1", "one"), ("a2", "two"), ("a3", "three")])
    for name, ids in (("tmp", ["a1"]), ("part1", ["a2"]), ("part3", ["a3"])):
        rows = spark.createDataFrame(
            [(i, CANONICAL_ANSWER) for i in ids], f"id string, a {ANNOTATION_TYPE.simpleString()}")
        rows.select("id", "a.*").coalesce(1).write.parquet(
            f"{tmp_path}/parts/alpha/lab--annotator-1.{name}.parquet")
    work = collection(spark, tmp_path, log)
    work.adopt_parts(f"{tmp_path}/parts")
    assert work.annotate() == ["alpha"]
    assert [text for text, _, _ in calls(log)] == ["three"]
