"""Every file is seen, empty ones too; footers are read by tasks."""

import os

import pytest
from pyspark.sql import types as T

from labelloom.plans.collection import Collection
from labelloom.settings import Settings
from labelloom.sources.corpora import (
    CorpusScan,
    UnavailableCorpora,
    corpus_files,
    corpus_manifest,
    footers,
)
from labelloom.sources.listing import FolderReader, listed_files
from labelloom.stubs import PromptSizeModel


def write(spark, path, rows=(("a", "one"),), kind="string"):
    spark.createDataFrame(list(rows), f"id {kind}, text string").coalesce(1).write.mode(
        "append").parquet(path)


def empty_file(path):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w"):
        pass


def test_listing_equals_the_reader_and_shows_empty_files(spark, tmp_path):
    root = f"{tmp_path}/a b+c%"
    write(spark, f"{root}/one/one.parquet")
    write(spark, f"{root}/two/k=_x/two.parquet")
    empty_file(f"{root}/none/none.parquet")
    empty_file(f"{root}/_hidden/x.parquet")
    empty_file(f"{root}/top.parquet")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    want = {(r.path, r.length) for r in reader.option("pathGlobFilter", "*.parquet").load(root)
            .select("path", "length").collect()}
    got = {tuple(r) for r in listed_files(spark, root, "*.parquet").collect()}
    assert want < got
    assert {p.removeprefix(f"file:{root}/") for p, n in got - want if n == 0} == {
        "none/none.parquet", "top.parquet"}
    (name,) = [p for p, _ in want if "/one/" in p]
    assert [tuple(r) for r in listed_files(spark, name, "*").collect()] == [
        (name, dict(want)[name])]
    assert listed_files(spark, f"{root}/nowhere", "*").count() == 0


def test_folders_are_dealt_to_tasks(tmp_path):
    for i in range(450):
        os.makedirs(f"{tmp_path}/c{i}")
    parts = FolderReader(str(tmp_path), "*").partitions()
    assert len(parts) == 200 and sum(len(p.value) for p in parts) == 450


def test_empty_files_have_a_state(spark, tmp_path):
    write(spark, f"{tmp_path}/good/good.parquet")
    empty_file(f"{tmp_path}/lost/lost.parquet")
    write(spark, f"{tmp_path}/torn/torn.parquet")
    empty_file(f"{tmp_path}/torn/torn.parquet/part-9.parquet")
    states = corpus_manifest(corpus_files(spark, str(tmp_path))).collect()
    assert {r.dataset: (r.status, r.n_files) for r in states} == {
        "good": ("ready", 1), "lost": ("empty", 1), "torn": ("empty", 2)}


def collection(spark, tmp_path, spare=None):
    return Collection(
        spark, f"{tmp_path}/data", f"{tmp_path}/out", f"{tmp_path}/to", Settings("m"),
        PromptSizeModel(), fallback_root=spare)


@pytest.mark.parametrize("part", ["lost.parquet", "lost.parquet/part-9.parquet"])
def test_a_corpus_with_an_empty_file_is_refused_by_name(spark, tmp_path, part):
    write(spark, f"{tmp_path}/data/good/good.parquet")
    if "/" in part:
        write(spark, f"{tmp_path}/data/lost/lost.parquet")
    empty_file(f"{tmp_path}/data/lost/{part}")
    with pytest.raises(UnavailableCorpora, match=f"lost .empty: .*{part}"):
        collection(spark, tmp_path).annotate()
    write(spark, f"{tmp_path}/spare/lost/lost.parquet", [("b", "two")])
    made = collection(spark, tmp_path, f"{tmp_path}/spare").annotate()
    assert made == ["good", "lost"]


def test_a_thousand_footers_in_a_few_tasks(spark, tmp_path):
    write(spark, f"{tmp_path}/x/x.parquet", [(str(i), "t") for i in range(3)])
    (path,) = [r.path for r in corpus_files(spark, str(tmp_path)).collect()]
    paths = []
    for i in range(1000):
        os.makedirs(f"{tmp_path}/c{i}")
        os.link(path.removeprefix("file:"), f"{tmp_path}/c{i}/c{i}.parquet")
        paths.append(f"file:{tmp_path}/c{i}/c{i}.parquet")
    found = footers(spark, paths)
    assert found.rdd.getNumPartitions() == 16
    rows = found.collect()
    assert {r.path for r in rows} == set(paths)
    assert {(r.n_rows, *r.columns, *r.types) for r in rows} == {
        (3, "id", "text", "string", "string")}
    scans = CorpusScan(spark, tuple(paths), schema=T.StructType.fromDDL(
        "id string, text string")).by_id_type()
    assert set(scans) == {"string"} and len(scans["string"].paths) == 1000
