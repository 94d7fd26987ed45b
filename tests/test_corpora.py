import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions import paths
from labelloom.sources.corpora import (
    CorpusScan,
    corpus_files,
    corpus_manifest,
    UnavailableCorpora,
    list_corpora,
    part_counts,
    require_available,
    route_files,
    starts_with_marker,
)
from labelloom.sources.parts import (
    merge_parts,
    part_index,
    partial_outputs,
    read_parts,
    write_in_order,
)
from labelloom.stubs import CANONICAL_ANSWER
from labelloom.taxonomy import ANNOTATION_TYPE, taxonomy

POINTER = "version https://git-lfs.github.com/spec/v1\nobject 7f3a90\nbytes 88\n"


def write_corpus(spark, root, name, rows, files=1):
    df = spark.createDataFrame(rows, "id string, text string, other int").coalesce(files)
    df.write.parquet(f"{root}/{name}/{name}.parquet")


def write_text(path, content):
    path.parent.mkdir(parents=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


@pytest.fixture
def tree(spark, tmp_path):
    local, fallback = tmp_path / "local", tmp_path / "fallback"
    write_corpus(spark, local, "alpha", [("k1", "rain", 1), ("k2", "snow", 2)])
    write_text(local / "beta" / "beta.parquet", POINTER)
    write_text(local / "notes" / "other.parquet", "unrelated")
    write_corpus(spark, local, "default", [("d", "x", 0)])
    write_corpus(spark, fallback, "alpha", [("zz", "unused", 0)])
    write_corpus(spark, fallback, "beta", [("m1", "from the spare", 1)])
    write_corpus(spark, fallback, "gamma", [("p1", "hail", 1)])
    return str(local), str(fallback)


def test_manifest(spark, tree):
    names = spark.createDataFrame([("alpha",), ("beta",), ("gamma",)], "dataset string")
    rows = corpus_manifest(corpus_files(spark, tree[0]), names).collect()
    assert {r.dataset: r.status for r in rows} == {
        "alpha": "ready", "beta": "placeholder", "gamma": "missing",
    }


@pytest.mark.parametrize(
    ("content", "pointer"),
    [
        (POINTER, True),
        (POINTER.replace("\n", "\r\n"), True),
        (b"  \tversion https://git-lfs.github.com/spec/v1 \x0b\x0c", True),
        (b"\nversion https://git-lfs.github.com/spec/v1\n", False),
        (b"version https://git-lfs.github.com/spec/v1x\n", False),
        (b"PAR1\xff\xfe\x00", False),
        (POINTER.encode() + b"more\n" * 5_000, True),
        (b" " * 3_000 + POINTER.encode(), True),
        (b"version https://git-lfs.github.com/spec/v1" + b" " * 3_000 + b"x\n", False),
        (b"version https://git-lfs" * 1_000, False),
    ],
)
def test_pointer_is_its_first_line(spark, tmp_path, content, pointer):
    write_text(tmp_path / "c" / "c.parquet", content)
    assert corpus_files(spark, str(tmp_path)).first().pointer is pointer


def test_probe_stops_at_the_first_foreign_byte():
    asked = []

    def read(n):
        asked.append(n)
        return b"P" * n

    assert not starts_with_marker(read) and len(asked) == 1


def test_fallback_is_taken_whole_or_not_at_all(spark, tree, tmp_path):
    write_text(tmp_path / "spare2" / "beta" / "beta.parquet" / "a.parquet", POINTER)
    write_corpus(spark, tmp_path / "more", "beta", [("m1", "x", 1)])
    local = corpus_files(spark, tree[0])
    torn = corpus_files(spark, f"{tmp_path}/spare2").unionByName(
        corpus_files(spark, f"{tmp_path}/more"))
    routed = route_files(local, torn)
    states = {r.dataset: r.source for r in routed.select("dataset", "source").collect()}
    assert states == {"alpha": "local", "default": "local", "beta": "unavailable"}
    with pytest.raises(UnavailableCorpora, match="beta"):
        require_available(routed)
    with pytest.raises(UnavailableCorpora, match="nope"):
        require_available(routed.filter("dataset = 'nope'"), "nope")


def test_corpora_are_scanned_by_type_of_id_and_need_their_columns(spark, tmp_path):
    write_corpus(spark, tmp_path, "alpha", [("k1", "rain", 1)])
    spark.range(3).selectExpr("id", "'t' AS text").write.parquet(f"{tmp_path}/num/num.parquet")
    paths = tuple(r.path for r in corpus_files(spark, str(tmp_path)).collect())
    scans = CorpusScan(spark, tuple(p for p in paths if "alpha" in p)).by_id_type()
    assert list(scans) == ["string"]
    mixed = CorpusScan(spark, paths, schema=T.StructType.fromDDL("id string, text string"))
    kinds = mixed.by_id_type()
    assert {k: s.documents().count() for k, s in kinds.items()} == {"string": 1, "bigint": 3}
    spark.range(3).write.parquet(f"{tmp_path}/bad/bad.parquet")
    paths = tuple(r.path for r in corpus_files(spark, str(tmp_path)).collect())
    with pytest.raises(ValueError, match="bad.parquet lacks"):
        CorpusScan(spark, paths, schema=T.StructType.fromDDL("id string, text string")).by_id_type()


def test_routing_and_listing(spark, tree):
    local, fallback = (corpus_files(spark, root) for root in tree)
    routed = route_files(local, fallback)
    names = {r.dataset for r in list_corpora(routed).collect()}
    assert names == {"alpha", "beta", "gamma"}
    paths = [r.path for r in routed.filter("dataset <> 'default'").collect()]
    rows = CorpusScan(spark, tuple(paths)).documents().collect()
    assert {(r.dataset, r.id, r.text) for r in rows} == {
        ("alpha", "k1", "rain"), ("alpha", "k2", "snow"), ("beta", "m1", "from the spare"),
        ("gamma", "p1", "hail"),
    }


def test_scan_reads_two_columns_and_names_rows(spark, tmp_path, capsys):
    root = str(tmp_path)
    write_corpus(spark, root, "odd name+%", [(None, "a", 1), ("x", "b", 1), ("x", "b", 1)])
    files = corpus_files(spark, root)
    scan = CorpusScan(spark, tuple(r.path for r in files.collect()))
    rows = scan.documents().collect()
    assert {r.dataset for r in rows} == {"odd name+%"}
    assert len({(r.part, r.pos) for r in rows}) == 3
    assert {r.part for r in rows} <= set(scan.paths)
    scan.documents().explain("formatted")
    assert "ReadSchema: struct<id:string,text:string,_tmp_metadata_row_index:bigint>" in (
        capsys.readouterr().out
    )
    again = scan.only([rows[0].part]).documents()
    assert again.count() == sum(r.part == rows[0].part for r in rows)


def test_counts_read_footers_only(spark, tree, capsys):
    files = corpus_files(spark, tree[0]).filter("dataset = 'alpha'")
    scan = CorpusScan(spark, tuple(r.path for r in files.collect()))
    counts = part_counts(scan.documents())
    assert counts.agg(F.sum("n_rows")).first()[0] == 2
    counts.explain("formatted")
    assert "ReadSchema: struct<>" in capsys.readouterr().out


def test_one_corpus_is_pruned_before_reading(spark, tree):
    files = corpus_files(spark, tree[1])
    scan = CorpusScan(spark, tuple(r.path for r in files.collect())).corpus("beta")
    assert all("/beta.parquet" in path for path in scan.paths)
    assert [r.id for r in scan.documents().collect()] == ["m1"]


def test_corpus_column_filter_reaches_the_reader(spark, sf_dir, capsys):
    scan = CorpusScan(spark, (f"{sf_dir}/documents.parquet",), "doc_id", "text", F.col("source"))
    scan.corpus("src3").documents().explain("formatted")
    assert "EqualTo(source,src3)" in capsys.readouterr().out


def test_missing_column_is_refused_at_once(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/a/a.parquet")
    with pytest.raises(ValueError, match="text"):
        CorpusScan(spark, (f"{tmp_path}/a/a.parquet",))


def test_output_names(spark):
    df = spark.createDataFrame([("nota", "lab/annotator/x")], "d string, m string")
    path = paths.annotation_path(F.col("d"), F.col("m"))
    row = df.select(
        path, paths.temp_annotation_path(path), paths.resume_annotation_path(path, 3)
    ).first()
    assert list(row) == [
        "annotations/nota/lab--annotator--x.parquet",
        "annotations/nota/lab--annotator--x.tmp.parquet",
        "annotations/nota/lab--annotator--x.part3.parquet",
    ]


def write_part(spark, tmp_path, name, ids):
    import pyarrow.parquet as pq

    rows = [(i, CANONICAL_ANSWER | {"one_sentence_description": i}) for i in ids]
    df = spark.createDataFrame(rows, f"id string, a {ANNOTATION_TYPE.simpleString()}")
    path = tmp_path / "annotations" / "nota" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(df.select("id", "a.*").toArrow(), path)


def test_parts_count_until_the_first_gap(spark, tmp_path):
    for name in ("m.tmp.parquet", "m.part1.parquet", "m.part2.parquet", "m.part4.parquet",
                 "m.parquet", "m.part0.parquet", "other.part2.parquet"):
        write_part(spark, tmp_path, name, [name])
    found = partial_outputs(spark, str(tmp_path)).orderBy("part_index").collect()
    assert [(r.dataset, r.model_slug, r.part_index) for r in found] == [
        ("nota", "m", 0), ("nota", "m", 1), ("nota", "m", 2),
    ]
    rows = read_parts(spark, [r.path for r in found]).orderBy("part", "pos").collect()
    assert [r.id for r in rows] == ["m.tmp.parquet", "m.part1.parquet", "m.part2.parquet"]
    assert rows[0].dataset == "nota"


def test_part_index(spark):
    df = spark.createDataFrame([("/a/d/m.part12.parquet",), ("/a/d/m.parquet",)], "p string")
    assert [r[0] for r in df.select(part_index(F.col("p"))).collect()] == [12, None]


def test_merge_matches_columns_by_name(spark):
    a = spark.createDataFrame([("q-7", "a")], "id string, d string")
    b = spark.createDataFrame([("b", "q-8")], "d string, id string")
    assert [r.id for r in merge_parts(a, b).collect()] == ["q-7", "q-8"]


def test_merged_files_give_the_input_order_by_their_names(spark, tmp_path):
    """Corpora of many and of few rows, parts of uneven sizes, repeated and null ids."""
    import glob

    import pyarrow.parquet as pq

    sizes = {"big": {"p1": 7, "p2": 90, "p3": 3}, "mid": {"p1": 10}, "one": {"p9": 1}}
    rows = [(d, p, i, f"{p}-{i}" if i % 5 else None)
            for d, parts in sizes.items() for p, n in parts.items() for i in range(n)]
    schema = "dataset string, part string, pos long, id string"
    shuffled = spark.createDataFrame(rows[::-1], schema).repartition(5)
    write_in_order(shuffled, f"{tmp_path}/out", 10)
    for dataset, n_files in (("big", 10), ("mid", 1), ("one", 1)):
        files = sorted(glob.glob(f"{tmp_path}/out/dataset={dataset}/*.parquet"))
        tables = [pq.read_table(f, partitioning=None)["id"].to_pylist() for f in files]
        assert len(files) == n_files and all(len(t) == 10 for t in tables[:-1])
        assert sum(tables, []) == [i for d, _, _, i in rows if d == dataset]
    with pytest.raises(ValueError, match="mid"):
        write_in_order(shuffled.filter("dataset <> 'mid' OR pos <> 4"), f"{tmp_path}/gap", 10)
    write_in_order(shuffled.limit(0), f"{tmp_path}/none", 10)
    assert not glob.glob(f"{tmp_path}/none*")


def test_taxonomy(spark):
    rows = taxonomy(spark).collect()
    assert len(rows) == 131
    assert len({r.field for r in rows}) == 16
    assert "global" in {r.value for r in rows if r.field == "regional_relevance"}


def test_length_bands_at_their_edges(spark):
    from labelloom.functions.length_band import length_band

    rows = [(n, " \t".join(["w"] * n) + "\n") for n in (0, 1, 99, 100, 499, 500, 1_999, 2_000)]
    df = spark.createDataFrame([*rows, (None, None)], "n int, text string")
    assert {r[0]: r[1] for r in df.select("n", length_band(F.col("text"))).collect()} == {
        0: "minimal", 1: "minimal", 99: "minimal", 100: "brief", 499: "brief",
        500: "moderate", 1_999: "moderate", 2_000: "substantial", None: None,
    }
