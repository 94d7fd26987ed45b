import json
import os
import random

import pytest
from pyspark.sql import functions as F

from labelloom.operators.model_call import TextAnnotator, chat_completions
from labelloom.operators.positions import with_rank
from labelloom.operators.resume import row_digest
from labelloom.plans.annotate import AnnotationJob, FailedCalls, OverComplete, RefusedDocuments
from labelloom.settings import Settings
from labelloom.sources.corpora import CorpusScan
from labelloom.stubs import CANONICAL_ANSWER, PromptSizeModel
from labelloom.taxonomy import ANNOTATION_TYPE, FIELD_NAMES, response_format

from pyspark.sql import types as T


def describing_client(log, trouble=""):
    """A client that notes its calls in files and fails as the document's text asks."""

    def factory():
        def call(messages, max_tokens, answer_format):
            content = messages[1]["content"]
            text = content[len("<start_of_document>\n"):-len("\n<end_of_document>\n")]
            with open(os.path.join(log, f"{os.getpid()}"), "a") as f:
                f.write(json.dumps([text[:20], max_tokens, len(content)]) + "\n")
            if trouble and trouble in text:
                raise ConnectionError("transport")
            good = json.dumps({**CANONICAL_ANSWER, "one_sentence_description": f"About {text[:50]}."})
            if text.startswith("cut") and max_tokens == 512:
                return good[:40]
            if text.startswith("silent") and max_tokens == 512:
                return None
            if text.startswith("never"):
                return "sorry"
            return good

        return call

    return factory


def calls(log):
    found = []
    for name in os.listdir(log):
        with open(os.path.join(log, name)) as f:
            found += [tuple(json.loads(line)) for line in f]
    return sorted(found)


@pytest.fixture
def log(tmp_path):
    path = tmp_path / "log"
    path.mkdir()
    return str(path)


def corpus(spark, tmp_path, name, rows, files=1):
    path = f"{tmp_path}/data/{name}/{name}.parquet"
    df = spark.createDataFrame(rows, "id string, text string").repartition(files)
    df.sortWithinPartitions("id").write.mode("append").parquet(path)
    return path


def scan_of(spark, *paths):
    files = [r.path for p in paths for r in spark.read.format("binaryFile").load(p).select("path").collect()]
    return CorpusScan(spark, tuple(files))


def job_of(spark, tmp_path, client, **settings):
    return AnnotationJob(
        spark, f"{tmp_path}/out", Settings("lab/annotator-1", slots=2, **settings), client,
        id_type=T.StringType(),
    )


def annotated(job):
    return {(r.dataset, r.id): r.one_sentence_description for r in job.annotations().collect()}


def test_records_schema_and_order(spark, tmp_path, log):
    path = corpus(spark, tmp_path, "demo", [("lake", "cold"), ("pond", "warm")])
    job = job_of(spark, tmp_path, describing_client(log))
    job.run(scan_of(spark, path))
    table = job.annotations()
    assert table.columns[:19] == ["id", *FIELD_NAMES]
    assert [f.dataType for f in table.schema.fields[1:19]] == [f.dataType for f in ANNOTATION_TYPE]
    rows = table.orderBy("dataset", "id").collect()
    assert [r.id for r in rows] == ["lake", "pond"]
    assert rows[0].one_sentence_description == "About cold."
    assert rows[1].content_type == ["reference", "news_report"]
    assert [c[1] for c in calls(log)] == [512, 512]


def test_two_attempts_and_quarantine(spark, tmp_path, log):
    rows = [("a", "cut short"), ("b", "silent"), ("c", "never"), ("d", "fine"), ("e", ""), ("f", None),
            ("g", "cut " + "x" * 4_400), ("h", "cut " + "x" * 4_000)]
    path = corpus(spark, tmp_path, "demo", rows)
    job = job_of(spark, tmp_path, describing_client(log))
    scan = scan_of(spark, path)
    job.run(scan)
    assert set(annotated(job)) == {("demo", i) for i in "abdegh"}
    assert [(r.id, r.reasons, r.attempts, r.raw) for r in job.rejects().orderBy("id").collect()] == [
        ("c", ["not_json"], 2, "sorry"), ("f", ["null_text"], 0, None),
    ]
    made = {}
    for text, budget, size in calls(log):
        made.setdefault((text, size if text.startswith("cut x") else 0), []).append(budget)
    assert made["cut short", 0] == made["silent", 0] == made["never", 0] == [512, 1024]
    assert made["fine", 0] == made["", 0] == [512]
    # The longest prompt is cut anew for the larger output; the other one is sent again.
    sizes = sorted(size for text, budget, size in calls(log) if text.startswith("cut x"))
    assert sizes == [39 + 4_004, 39 + 4_004, 39 + 4_098, 39 + 4_404]
    states = {r.dataset: r.state for r in job.states(scan).collect()}
    assert states == {"demo": "partial"}
    progress = job.progress().first()
    assert (progress.n_rows, progress.n_accepted, progress.n_refused) == (8, 6, 2)
    # Nothing is left to do: no call is made again.
    before = calls(log)
    job.run(scan)
    assert calls(log) == before and len(annotated(job)) == 6


def test_fail_on_invalid_raises_after_writing(spark, tmp_path, log):
    path = corpus(spark, tmp_path, "demo", [("a", "never"), ("b", "fine")])
    job = job_of(spark, tmp_path, describing_client(log), on_invalid="fail")
    with pytest.raises(RefusedDocuments):
        job.run(scan_of(spark, path))
    assert set(annotated(job)) == {("demo", "b")}
    assert job.rejects().count() == 1


def test_a_failed_call_costs_no_other_answer(spark, tmp_path, log):
    """With default settings: the run raises at its end, the next one makes one call."""
    first = corpus(spark, tmp_path, "alpha", [(f"u{i}", f"note u{i}") for i in range(40)])
    second = corpus(spark, tmp_path, "beta", [(f"v{i}", f"note v{i}") for i in range(5)])
    scan = scan_of(spark, first, second)
    job = job_of(spark, tmp_path, describing_client(log, "u33"))
    with pytest.raises(FailedCalls, match="u33.*transport"):
        job.run(scan)
    assert len(annotated(job)) == 44 and len(calls(log)) == 45
    states = {r.dataset: r.state for r in job.states(scan).collect()}
    assert states == {"alpha": "partial", "beta": "complete"}
    os.makedirs(f"{tmp_path}/log2")
    job = job_of(spark, tmp_path, describing_client(f"{tmp_path}/log2"))
    job.run(scan)
    assert [text for text, _, _ in calls(f"{tmp_path}/log2")] == ["note u33"]
    assert len(annotated(job)) == job.annotations().count() == 45


def test_a_call_that_fails_in_the_second_attempt_is_made_again(spark, tmp_path, log):
    path = corpus(spark, tmp_path, "demo", [("a", "silent"), ("b", "fine")])

    make = describing_client(log)

    def factory():
        call = make()

        def failing(messages, max_tokens, answer_format):
            if max_tokens != 512:
                raise TimeoutError("slow")
            return call(messages, max_tokens, answer_format)

        return failing

    with pytest.raises(FailedCalls, match="TimeoutError: slow"):
        job_of(spark, tmp_path, factory).run(scan_of(spark, path))
    job = job_of(spark, tmp_path, describing_client(log))
    job.run(scan_of(spark, path))
    assert set(annotated(job)) == {("demo", "a"), ("demo", "b")}
    assert [(text, budget) for text, budget, _ in calls(log)] == [
        ("fine", 512), ("silent", 512), ("silent", 1024)]


@pytest.mark.parametrize("seed", range(2))
def test_any_committed_subset_resumes_to_a_single_run(spark, tmp_path, log, seed):
    """Half-done files, repeated and null ids: the whole is as if never interrupted."""
    rng = random.Random(seed)
    rows = [(rng.choice(["x", "y", None, f"id{i}"]), f"{rng.choice(['cut', 'never', 'ok'])} {i}") for i in range(40)]
    path = corpus(spark, tmp_path, "demo", rows, files=3)
    scan = scan_of(spark, path)
    job = job_of(spark, tmp_path, describing_client(log))
    part = scan.documents().filter(F.xxhash64("part", "pos", F.lit(seed)) % 2 == 0)
    job.call_documents(part)
    if seed:
        job.call_retries()
    job.run(scan)
    rejected = [tuple(r) for r in job.rejects().select("id", "raw").collect()]
    got = [(r.id, r.one_sentence_description) for r in job.annotations().collect()]
    want = [(i, f"About {t}.") for i, t in rows if not t.startswith("never")]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert len(rejected) == sum(t.startswith("never") for _, t in rows)
    made = calls(log)
    assert len(made) == len(set(made)) == len(rows) + sum(not t.startswith("ok") for _, t in rows)


def replace_file(spark, path, rows):
    spark.createDataFrame(rows, "id string, text string").coalesce(1).write.mode("overwrite").parquet(
        path + ".new")
    (new,) = [f for f in os.listdir(path + ".new") if f.endswith(".parquet")]
    (old,) = [f for f in os.listdir(path) if f.endswith(".parquet")]
    for crc in (f".{old}.crc",):
        if os.path.exists(f"{path}/{crc}"):
            os.remove(f"{path}/{crc}")
    os.replace(f"{path}.new/{new}", f"{path}/{old}")


@pytest.mark.parametrize(
    ("rows", "called"),
    [
        ([("a", "sun"), ("b", "wind"), ("c", "cut fog")], ["sun", "wind"]),  # replaced in place
        ([("a", "one"), ("b", "wind"), ("c", "cut fog"), ("d", "ice")], ["ice", "wind"]),
        ([("c", "cut fog")], []),  # shrunk
        ([("z", "new"), ("a", "one"), ("b", "two"), ("c", "cut fog")], ["new"]),  # moved down
    ],
)
def test_changed_files_are_called_for_their_changed_rows_only(spark, tmp_path, log, rows, called):
    before = [("a", "one"), ("b", "two"), ("c", "cut fog")]
    path = corpus(spark, tmp_path, "demo", before)
    job = job_of(spark, tmp_path, describing_client(log))
    job.run(scan_of(spark, path))
    replace_file(spark, path, rows)
    os.makedirs(f"{tmp_path}/log2")
    job = job_of(spark, tmp_path, describing_client(f"{tmp_path}/log2"))
    assert {r.state for r in job.states(scan_of(spark, path)).collect()} == {"none"}
    job.run(scan_of(spark, path))
    assert sorted(text for text, _, _ in calls(f"{tmp_path}/log2")) == called
    assert annotated(job) == {("demo", i): f"About {t}." for i, t in rows}
    gone = {i for i, t in before if (i, t) not in rows}
    assert {r.id for r in job.orphans().collect()} == gone
    assert {r.state for r in job.states(scan_of(spark, path)).collect()} == {"complete"}
    made = calls(f"{tmp_path}/log2")
    job.run(scan_of(spark, path))
    assert calls(f"{tmp_path}/log2") == made


def test_files_under_new_names_keep_the_answers_of_their_content(spark, tmp_path, log):
    path = corpus(spark, tmp_path, "demo", [("a", "one"), ("b", "two")])
    job_of(spark, tmp_path, describing_client(log)).run(scan_of(spark, path))
    spark.createDataFrame([("a", "one"), ("b", "wind")], "id string, text string").coalesce(
        1).write.mode("overwrite").parquet(path)
    job = job_of(spark, tmp_path, describing_client(log))
    job.run(scan_of(spark, path))
    assert annotated(job) == {("demo", "a"): "About one.", ("demo", "b"): "About wind."}
    assert sorted(text for text, _, _ in calls(log)) == ["one", "two", "wind"]
    assert [r.id for r in job.orphans().collect()] == ["b"]


def test_more_answers_than_rows_of_a_version_are_refused(spark, tmp_path, log):
    path = corpus(spark, tmp_path, "demo", [("a", "one"), ("b", "two")])
    scan = scan_of(spark, path)
    job = job_of(spark, tmp_path, describing_client(log))
    job.run(scan)
    job.call_documents(scan.documents().limit(1).withColumn("text", F.lit("changed")))
    with pytest.raises(OverComplete):
        job.run(scan)
    with pytest.raises(OverComplete):
        job.states(scan)


def test_empty_corpus_makes_no_call_and_no_output(spark, tmp_path, log):
    path = corpus(spark, tmp_path, "demo", [])
    job = job_of(spark, tmp_path, describing_client(log))
    scan = scan_of(spark, path)
    job.run(scan)
    assert calls(log) == [] and job.annotations().count() == 0 and job.progress().count() == 0
    assert [tuple(r) for r in job.states(scan).collect()] == [("demo", 0, 0, "empty")]


def test_adopting_records_known_by_position(spark, tmp_path, log):
    path = corpus(spark, tmp_path, "demo", [("s1", "north"), ("s2", "south"), ("s3", "east")])
    scan = scan_of(spark, path)
    job = job_of(spark, tmp_path, describing_client(log))
    records = spark.createDataFrame(
        [("demo", 0, "s1", CANONICAL_ANSWER), ("demo", 1, "moved", CANONICAL_ANSWER)],
        T.StructType([
            T.StructField("dataset", T.StringType()), T.StructField("rank", T.LongType()),
            T.StructField("id", T.StringType()), T.StructField("annotation", ANNOTATION_TYPE),
        ]),
    )
    ranked = with_rank(scan.documents(), ["dataset"])
    job.adopt(records, ranked)
    job.adopt(records, ranked)
    job.run(scan)
    assert annotated(job) == {
        ("demo", "s1"): CANONICAL_ANSWER["one_sentence_description"],
        ("demo", "s2"): "About south.", ("demo", "s3"): "About east.",
    }
    assert [text for text, _, _ in calls(log)] == ["east", "south"]


def test_one_call_stage_and_no_shuffle_of_text(spark, sf_dir, capsys):
    from labelloom.operators.token_budget import CharCounter
    from labelloom.plans.attempts import first_attempt

    scan = CorpusScan(spark, (f"{sf_dir}/documents.parquet",), "doc_id", "text", F.col("source"))
    documents = scan.documents().withColumn("digest", row_digest(F.col("id"), F.col("text")))
    first_attempt(documents, CharCounter(), PromptSizeModel(), Settings("m")).explain()
    plan = capsys.readouterr().out
    assert plan.count("+- ArrowEvalPython") == 1
    assert "Exchange" not in plan


def test_chat_completions_adapter():
    class Client:
        class chat:
            class completions:
                @staticmethod
                def create(**request):
                    assert request["model"] == "lab/annotator-1"
                    assert request["max_tokens"] == 512
                    assert request["response_format"] == response_format()
                    message = type("M", (), {"content": "{}"})()
                    return type("R", (), {"choices": [type("C", (), {"message": message})()]})()

    call = chat_completions(Client, "lab/annotator-1")()
    assert call([], 512, response_format()) == "{}"


def test_annotators_get_whole_texts_once_and_are_taken_as_they_are(spark, tmp_path):
    long = "brook " * 3_500
    path = corpus(spark, tmp_path, "demo", [("a", long), ("b", "odd"), ("c", None)])
    canonical = dict(CANONICAL_ANSWER)

    class Annotator:
        def annotate(self, text):
            label = "unheard_of" if text == "odd" else "good"
            return {**canonical, "content_quality": label, "one_sentence_description": text}

    job = job_of(spark, tmp_path, TextAnnotator(Annotator))
    job.run(scan_of(spark, path))
    assert annotated(job) == {("demo", "a"): long, ("demo", "b"): "odd"}
    assert {r.content_quality for r in job.annotations().collect()} == {"good", "unheard_of"}
    assert [r.reasons for r in job.rejects().collect()] == [["null_text"]]
    assert job.responses(2).count() == 0


def test_files_keep_the_input_order(spark, tmp_path, log):
    """Order of arrival does not matter: rows are written in the order of their corpus."""
    import pyarrow.parquet as pq

    path = f"{tmp_path}/data/demo/demo.parquet"
    rows = [(f"id{i * 7 % 50}", f"text {i}") for i in range(50)]
    spark.createDataFrame(rows, "id string, text string").coalesce(1).write.parquet(path)
    job = job_of(spark, tmp_path, describing_client(log))
    job.run(scan_of(spark, path))
    (file,) = [r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .load(job.annotations_path).select("path").collect() if r.path.endswith(".parquet")]
    assert pq.read_table(file.removeprefix("file:"))["id"].to_pylist() == [i for i, _ in rows]



def files_of(folder):
    return {
        os.path.join(at, name): os.stat(os.path.join(at, name)).st_mtime_ns
        for at, _, names in os.walk(folder) for name in names if name.endswith(".parquet")
    }


def test_only_the_buckets_of_new_and_changed_files_are_rewritten(spark, tmp_path, log):
    path = corpus(spark, tmp_path, "demo", [(f"a{i}", f"old {i}") for i in range(40)], files=4)
    job = job_of(spark, tmp_path, describing_client(log), parts_per_commit=2)
    job.run(scan_of(spark, path))
    before = files_of(job.annotations_path)
    assert {f.split("bucket=")[1][0] for f in before} == {"0", "1"}
    # In the order of their names, files fill bucket after bucket.
    homes = [r.bucket for r in job.files().orderBy("part").collect()]
    assert homes == [0, 0, 1, 1]
    # Two more files of another corpus take a new bucket, a third one the next.
    other = corpus(spark, tmp_path, "other", [(f"b{i}", f"new {i}") for i in range(30)], files=3)
    job.run(scan_of(spark, path, other))
    after = files_of(job.annotations_path)
    assert {f: t for f, t in after.items() if f in before} == before
    assert {f.split("bucket=")[1][0] for f in set(after) - set(before)} == {"2", "3"}
    assert job.annotations().count() == 70 and job.stale() == []
    # A file that arrives later fills the last bucket up; nothing else is touched.
    corpus(spark, tmp_path, "other", [("b99", "late")])
    job.run(scan_of(spark, path, other))
    last = files_of(job.annotations_path)
    same = {f: t for f, t in after.items() if "bucket=3" not in f}
    assert {f: t for f, t in last.items() if f in same} == same
    assert all("bucket=3" in f for f in set(last) - set(after))
    assert job.annotations().count() == 71 and len(calls(log)) == 71


def test_a_bucket_is_brought_up_to_date_without_reading_others(spark, tmp_path, log):
    path = corpus(spark, tmp_path, "demo", [(f"a{i}", f"cut {i}") for i in range(6)], files=2)
    job = job_of(spark, tmp_path, describing_client(log), parts_per_commit=1)
    job.run(scan_of(spark, path))
    second = job.files().filter("bucket = 1")
    assert job.buckets_of(second) == [1]
    # Were answers of the other bucket read, its broken files would stop the job.
    for attempt in (1, 2):
        for file in files_of(f"{job._attempt_path(attempt)}/bucket=0"):
            with open(file, "wb") as f:
                f.write(b"broken")
    (part,) = [r.part for r in second.collect()]
    assert job.call_open_parts(scan_of(spark, path).only([part]), arrived=True) == [1]
    job.call_retries([1])
    job.derive_tables(job.stale([1]))
    job.settle_failures([1])
    assert job.annotations().count() == 6 and len(calls(log)) == 12


@pytest.mark.parametrize("text", ["bad", "cut bad"])
def test_calls_that_keep_failing_end_as_rejects(spark, tmp_path, log, text):
    """In either attempt; a file that changes gives its rows another try."""
    path = corpus(spark, tmp_path, "demo", [("a", "fine"), ("b", text)])

    def client(messages, max_tokens, answer_format, call=describing_client(log)()):
        answer = call(messages, max_tokens, answer_format)
        if "bad" in messages[1]["content"] and ("cut" not in text or max_tokens == 1024):
            raise ConnectionError("transport")
        return answer

    job = job_of(spark, tmp_path, lambda: client, call_tries=2, publish_refused=True)
    scan = scan_of(spark, path)
    with pytest.raises(FailedCalls):
        job.run(scan)
    assert job.rejects().count() == 0
    job.run(scan)
    made = len(calls(log))
    job.run(scan)
    assert len(calls(log)) == made == (4 if text.startswith("cut") else 3)
    (reject,) = job.rejects().collect()
    assert (reject.id, reject.raw, reject.reasons) == ("b", None, ["call_failed"])
    assert set(annotated(job)) == {("demo", "a")}
    assert [r.state for r in job.states(scan).collect()] == ["complete"]
    replace_file(spark, path, [("a", "fine"), ("b", text), ("c", "more")])
    with pytest.raises(FailedCalls):
        job.run(scan_of(spark, path))
    assert set(annotated(job)) == {("demo", "a"), ("demo", "c")}
