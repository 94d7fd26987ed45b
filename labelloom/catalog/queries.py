"""Every operator as a query over the test tables: ``(spark, sf_dir) -> DataFrame``.

``documents`` is read as twenty corpora, one per source. Two derived inputs recur:

* model answers: written by an expression over the text's size (``answers.py``), so
  that SQL can build the very same strings;
* finished rows: the documents that ``labels`` covers.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.catalog.answers import FIRST_ANSWER, SECOND_ANSWER, WHOLE_ANSWER
from labelloom.deploy import ship_package
from labelloom.fixed_values import POINTER_FIRST_LINE
from labelloom.functions import paths, prompts
from labelloom.functions.length_band import length_band
from labelloom.functions.validation import (
    parse_annotations,
    response_status,
    with_reject_reasons,
)
from labelloom.operators import positions, resume
from labelloom.operators.model_call import TextAnnotator, spread
from labelloom.operators.token_budget import CharCounter, Counter, Messages, ModelCounter
from labelloom.plans.annotate import AnnotationJob
from labelloom.plans.attempts import bounded_prompts, first_attempt, records, retry_bounds
from labelloom.plans.publish import publish, published_manifest
from labelloom.plans.publish import published_rows as read_published
from labelloom.settings import Settings
from labelloom.sources import corpora
from labelloom.sources.corpora import CorpusScan
from labelloom.sources.files import file_system, full_address
from labelloom.sources.parts import (
    merge_part_files,
    merge_parts,
    partial_outputs,
    read_parts,
)
from labelloom.sources.tables import scratch_root
from labelloom.streaming.incremental import IncrementalAnnotation
from labelloom.stubs import CANONICAL_ANSWER, PromptSizeModel
from labelloom.taxonomy import LIST_FIELDS, FIELD_NAMES, taxonomy

SETTINGS = Settings("lab/annotator-1")
CHARS = CharCounter()

Query = Callable[[SparkSession, str], DataFrame]


# -- inputs -----------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scan(spark: SparkSession, sf_dir: str) -> CorpusScan:
    return CorpusScan(
        spark, (f"{sf_dir}/documents.parquet",), "doc_id", "text", F.col("source")
    )


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, sf_dir).documents()


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, sf_dir).documents(keyed=False)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), "quality", "toxic"
    )


def _finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(dataset, id)`` of the documents that carry a label."""
    return (
        _texts(spark, sf_dir)
        .select("dataset", "id")
        .join(_labelled(spark, sf_dir), "id", "left_semi")
    )


def _answers(documents: DataFrame, *kept: str) -> DataFrame:
    """``raw`` and ``again``: what a model answers on the first and second attempt."""
    return documents.select(
        *kept, F.length("text").alias("size"), F.expr(WHOLE_ANSWER).alias("whole")
    ).select(*kept, F.expr(FIRST_ANSWER).alias("raw"), F.expr(SECOND_ANSWER).alias("again"))


def _first_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(_texts(spark, sf_dir), "dataset", "id").drop("again")


def flat(annotations: DataFrame) -> DataFrame:
    """Lists joined into text, so that rows compare as plain values."""
    return annotations.select(
        *[
            F.array_join(name, ",").alias(name) if name in LIST_FIELDS else F.col(name)
            for name in annotations.columns
        ]
    )


def _char_tokens() -> Callable[[Messages], int]:
    return lambda messages: sum(len(message["content"]) for message in messages)


# -- scans and names --------------------------------------------------------------


def scan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("dataset", "id", "text")


def select_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = _scan(spark, sf_dir).corpus("src3")
    return scan.documents(keyed=False).select("dataset", "id", "text")


def scan_corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All text tables as corpora of one frame, each with its own kind of id."""

    def corpus(table: str, dataset: Column, row_id: Column, text: str) -> DataFrame:
        return _table(spark, sf_dir, table).select(
            dataset.alias("dataset"), row_id.cast("string").alias("id"), F.col(text).alias("text")
        )

    turn = F.concat_ws("-", "conv_id", "turn")
    return merge_parts(
        corpus("documents", F.col("source"), F.col("doc_id"), "text"),
        corpus("benchmark", F.lit("benchmark"), F.col("item_id"), "text"),
        corpus("pages", F.lit("pages"), F.col("page_id"), "html"),
        corpus("conversations", F.lit("conversations"), turn, "text"),
    ).select("dataset", "id", F.length("text").alias("n_chars"))


def list_corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.list_corpora(_texts(spark, sf_dir))


def corpus_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of the text tables' files; one wanted table is absent, one a file of no bytes."""
    name = F.regexp_extract("path", r"/([^/]+)\.parquet(?:/[^/]+)?$", 1)
    files = corpora.corpus_files(spark, sf_dir, name)
    job = _job(spark, "manifest")
    job.files()  # makes the tables, whose address tells where files of the job are
    system, folder = file_system(full_address(spark, job.root, f"{job.root}/{_FILES}"))
    system.create_dir(f"{folder}/lost", recursive=True)
    system.open_output_stream(f"{folder}/lost/nothing.parquet").close()
    files = files.unionByName(corpora.corpus_files(spark, f"{job.root}/lost", name))
    wanted = files.select("dataset").filter(F.col("dataset").isin(
        "documents", "pages", "benchmark", "conversations", "nothing")
    ).distinct().unionByName(files.select(F.lit("absent").alias("dataset")).distinct())
    return corpora.corpus_manifest(files, wanted).select("dataset", "status")


def part_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = corpora.part_counts(_documents(spark, sf_dir))
    return counts.groupBy("dataset").agg(F.sum("n_rows").alias("n_rows"))


def output_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    named = list_corpora(spark, sf_dir).withColumn(
        "path", paths.annotation_path(F.col("dataset"), F.lit(SETTINGS.model_name))
    )
    return named.select(
        "dataset",
        paths.model_slug(F.lit(SETTINGS.model_name)).alias("slug"),
        "path",
        paths.temp_annotation_path(path).alias("temp_path"),
        paths.resume_annotation_path(path, 2).alias("part_path"),
        paths.publish_message(F.col("dataset"), F.lit(SETTINGS.model_name)).alias("message"),
    )


# -- prompts and budgets ----------------------------------------------------------


def truncate_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = prompts.truncate_content(F.col("text"), 1_000)
    return _texts(spark, sf_dir).select("dataset", "id", content.alias("content"))


def build_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = prompts.chat_messages(F.col("text"), SETTINGS.max_content_chars)
    return (
        _texts(spark, sf_dir)
        .select("dataset", "id", messages.alias("messages"))
        .select(
            "dataset", "id",
            F.col("messages")[0]["role"].alias("first_role"),
            F.col("messages")[0]["content"].alias("first_content"),
            F.col("messages")[1]["role"].alias("second_role"),
            F.col("messages")[1]["content"].alias("second_content"),
        )
    )


def prompt_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select(
        "dataset", "id", CHARS.count(F.col("text")).alias("prompt_tokens")
    )


def prompt_tokens_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts from an injected counter."""
    ship_package(spark)
    counter = ModelCounter(_char_tokens)
    return _texts(spark, sf_dir).select(
        "dataset", "id", counter.count(F.col("text")).alias("prompt_tokens")
    )


def fits_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = F.col("prompt_tokens")
    return prompt_tokens(spark, sf_dir).select(
        "dataset", "id",
        prompts.fits_context(tokens, SETTINGS, 1).alias("fits_first"),
        prompts.fits_context(tokens, SETTINGS, 2).alias("fits_second"),
    )


def _bounds(spark: SparkSession, sf_dir: str, counter: Counter, settings: Settings) -> DataFrame:
    return bounded_prompts(_texts(spark, sf_dir), counter, settings).select(
        "dataset", "id", "char_limit", "prompt_tokens", "over_budget"
    )


def token_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bounds(spark, sf_dir, CHARS, SETTINGS)


def token_bounded_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A content cap below the budget, so that the cap decides."""
    return _bounds(spark, sf_dir, CHARS, Settings(SETTINGS.model_name, max_content_chars=900))


def token_bounded_tight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A context too small for even an empty prompt: sent all the same, and flagged."""
    return _bounds(spark, sf_dir, CHARS, Settings(SETTINGS.model_name, max_context_tokens=3_590))


def token_bounded_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The halving search around an injected counter, in Arrow batches."""
    ship_package(spark)
    return _bounds(spark, sf_dir, ModelCounter(_char_tokens), SETTINGS)


def retry_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = bounded_prompts(_texts(spark, sf_dir), CHARS, SETTINGS)
    return retry_bounds(first, CHARS, SETTINGS).select(
        "dataset", "id", "char_limit", "prompt_tokens", "over_budget"
    )


# -- validation and retry ---------------------------------------------------------


def parsed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_annotations(_first_answers(spark, sf_dir))
    return flat(
        parsed.filter(F.col("annotation").isNotNull()).select("dataset", "id", "annotation.*")
    )


def alias_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aliased field under its own name, whichever spelling the answer used."""
    parsed = parse_annotations(_first_answers(spark, sf_dir))
    return parsed.select(
        "dataset", "id", F.col("annotation.time_sensitivity").alias("time_sensitivity")
    )


def response_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = response_status(F.col("raw"), F.col("annotation"))
    return parse_annotations(_first_answers(spark, sf_dir)).select(
        "dataset", "id", status.alias("status")
    )


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_reject_reasons(_first_answers(spark, sf_dir)).select(
        "dataset", "id", F.array_join("reasons", ",").alias("reasons")
    )


def _both_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's last answer, parsed, and the attempt it came from; texts read once."""
    both = parse_annotations(_answers(_texts(spark, sf_dir), "dataset", "id"))
    second = parse_annotations(
        both.select("dataset", "id", F.col("annotation").alias("first"), F.col("again").alias("raw"))
    )
    return second.select(
        "dataset", "id", "raw",
        F.when(F.col("first").isNotNull(), 1).otherwise(2).alias("attempt"),
        F.coalesce("first", "annotation").alias("annotation"),
    )


def retry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = _both_attempts(spark, sf_dir).filter(F.col("annotation").isNotNull())
    return flat(merged.select("dataset", "id", "attempt", "annotation.*"))


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = _both_attempts(spark, sf_dir).filter(F.col("annotation").isNull())
    return with_reject_reasons(refused).select(
        "dataset", "id", "raw", F.array_join("reasons", ",").alias("reasons"),
        F.lit(2).alias("attempts"),
    )


# -- annotation runs --------------------------------------------------------------


def annotate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to records in one plan: bound, prompt, call once, validate."""
    ship_package(spark)
    slots = spark.sparkContext.defaultParallelism
    documents = spread(_documents(spark, sf_dir), slots, "part", "pos")
    return flat(records(first_attempt(documents, CHARS, PromptSizeModel(), SETTINGS)))


_FILES = f"files/model_slug={SETTINGS.model_slug}"


def _job(spark: SparkSession, purpose: str, off_label_every: int = 13) -> AnnotationJob:
    ship_package(spark)
    model = PromptSizeModel(flaky=True, off_label_every=off_label_every)
    settings = replace(SETTINGS, slots=spark.sparkContext.defaultParallelism)
    return AnnotationJob(spark, scratch_root(spark, purpose), settings, model)


def annotate_corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job with a model that fails at times; the written annotation table."""
    job = _job(spark, "annotate")
    job.run(_scan(spark, sf_dir))
    return flat(job.annotations())


def rejected_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reject table of the same job."""
    job = _job(spark, "rejects")
    job.run(_scan(spark, sf_dir))
    return job.rejects().select(
        "dataset", "id", F.array_join("reasons", ",").alias("reasons"), "attempts"
    )


def resumed_corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that finds the labelled documents answered and does only the others."""
    job = _job(spark, "resume")
    scan = _scan(spark, sf_dir)
    earlier = scan.documents().join(_labelled(spark, sf_dir), "id", "left_semi")
    job.call_documents(earlier)
    job.run(scan)
    return flat(job.annotations())


def incremental_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a stream of arriving files."""
    job = _job(spark, "incremental")
    scan = _scan(spark, sf_dir)
    IncrementalAnnotation(
        job, scan, f"{sf_dir}/documents*.parquet", _table(spark, sf_dir, "documents").schema,
        f"{job.root}/checkpoint",
    ).catch_up()
    return flat(job.annotations())


def published_corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest after publishing: only corpora without a refused document are whole."""
    job = _job(spark, "publish", off_label_every=251)
    scan = _scan(spark, sf_dir)
    job.run(scan)
    target = f"{job.root}/published"
    publish(spark, job.annotations(), job.states(scan), target, SETTINGS)
    return published_manifest(spark, target).drop("location")


def published_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows read back from where the manifest says they are."""
    job = _job(spark, "publish-rows", off_label_every=251)
    scan = _scan(spark, sf_dir)
    job.run(scan)
    target = f"{job.root}/published"
    publish(spark, job.annotations(), job.states(scan), target, SETTINGS)
    return flat(read_published(spark, target, job.id_type))


def changed_corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that were annotated, then edited (the toxic ones), and annotated again.

    A first model answers with other words than the second, so the table tells which rows
    were called for anew.
    """
    job = _job(spark, "changed")
    documents = _table(spark, sf_dir, "documents")
    marked = documents.join(
        _table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id", "toxic"),
        "doc_id", "left",
    )
    edited = F.when(F.col("toxic") == 1, F.concat("text", F.lit(" Edited."))).otherwise(
        F.col("text"))
    path = f"{job.root}/corpora/all.parquet"

    def write(text: Column) -> CorpusScan:
        columns = ["doc_id", "source", text.alias("text")]
        by_range(marked.select(*columns), "doc_id").write.mode("overwrite").parquet(path)
        return CorpusScan(spark, (path,), "doc_id", "text", F.col("source"))

    job.run(write(F.col("text")))
    first = job.annotations().select("id", F.col("one_sentence_description").alias("was"))
    before = written_rows(spark, first, f"{job.root}/before")
    job.run(write(edited))
    now = job.annotations().select("dataset", "id", "one_sentence_description")
    return now.join(before, "id", "left").select(
        "dataset", "id", "one_sentence_description",
        F.coalesce(F.col("was") != F.col("one_sentence_description"), F.lit(True)).alias("changed"),
    )


def refused_corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that were annotated, until those of one source lost their texts.

    What is left are the labels of the others, and a reject for each text that is missing.
    """
    job = _job(spark, "refused")
    documents = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    path = f"{job.root}/corpora/all.parquet"
    for text in (F.col("text"), F.when(F.col("source") != "src3", F.col("text"))):
        rows = documents.withColumn("text", text)
        by_range(rows, "doc_id").write.mode("overwrite").parquet(path)
        job.run(CorpusScan(spark, (path,), "doc_id", "text", F.col("source")))
    labelled = job.annotations().select(
        "dataset", "id", "one_sentence_description", F.lit(None).cast("string").alias("reason"))
    missing = job.rejects().filter(F.array_contains("reasons", "null_text")).select(
        "dataset", "id", F.lit(None).cast("string").alias("one_sentence_description"),
        F.array_join("reasons", ",").alias("reason"))
    return labelled.unionByName(missing)


def by_range(rows: DataFrame, key: str) -> DataFrame:
    """Rows in order of ``key`` over several partitions, equal keys in the same one."""
    slots = max(2, rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartitionByRange(slots, key).sortWithinPartitions(key)


def written_rows(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return spark.read.parquet(path)


class LengthAnnotator:
    """Stands in for an annotator of whole texts: it tells the length of what it got."""

    def annotate(self, text: str) -> dict:
        return {**CANONICAL_ANSWER, "one_sentence_description": f"{len(text)} characters"}


def annotator_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of an annotator that takes whole texts, taken as they are."""
    ship_package(spark)
    slots = spark.sparkContext.defaultParallelism
    documents = spread(_documents(spark, sf_dir), slots, "part", "pos")
    annotated = first_attempt(documents, CHARS, TextAnnotator(LengthAnnotator), SETTINGS)
    return records(annotated).select("dataset", "id", "one_sentence_description")


def route_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where corpora come from, when some are placeholders or missing.

    The texts of each source are written as a corpus: even sources with a ready file in the
    first place, odd ones with a pointer there and, but for ``src5``, a file in the second.
    """
    root = scratch_root(spark, "routing")
    texts = _texts(spark, sf_dir).select("dataset", "id", "text")
    number = F.regexp_extract("dataset", "([0-9]+)$", 1).cast("int")
    pointer = spark.range(1).select(F.concat(
        F.lit(f"{POINTER_FIRST_LINE}\n"), F.repeat(F.lit("more "), 400)).alias("value"))
    named = sorted(r.dataset for r in list_corpora(spark, sf_dir).collect())
    even = [n for n in named if int(n[3:]) % 2 == 0]
    for place, rows in (("local", number % 2 == 0), ("spare", number % 2 == 1)):
        texts.filter(rows & (F.col("dataset") != "src5")).write.partitionBy("dataset").parquet(
            f"{root}/{place}")
    pointer.coalesce(1).write.text(f"{root}/pointers")
    folder = F.regexp_extract("path", "/dataset=([^/]+)/", 1)
    local = corpora.corpus_files(spark, f"{root}/local", folder)
    spare = corpora.corpus_files(spark, f"{root}/spare", folder)
    held = corpora.corpus_files(spark, f"{root}/pointers", F.lit("held"), "*.txt")
    odd = F.array(*[F.lit(name) for name in named if name not in even])
    placeholders = held.select(F.explode(odd).alias("dataset"), "path", "length", "pointer")
    routed = corpora.route_files(local.unionByName(placeholders), spare)
    return routed.select("dataset", "source").distinct()


# -- resume, counts and plans -----------------------------------------------------


def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left to do when finished rows are known by id."""
    return resume.pending_ids(
        _documents(spark, sf_dir), _finished(spark, sf_dir)
    ).select("dataset", "id")


def resume_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left to do when finished rows are known by file, position and content."""
    documents = _documents(spark, sf_dir).withColumn(
        "digest", resume.row_digest(F.col("id"), F.col("text"))
    )
    done = documents.join(_labelled(spark, sf_dir), "id", "left_semi")
    return resume.pending_rows(documents, done).select("dataset", "id")


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir).select("dataset", "id", "part", "pos")
    return positions.with_rank(rows, ["dataset"])


def _progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _texts(spark, sf_dir)
        .join(
            _labelled(spark, sf_dir).select("id", F.lit(1).alias("done")), "id", "left"
        )
        .groupBy("dataset")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count("done").alias("n_done"))
    )


def resume_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left to do when each corpus is known to have as many first rows done as labels."""
    return positions.after_prefix(
        _ranked(spark, sf_dir), _progress(spark, sf_dir)
    ).select("dataset", "id", "rank")


def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.batch_plan(
        _ranked(spark, sf_dir), _progress(spark, sf_dir), SETTINGS
    ).select("dataset", "id", "rank", "batch_id")


def _part_files(spark: SparkSession, sf_dir: str, purpose: str) -> str:
    """Part files of an interrupted run, one of them past a gap."""
    root = scratch_root(spark, purpose)
    answers = parse_annotations(_first_answers(spark, sf_dir)).filter("annotation IS NOT NULL")
    parts = answers.select("id", "annotation.*")
    for number, name in enumerate(("tmp", "part1", "part2", "part4")):
        by_range(parts.filter(F.col("id") % 4 == number), "id").write.parquet(
            f"{root}/all/{SETTINGS.model_slug}.{name}.parquet")
    return root


def partial_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part files of an interrupted run, read back in order: the place as a column."""
    root = _part_files(spark, sf_dir, "parts")
    listed = partial_outputs(spark, root).select("path").collect()
    ranked = positions.with_rank(read_parts(spark, [r.path for r in listed]), ["dataset"])
    return ranked.select(
        "dataset", "rank", "id", F.col("annotation.one_sentence_description").alias("description"))


def packed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same part files merged into files of 64 rows: each row's file, and its place by the
    files' names."""
    root = _part_files(spark, sf_dir, "packed")
    merge_part_files(spark, root, SETTINGS.model_slug, f"{root}-merged", rows_per_file=64)
    written = spark.read.parquet(f"{root}-merged").select(
        "dataset", "id", F.col("_metadata.file_name").alias("part"),
        F.col("_metadata.row_index").alias("pos"))
    number = F.regexp_extract("part", "part-([0-9]+)", 1).cast("long")
    return positions.with_rank(written, ["dataset"]).select(
        "dataset", "id", "rank", number.alias("file"))


def merged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two disjoint parts, labelled and unlabelled documents, as one output."""
    documents = _texts(spark, sf_dir).select(
        "dataset", "id", F.concat(F.lit("Size "), F.length("text")).alias("description")
    )
    labelled = _labelled(spark, sf_dir)
    return merge_parts(
        documents.join(labelled, "id", "left_semi").select("dataset", "id", "description"),
        documents.join(labelled, "id", "left_anti").select("id", "description", "dataset"),
    )


def skip_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpora whose output is not published; those with three good labels in four are."""
    path = paths.annotation_path(F.col("dataset"), F.lit(SETTINGS.model_name))
    published = (
        _texts(spark, sf_dir).select("dataset", "id")
        .join(_labelled(spark, sf_dir), "id")
        .groupBy("dataset")
        .agg(F.sum("quality").alias("good"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("good") * 4 > F.col("n") * 3)
        .select(path.alias("path"))
    )
    named = list_corpora(spark, sf_dir).withColumn("path", path)
    return resume.skip_published(named, published).select("dataset", "path")


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpora by language and label, annotated to different degrees.

    Good ones are whole, poor ones have only their long documents done, toxic ones were
    done twice, and unlabelled ones not at all.
    """
    kind = (
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good")
        .when(F.col("quality") == 0, "poor").otherwise("open")
    )
    times = (
        F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 1)
        .when((F.col("quality") == 0) & (F.col("size") >= 1_000), 1).otherwise(0)
    )
    counted = (
        _table(spark, sf_dir, "documents")
        .select(F.col("doc_id").alias("id"), "lang", F.length("text").alias("size"))
        .join(_labelled(spark, sf_dir), "id", "left")
        .groupBy(F.concat_ws("-", "lang", kind).alias("dataset"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(times).alias("n_done"))
    )
    return resume.with_state(counted)


def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir)


def publishable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.publishable(_states(spark, sf_dir)).select("dataset", "expected_rows")


def overcomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.over_complete(_states(spark, sf_dir)).select(
        "dataset", "expected_rows", "actual_rows"
    )


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers whose document has changed since: toxic documents were edited."""
    documents = _documents(spark, sf_dir)
    done = documents.withColumn("digest", resume.row_digest(F.col("id"), F.col("text")))
    edited = documents.join(
        _labelled(spark, sf_dir).filter(F.col("toxic") == 1).select("id", "toxic"), "id", "left"
    ).withColumn(
        "text", F.when(F.col("toxic") == 1, F.concat("text", F.lit("."))).otherwise(F.col("text"))
    )
    now = edited.withColumn("digest", resume.row_digest(F.col("id"), F.col("text")))
    return resume.orphans(done, now).select("dataset", "id")


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.progress(parse_annotations(_first_answers(spark, sf_dir)))


# -- taxonomy and length bands ----------------------------------------------------


def taxonomy_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each of the 131 labels was given."""
    parsed = parse_annotations(_first_answers(spark, sf_dir)).filter(
        F.col("annotation").isNotNull()
    )
    labels = taxonomy(spark)
    fields = F.array(
        *[
            F.struct(
                F.lit(name).alias("field"),
                (
                    F.col(f"annotation.{name}")
                    if name in LIST_FIELDS
                    else F.array(F.col(f"annotation.{name}"))
                ).alias("given"),
            )
            for name in FIELD_NAMES
            if name not in ("one_sentence_description", "country_relevance")
        ]
    )
    given = (
        parsed.select(F.explode(fields).alias("f"))
        .select("f.field", F.explode("f.given").alias("value"))
        .groupBy("field", "value")
        .agg(F.count(F.lit(1)).alias("n_given"))
    )
    return labels.join(given, ["field", "value"], "left").select(
        "field", "kind", "ordinal", "value", F.coalesce("n_given", F.lit(0)).alias("n_given")
    )


def length_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select(
        "dataset", "id", length_band(F.col("text")).alias("band")
    )


def length_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answered length band against the text's own."""
    banded = _texts(spark, sf_dir).withColumn("computed", length_band(F.col("text")))
    parsed = parse_annotations(_answers(banded, "computed"))
    answered_band = F.col("annotation.content_length").alias("answered")
    return (
        parsed.filter(F.col("annotation").isNotNull())
        .groupBy(answered_band, "computed")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        scan_documents, select_corpus, scan_corpora, list_corpora, corpus_manifest,
        part_counts, output_paths, truncate_content, build_prompts, prompt_tokens,
        prompt_tokens_counted, fits_context, token_bounded, token_bounded_capped,
        token_bounded_tight, token_bounded_counted, retry_budget, parsed_responses,
        alias_field, response_states, reject_reasons, retry_merge, rejects,
        annotate_documents, annotate_corpora, rejected_documents, resumed_corpora,
        incremental_annotate, published_corpora, published_rows, changed_corpora,
        refused_corpora,
        annotator_records, route_sources, partial_records, resume_pending, resume_rows,
        resume_by_position, batch_plan, merged_parts, packed_parts, skip_published, completeness,
        publishable, overcomplete, orphans, progress, taxonomy_usage, length_bands,
        length_consistency,
    )
}
