"""Annotating corpora: a resumable job over parquet tables.

Four tables live below one root (and ``calls``, answers that no table has yet):

* ``responses``    every model answer, appended per attempt, with its row key, by bucket;
* ``files``        every version of a file that a run has seen, the last one being current;
* ``annotations``  ``dataset, id, 18 labels``, partitioned by model, corpus and bucket;
* ``derived``      what of the answers the annotations of a corpus and bucket were made from.

A bucket is ``parts_per_commit`` files, numbered as they were first seen and by name among
those seen together. It is the granule of all later work: a commit calls for the files of one
bucket and writes to the bucket's own folder, a file that arrives or changes has only its
bucket's answers read and its bucket's annotations rewritten. The last bucket is filled up
first, so that files arriving one by one do not leave a folder each.

Answers belong to a version of their file. When a file changes, answers of rows whose
content is still in it are carried over to the new version, all other rows are called for,
and answers whose content is gone are orphans: they are neither counted nor published.

The answers are the only state. Each step works on what they still lack, so a run that dies
anywhere, even halfway through a commit, is continued by running it again. A call that goes
wrong leaves its row open and takes no other row's answer with it; the run writes all it
got and raises at its end. Errors are kept, one per row and run: a row whose call failed in
``call_tries`` runs is given up and becomes a reject (``call_failed``), so that one document
cannot hold up the others for ever; when its file changes it is tried anew. Rows that no
attempt could annotate stay as rejects, with raw text and reasons.

No text is shuffled on a fresh run. Prompts, calls and validation follow the scan, retry
rows carry their text with them, and files are matched with earlier work by file, not by
row; only files that changed or were left half done are joined row by row.
"""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cached_property
from itertools import count

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions.validation import with_reject_reasons
from labelloom.operators import resume
from labelloom.operators.call_log import CallLog
from labelloom.operators.live import LiveProgress
from labelloom.operators.model_call import ClientFactory, TextAnnotator, spread
from labelloom.operators.resume import (
    completeness,
    folder_of,
    over_complete,
    pending_rows,
    progress,
    row_digest,
)
from labelloom.operators.token_budget import CharCounter, Counter
from labelloom.plans.attempts import (
    ACCEPTED,
    ERROR,
    REFUSED,
    RETRY,
    first_attempt,
    second_attempt,
)
from labelloom.settings import Settings
from labelloom.sources.corpora import CorpusScan, corpus_counts, file_versions
from labelloom.sources.files import delete_folder, full_address
from labelloom.sources.tables import ensure_table
from labelloom.taxonomy import ANNOTATION_TYPE


class OverComplete(ValueError):
    """More answers than documents for the same version of a file."""


class RefusedDocuments(ValueError):
    """Some documents could not be annotated; they are among the rejects."""


class FailedCalls(RuntimeError):
    """Some calls brought no answer; what others brought is kept. Run again."""


FILES_TYPE = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("stamp", T.LongType()),
    ]
)
DERIVED_TYPE = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("mark", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("stamp", T.LongType()),
    ]
)


def _responses_type(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("dataset", T.StringType()),
            T.StructField("id", id_type),
            T.StructField("text", T.StringType()),
            T.StructField("part", T.StringType()),
            T.StructField("version", T.LongType()),
            T.StructField("pos", T.LongType()),
            T.StructField("digest", T.LongType()),
            T.StructField("char_limit", T.IntegerType()),
            T.StructField("prompt_tokens", T.IntegerType()),
            T.StructField("over_budget", T.BooleanType()),
            T.StructField("raw", T.StringType()),
            T.StructField("error", T.StringType()),
            T.StructField("annotation", ANNOTATION_TYPE),
            T.StructField("outcome", T.StringType()),
            T.StructField("bucket", T.LongType()),
        ]
    )


def annotations_type(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("id", id_type),
            *ANNOTATION_TYPE.fields,
            T.StructField("dataset", T.StringType()),
            T.StructField("bucket", T.LongType()),
        ]
    )


def annotations_path(root: str, settings: Settings) -> str:
    return f"{root}/annotations/model_slug={settings.model_slug}"


def replace_corpora(table: DataFrame, path: str, *keys: str) -> None:
    """Overwrite exactly the corpora present in ``table``, or what of them ``keys`` name."""
    (
        table.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset", *keys)
        .parquet(path)
    )


def _now() -> int:
    return time.time_ns()


def _of_buckets(table: DataFrame, buckets: Iterable[int] | None) -> DataFrame:
    return table if buckets is None else table.filter(F.col("bucket").isin(list(buckets)))


@dataclass
class AnnotationJob:
    spark: SparkSession
    root: str
    settings: Settings
    client_factory: ClientFactory | TextAnnotator
    counter: Counter = field(default_factory=CharCounter)
    id_type: T.DataType = field(default_factory=T.LongType)
    live: LiveProgress | None = None  # told of every commit

    # -- tables -----------------------------------------------------------------

    @property
    def annotations_path(self) -> str:
        return annotations_path(self.root, self.settings)

    @cached_property
    def _address(self) -> str:
        return full_address(self.spark, self.root, self._tables["files"][0])

    def call_log(self, attempt: int) -> CallLog | None:
        """Answers not yet in the response table; the place is one that tasks can write to."""
        if not self.settings.log_answers:
            return None
        slug = self.settings.model_slug
        return CallLog(
            f"{self._address}/calls/model_slug={slug}/attempt={attempt}",
            self.settings.batch_rows,
        )

    def _forget_calls(self, attempt: int, parts: list[str] | None = None) -> None:
        log = self.call_log(attempt)
        if log:
            log.forget(parts)

    def _attempt_path(self, attempt: int) -> str:
        return f"{self.root}/responses/model_slug={self.settings.model_slug}/attempt={attempt}"

    @cached_property
    def _tables(self) -> dict[str, tuple[str, T.StructType]]:
        """Paths and schemas; the tables are made once for each job."""
        responses = _responses_type(self.id_type)
        slug = f"model_slug={self.settings.model_slug}"
        tables = {
            "1": (self._attempt_path(1), responses),
            "2": (self._attempt_path(2), responses),
            "annotations": (self.annotations_path, annotations_type(self.id_type)),
            "files": (f"{self.root}/files/{slug}", FILES_TYPE),
            "derived": (f"{self.root}/derived/{slug}", DERIVED_TYPE),
        }
        for name, (path, schema) in tables.items():
            keys = {"annotations": ["dataset", "bucket"], "1": ["bucket"], "2": ["bucket"]}
            ensure_table(self.spark, path, schema, keys.get(name, []))
        return tables

    def _table(self, name: str) -> DataFrame:
        path, schema = self._tables[name]
        return self.spark.read.schema(schema).parquet(path)

    def responses(self, attempt: int) -> DataFrame:
        return self._table(str(attempt))

    def annotations(self) -> DataFrame:
        return self._table("annotations").drop("bucket")

    def files(self) -> DataFrame:
        """``(part, version, bucket)`` of the current version of every file seen."""
        last = F.max_by(F.struct("version", "bucket"), "stamp").alias("last")
        return self._table("files").groupBy("part").agg(last).select("part", "last.*")

    def buckets_of(self, listed: DataFrame) -> list[int]:
        own = self._table("files").join(listed, "part", "left_semi")
        return sorted(row.bucket for row in own.select("bucket").distinct().collect())

    def _stored(self, attempt: int, buckets: Iterable[int] | None) -> DataFrame:
        """Responses, or those of some buckets: no file of another one is opened."""
        return _of_buckets(self.responses(attempt), buckets)

    def _known(self, attempt: int, buckets: Iterable[int] | None = None) -> DataFrame:
        return self._stored(attempt, buckets).filter(F.col("outcome") != ERROR)

    def _answers(self, attempt: int, buckets: Iterable[int] | None = None) -> DataFrame:
        """Answers to the current versions of files."""
        current = _of_buckets(self.files(), buckets).select("part", "version")
        return self._known(attempt, buckets).join(current, ["part", "version"], "left_semi")

    def outcomes(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The last outcome of every answered row, with the attempts it took."""
        first = self._answers(1, buckets).filter(F.col("outcome") != RETRY)
        called = F.col("raw").isNotNull() | F.col("error").isNotNull()
        return first.withColumn(
            "attempts", F.when(called, 1).otherwise(0)
        ).unionByName(self._answers(2, buckets).withColumn("attempts", F.lit(2)))

    def rejects(self) -> DataFrame:
        """``dataset, id, raw, reasons, attempts`` of the rows no attempt could annotate."""
        refused = with_reject_reasons(self.outcomes().filter(F.col("outcome") == REFUSED))
        reasons = (
            F.when(F.col("error").isNotNull(), F.array(F.lit("call_failed")))
            .when(F.col("attempts") == 0, F.array(F.lit("null_text")))
            .otherwise(F.col("reasons"))
        )
        return refused.select("dataset", "id", "raw", reasons.alias("reasons"), "attempts")

    def orphans(self) -> DataFrame:
        """Answers to earlier versions of files whose content the current ones lack."""
        old = self._known(1).join(
            self.files().select("part", "version"), ["part", "version"], "left_anti"
        )
        gone = resume.orphans(old, self._answers(1))
        return gone.dropDuplicates(["dataset", "id", "digest"])

    # -- steps ------------------------------------------------------------------

    def run(self, scan: CorpusScan) -> None:
        """Annotate what is left of the scanned corpora and bring all tables up to date."""
        self.forget_lost_files(scan)
        self.call_open_parts(scan)
        self.call_retries()
        self.derive_tables(self.stale())
        self.settle_failures()
        if self.settings.on_invalid == "fail":
            refused = self.outcomes().filter(F.col("outcome") == REFUSED)
            if not refused.isEmpty():
                raise RefusedDocuments("some documents were refused; see rejects()")

    def settle_failures(self, buckets: Iterable[int] | None = None) -> None:
        """Give up rows that failed ``call_tries`` times; raise if others are still open.

        Only errors of the current versions that were not made up for count. They are few:
        what is grouped is one row per failed call.
        """
        current = _of_buckets(self.files(), buckets).select("part", "version")
        key = ["part", "version", "pos"]
        others = [c for c in _responses_type(self.id_type).fieldNames() if c not in key]
        given_up = F.col("_tries") >= self.settings.call_tries
        open_rows = []
        for attempt in (1, 2):
            failed = (
                self._stored(attempt, buckets).filter(F.col("outcome") == ERROR)
                .join(current, ["part", "version"], "left_semi")
                .groupBy(*key).agg(
                    F.count(F.lit(1)).alias("_tries"),
                    F.max_by(F.struct(*others), "error").alias("_last"))
                .join(self._answers(attempt, buckets).select(*key), key, "left_anti")
                .select(*key, "_last.*", "_tries")
            )
            found = failed.agg(
                F.count_if(given_up).alias("n"),
                F.min_by(F.struct("dataset", "id", "error"), F.when(~given_up, F.col("pos")))
                .alias("row"),
            ).first()
            open_rows += [found.row] if found.row else []
            if found.n:
                self._append(
                    failed.filter(given_up).withColumn("outcome", F.lit(REFUSED)), attempt)
        for row in open_rows:
            raise FailedCalls(f"{row.dataset}, id {row.id}: {row.error}")

    def forget_lost_files(self, scan: CorpusScan) -> None:
        """Files seen earlier in the scanned folders that are not there any more.

        Their answers count no longer, but rows of the same content in other files of the
        folder take them over.
        """
        listed = file_versions(scan.documents()).select("part")
        folders = listed.select(folder_of(F.col("part")).alias("folder")).distinct()
        missed = self.files().filter("version <> 0").join(listed, "part", "left_anti")
        missed = missed.withColumn("folder", folder_of(F.col("part"))).join(
            folders, "folder", "left_semi"
        )
        places = [r.folder for r in missed.select("folder").distinct().collect()]
        if not places:
            return
        there = self.spark.read.format("binaryFile").load(places).select(
            F.col("path").alias("part"))
        lost = missed.join(there, "part", "left_anti").select(
            "part", F.lit(0).cast("long").alias("version"), "bucket")
        self._append_rows("files", lost.withColumn("stamp", F.lit(_now())))

    def enroll(self, listed: DataFrame) -> None:
        """Note new versions of files; files not seen before get a place in a bucket.

        New files are files to be read, whose paths the driver needs anyway.
        """
        size = self.settings.parts_per_commit
        homes = self._table("files").groupBy("part").agg(F.max("bucket").alias("bucket"))
        news = (
            listed.join(self.files(), ["part", "version"], "left_anti")
            .join(homes, "part", "left").select("part", "version", "bucket").collect()
        )
        if not news:
            return
        last = homes.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).agg(
            F.max(F.struct("bucket", "n")).alias("last")).first().last
        places = count(last.bucket * size + min(last.n, size) if last else 0)
        fresh = sorted({row.part for row in news if row.bucket is None})
        bucket = {part: place // size for part, place in zip(fresh, places)}
        now = _now()
        rows = [(r.part, r.version, bucket.get(r.part, r.bucket), now) for r in news]
        noted = self.spark.createDataFrame(rows, FILES_TYPE)
        self._append_rows("files", noted.coalesce(len(rows) // 100_000 + 1))

    def open_parts(
        self, scan: CorpusScan, own: Sequence[int] | None = None
    ) -> tuple[dict[int, list[str]], dict[int, list[str]]]:
        """Files with unanswered rows, by bucket: ones never seen, and changed or half done.

        Rows by file version from the footers meet answers by file version from narrow
        columns, one row per file each. Only open files reach the driver, as the reader
        takes their paths; a finished collection sends nothing. If all files of the scan are
        in the buckets ``own``, having been enrolled, only answers of these are read.
        """
        listed = file_versions(scan.documents())
        if own is None:
            self.enroll(listed)
        files = self.files()
        done = file_versions(self._known(1, own)).withColumnRenamed("n_rows", "n_done")
        seen = done.groupBy("part").agg(F.lit(True).alias("known"))
        lost = files.filter("version = 0").select(
            folder_of(F.col("part")).alias("folder")).distinct().withColumn("moved", F.lit(True))
        states = (
            listed.join(files.select("part", "bucket"), "part")
            .join(done, ["part", "version"], "left").join(seen, "part", "left")
            .withColumn("folder", folder_of(F.col("part"))).join(lost, "folder", "left")
            .withColumn("seen", F.coalesce("known", "moved"))
            .withColumn("n_done", F.coalesce("n_done", F.lit(0)))
            .filter("n_done != n_rows OR known IS NULL")
        )
        rows = states.select("part", "bucket", "n_rows", "n_done", "seen").collect()
        excess = sorted(r.part for r in rows if r.n_done > r.n_rows)
        if excess:
            raise OverComplete(f"more answers than rows for {excess[:3]}")
        untouched, touched = defaultdict(list), defaultdict(list)
        for row in sorted(rows, key=lambda r: r.part):
            if row.seen:
                touched[row.bucket].append(row.part)
            elif row.n_rows:
                untouched[row.bucket].append(row.part)
        return untouched, touched

    def call_open_parts(self, scan: CorpusScan, arrived: bool = False) -> list[int] | None:
        """First attempt for all rows without an answer, a bucket at a time.

        With ``arrived`` only the buckets of the scanned files are looked at; they are returned.

        Commits that run side by side write to different folders, so that none clears away
        what another has not yet moved to its place.
        """
        own = None
        if arrived:
            listed = file_versions(scan.documents())
            self.enroll(listed)
            own = self.buckets_of(listed)
        untouched, touched = self.open_parts(scan, own)
        if touched:
            self.carry_over(scan.only(sorted(sum(touched.values(), []))))

        def commit(bucket: int) -> None:
            for paths, known in ((untouched.get(bucket), False), (touched.get(bucket), True)):
                if paths:
                    self._call(scan.only(paths), bucket, known)

        buckets = sorted({*untouched, *touched})
        with ThreadPoolExecutor(self.settings.commits_at_once) as pool:
            for done in [pool.submit(commit, bucket) for bucket in buckets]:
                done.result()
        if buckets:
            self._forget_calls(1)
        return own

    def _call(self, scan: CorpusScan, bucket: int, known: bool) -> None:
        documents = spread(scan.documents(), self.settings.slots, "part", "pos")
        outcomes = self._first(documents, self._known(1, [bucket]) if known else None)
        _, schema = self._tables["1"]
        outcomes = outcomes.select(*[c for c in schema.fieldNames() if c != "bucket"])
        with self._observed(outcomes, 1, scan) as outcomes:
            outcomes.write.mode("append").parquet(f"{self._attempt_path(1)}/bucket={bucket}")
        self._forget_calls(1, list(scan.paths))

    def _with_bucket(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.files().select("part", "bucket"), "part")

    def carry_over(self, scan: CorpusScan) -> None:
        """Give rows of changed files the answers that their content had last."""
        rows = scan.documents().select(
            "part", "version", "pos", row_digest(F.col("id"), F.col("text")).alias("digest"),
            folder_of(F.col("part")).alias("folder"),
        )
        columns = _responses_type(self.id_type).fieldNames()
        content = ["folder", "digest"]
        files = self._table("files").withColumn("folder", folder_of(F.col("part")))
        stamps = files.groupBy("part", "version").agg(F.max("stamp").alias("stamp"))
        own = file_versions(scan.documents()).select(folder_of(F.col("part")).alias("folder"))
        near = files.join(own, "folder", "left_semi").select("bucket").distinct().collect()
        buckets = [row.bucket for row in near]
        kept = [c for c in columns if c not in ("part", "version", "pos", "digest", "bucket")]
        for attempt in (1, 2):
            answers = self._known(attempt, buckets)
            if attempt == 2:  # only rows that their first answer left to retry
                rows = rows.join(
                    self._answers(1, buckets).filter(F.col("outcome") == RETRY)
                    .select("part", "version", "pos"),
                    ["part", "version", "pos"], "left_semi",
                )
            earlier = (
                answers.filter("error IS NULL").withColumn("folder", folder_of(F.col("part")))
                .join(stamps, ["part", "version"], "left").groupBy(*content)
                .agg(F.max_by(F.struct(*kept), F.struct("stamp", "part", "pos")).alias("had"))
            )
            carried = pending_rows(rows, answers).join(earlier, content).select(
                "part", "digest", "version", "pos", "had.*"
            )
            self._append(self._with_bucket(carried), attempt)

    def call_documents(self, documents: DataFrame, earlier: DataFrame | None = None) -> None:
        """First attempt for the documents that have no answer in ``earlier``."""
        self.enroll(file_versions(documents))
        self._append(self._with_bucket(self._first(documents, earlier)), 1)

    def _first(self, documents: DataFrame, earlier: DataFrame | None) -> DataFrame:
        documents = documents.withColumn("digest", row_digest(F.col("id"), F.col("text")))
        if earlier is not None:
            documents = pending_rows(documents, earlier)
        return first_attempt(
            documents, self.counter, self.client_factory, self.settings, self.call_log(1))

    def call_retries(self, buckets: Iterable[int] | None = None) -> None:
        """Second attempt for all rows the first one left, also by earlier runs."""
        if isinstance(self.client_factory, TextAnnotator):
            return
        retries = self._answers(1, buckets).filter(F.col("outcome") == RETRY)
        retries = pending_rows(retries, self._known(2, buckets))
        self._append(
            second_attempt(
                spread(retries, self.settings.slots, "part", "pos"),
                self.counter, self.client_factory, self.settings, self.call_log(2),
            ),
            2,
        )
        self._forget_calls(2)

    def _append(self, outcomes: DataFrame, attempt: int) -> None:
        path, schema = self._tables[str(attempt)]
        with self._observed(outcomes.select(*schema.fieldNames()), attempt) as outcomes:
            outcomes.write.mode("append").partitionBy("bucket").parquet(path)

    @contextmanager
    def _observed(
        self, outcomes: DataFrame, attempt: int, scan: CorpusScan | None = None
    ) -> Iterator[DataFrame]:
        """Outcomes that are counted while they are written, if somebody asked for it."""
        if self.live is None:
            yield outcomes
            return
        names = self.live.corpora() if scan is None else scan.names()
        kinds = (ACCEPTED, REFUSED, RETRY, ERROR)
        outcomes, written = self.live.observed(outcomes, attempt, names, kinds)
        yield outcomes
        written()

    def _append_rows(self, name: str, rows: DataFrame) -> None:
        path, schema = self._tables[name]
        rows.select(*schema.fieldNames()).write.mode("append").parquet(path)

    def adopt(self, ranked_records: DataFrame, ranked_documents: DataFrame) -> None:
        """Take over records of an earlier run that are known by position only.

        Both inputs have ``dataset, rank, id``; a record counts for the document at its
        place if the ids agree, else the corpus has changed and the record is an orphan.
        """
        self.enroll(file_versions(ranked_documents))
        there = ranked_records.select(
            "dataset", "rank", F.col("id").alias("_id"), "annotation"
        )
        joined = ranked_documents.join(there, ["dataset", "rank"])
        answered = self._known(1)
        rows = joined.filter(F.col("id").eqNullSafe(F.col("_id"))).select(
            "dataset", "id", F.lit(None).cast("string").alias("text"), "part", "version", "pos",
            row_digest(F.col("id"), F.col("text")).alias("digest"),
            *[
                F.lit(None).cast(kind).alias(name)
                for name, kind in (
                    ("char_limit", "int"), ("prompt_tokens", "int"), ("over_budget", "boolean"),
                    ("error", "string"),
                )
            ],
            F.to_json("annotation").alias("raw"), "annotation",
            F.lit(ACCEPTED).alias("outcome"),
        )
        self._append(self._with_bucket(pending_rows(rows, answered)), 1)

    def _marks(self, buckets: Iterable[int] | None) -> DataFrame:
        """Per corpus and bucket: how many rows are accepted, and a fingerprint of which."""
        accepted = self.outcomes(buckets).filter(F.col("outcome") == ACCEPTED)
        return accepted.groupBy("dataset", "bucket").agg(
            F.bit_xor(F.xxhash64("part", "version", "pos", "attempts")).alias("mark"),
            F.count(F.lit(1)).alias("n_rows"),
        )

    def stale(self, buckets: Iterable[int] | None = None) -> list[Row]:
        """``(dataset, bucket, mark, n_rows)`` whose annotations lack what is accepted now.

        Aggregates of narrow columns, one row per corpus and bucket; those that differ go to
        the driver.
        """
        made = _of_buckets(self._table("derived"), buckets).groupBy("dataset", "bucket").agg(
            F.max_by(F.struct("mark", "n_rows"), "stamp").alias("made")
        ).select("dataset", "bucket", F.col("made.mark").alias("was"),
                 F.col("made.n_rows").alias("had"))
        stale = self._marks(buckets).join(made, ["dataset", "bucket"], "full").select(
            "dataset", "bucket", F.coalesce("mark", F.lit(0)).alias("mark"),
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "was",
            F.coalesce("had", F.lit(0)).alias("had"),
        ).filter("n_rows <> had OR (n_rows > 0 AND mark <> was)")
        return stale.select("dataset", "bucket", "mark", "n_rows").collect()

    def stale_corpora(self) -> list[str]:
        return sorted({row.dataset for row in self.stale()})

    def derive_tables(self, stale: Iterable[Row]) -> None:
        """Rewrite the annotations of the buckets of ``stale`` from the current answers."""
        stale = list(stale)
        if not stale:
            return
        buckets = sorted({row.bucket for row in stale})
        # Well-sized files per corpus: a large one is split, small ones are packed. Rows
        # keep the order of their input, which also is the order the writer asks for.
        in_order = (
            self.outcomes(buckets).filter(F.col("outcome") == ACCEPTED)
            .select("dataset", "bucket", "part", "pos", "id", "annotation")
            .hint("rebalance", "dataset", "bucket")
            .sortWithinPartitions("dataset", "bucket", "part", "pos")
        )
        replace_corpora(
            in_order.select("dataset", "bucket", "id", "annotation.*"),
            self.annotations_path, "bucket")
        gone = [row for row in stale if not row.n_rows]
        if gone:
            self._drop_annotations(gone)
        now = _now()
        marks = self.spark.createDataFrame(
            [(row.dataset, row.bucket, row.mark, row.n_rows, now) for row in stale], DERIVED_TYPE)
        self._append_rows("derived", marks.coalesce(len(stale) // 100_000 + 1))

    def _drop_annotations(self, gone: list[Row]) -> None:
        """Buckets without an accepted row lose their files, as nothing replaces them."""
        pairs = self.spark.createDataFrame(
            [(row.dataset, row.bucket) for row in gone], "dataset string, bucket long")
        file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        folder = F.regexp_extract(file, "^(.*)/[^/]*$", 1)
        old = self._table("annotations").select("dataset", "bucket", folder.alias("folder"))
        old = old.distinct().join(pairs, ["dataset", "bucket"], "left_semi")
        for row in old.collect():
            delete_folder(row.folder)

    # -- checks -----------------------------------------------------------------

    def states(self, scan: CorpusScan) -> DataFrame:
        """Completeness of each scanned corpus, by answers to the files as they are now.

        Raises when one is over-complete. With ``publish_refused``, refused rows count as
        done: they are delivered as rejects.
        """
        listed = file_versions(scan.documents()).select("part", "version")
        counted = self.outcomes().join(listed, ["part", "version"], "left_semi")
        if not self.settings.publish_refused:
            counted = counted.filter(F.col("outcome") == ACCEPTED)
        states = completeness(scan.counts(), corpus_counts(counted))
        excess = over_complete(states).limit(1).collect()
        if excess:
            raise OverComplete(f"more annotations than rows for {excess[0].dataset}")
        return states

    def progress(self) -> DataFrame:
        return progress(self.outcomes())
