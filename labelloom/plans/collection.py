"""Whole-collection runs: find corpora, skip published ones, annotate, publish."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.operators.live import LiveProgress
from labelloom.operators.model_call import ClientFactory, TextAnnotator
from labelloom.operators.positions import with_rank
from labelloom.operators.resume import skip_published
from labelloom.operators.token_budget import CharCounter, Counter
from labelloom.plans.annotate import AnnotationJob
from labelloom.plans.publish import output_path, publish, published_paths
from labelloom.settings import Settings
from labelloom.sources.corpora import (
    CorpusScan,
    corpus_files,
    list_corpora,
    require_available,
    route_files,
)
from labelloom.sources.parts import partial_outputs, read_parts


@dataclass
class Collection:
    """Corpora under ``root`` (``<name>/<name>.parquet``), with an optional fallback.

    ``out`` holds the job's tables, in a folder for each type of ids, and ``target`` the
    published annotations.
    """

    spark: SparkSession
    root: str
    out: str
    target: str
    settings: Settings
    client_factory: ClientFactory | TextAnnotator
    fallback_root: str | None = None
    counter: Counter = field(default_factory=CharCounter)
    live: LiveProgress | None = None

    def files(self, dataset: str | None = None) -> DataFrame:
        """Files to scan ``(dataset, path)`` of all corpora, or of one; all must be there."""
        local = corpus_files(self.spark, self.root)
        fallback = (
            corpus_files(self.spark, self.fallback_root)
            if self.fallback_root
            else local.limit(0)
        )
        routed = route_files(local, fallback)
        if dataset is not None:
            routed = routed.filter(F.col("dataset") == dataset)
        else:
            routed = routed.join(list_corpora(routed), "dataset", "left_semi")
        listed = local.unionByName(fallback)
        return require_available(routed, dataset, listed).select("dataset", "path")

    def scans(self, files: DataFrame) -> dict[str, CorpusScan]:
        """A scan for each type of ids, over all given files.

        Spark's reader takes paths, so those of the files to read come to the driver.
        """
        paths = sorted(row.path for row in files.select("path").collect())
        return CorpusScan(self.spark, tuple(paths)).by_id_type() if paths else {}

    def job(self, kind: str, scan: CorpusScan) -> AnnotationJob:
        return AnnotationJob(
            self.spark, f"{self.out}/ids-{kind}", self.settings, self.client_factory,
            self.counter, scan.id_type, self.live,
        )

    def annotate(self, dataset: str | None = None) -> list[str]:
        """Annotate every corpus not yet published, then publish the complete ones."""
        files = self.files(dataset)
        corpora = files.select("dataset").distinct().withColumn(
            "path", output_path(self.settings)
        )
        open_corpora = skip_published(corpora, published_paths(self.spark, self.target))
        wanted = files.join(open_corpora.select("dataset"), "dataset", "left_semi")
        published = []
        for kind, scan in self.scans(wanted).items():
            job = self.job(kind, scan)
            job.run(scan)
            published += self._publish(job, scan)
        return sorted(published)

    def publish_existing(self, dataset: str | None = None) -> list[str]:
        """Publish annotations that are already complete, without annotating any."""
        published = []
        for kind, scan in self.scans(self.files(dataset)).items():
            job = self.job(kind, scan)
            job.derive_tables(job.stale())
            published += self._publish(job, scan)
        return sorted(published)

    def adopt_parts(self, parts_root: str) -> None:
        """Take over what interrupted runs of another writer left as part files.

        Parts are put together in order, up to the first one that is missing; a record
        counts for the document at its place if their ids agree.
        """
        slug = self.settings.model_slug
        listed = partial_outputs(self.spark, parts_root).filter(F.col("model_slug") == slug)
        files = self.files().join(listed.select("dataset").distinct(), "dataset", "left_semi")
        for kind, scan in self.scans(files).items():
            names = scan.counts().select("dataset")
            own = listed.join(names, "dataset", "left_semi").select("path").collect()
            records = with_rank(read_parts(self.spark, [r.path for r in own]), ["dataset"])
            self.job(kind, scan).adopt(records, with_rank(scan.documents(), ["dataset"]))

    def _publish(self, job: AnnotationJob, scan: CorpusScan) -> list[str]:
        rejects = job.rejects() if self.settings.publish_refused else None
        return publish(
            self.spark, job.annotations(), job.states(scan), self.target, self.settings, rejects
        )
