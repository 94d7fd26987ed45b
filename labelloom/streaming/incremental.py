"""Annotating files as they arrive or change.

The stream has news whenever the listing of the folder changes (``sources/listing.py``). A
ledger beside the checkpoint holds the files that are done, by path, size and time; those it
lacks are handed to the batch job, ``files_per_batch`` at a time, and noted when the job is
through with them. So a file that is replaced in place is taken up again, and the job calls for
its changed rows only; one that is moved in with an old time is not missed.

A batch that is replayed after a failure finds its answers in the response table and calls the
model for none of them, so at-least-once delivery ends in exactly-once results. The job reads
answers and rewrites annotations of the files' buckets only, however much was answered before.
Files that go away are noticed by ``AnnotationJob.run``, not here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from labelloom.plans.annotate import AnnotationJob
from labelloom.sources.corpora import CorpusScan
from labelloom.sources.listing import changing_files
from labelloom.sources.tables import ensure_table

LEDGER_TYPE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("time", T.LongType()),
    ]
)


@dataclass
class IncrementalAnnotation:
    """Runs ``job`` over the parquet files in ``folder``, whose last part may be a pattern.

    ``scan`` names the columns and ``schema`` is that of the files; ``files_per_batch`` is the
    granule of the ledger.
    """

    job: AnnotationJob
    scan: CorpusScan
    folder: str
    schema: T.StructType
    checkpoint: str
    files_per_batch: int = 100

    def arrivals(self) -> DataFrame:
        above, name = self.folder.rstrip("/").rsplit("/", 1)
        root, glob = (above, name) if "*" in name else (self.folder, "*.parquet")
        return changing_files(self.job.spark, root, glob).filter("length > 0")

    @property
    def _ledger(self) -> str:
        return f"{self.checkpoint}/handled"

    def annotate_batch(self, listing: DataFrame, _batch: int) -> None:
        spark = self.job.spark
        handled = ensure_table(spark, self._ledger, LEDGER_TYPE)
        news = listing.join(handled, LEDGER_TYPE.fieldNames(), "left_anti")
        files = sorted(tuple(row) for row in news.select(*LEDGER_TYPE.fieldNames()).collect())
        for start in range(0, len(files), self.files_per_batch):
            some = files[start:start + self.files_per_batch]
            self.annotate_files([path for path, *_ in some])
            spark.createDataFrame(some, LEDGER_TYPE).coalesce(1).write.mode("append").parquet(
                self._ledger)

    def annotate_files(self, paths: list[str]) -> None:
        buckets = self.job.call_open_parts(self.scan.only(paths), arrived=True)
        self.job.call_retries(buckets)
        self.job.derive_tables(self.job.stale(buckets))
        self.job.settle_failures(buckets)

    def start(self, **trigger) -> StreamingQuery:
        return (
            self.arrivals()
            .writeStream.foreachBatch(self.annotate_batch)
            .option("checkpointLocation", self.checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def catch_up(self) -> None:
        """Process everything that is there; each batch brings its corpora up to date."""
        self.start(availableNow=True).awaitTermination()
