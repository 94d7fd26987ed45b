"""Corpora: finding them, telling real files from pointers, and scanning them.

A collection keeps each corpus under ``<root>/<name>/<name>.parquet`` (a file, or a
folder of part files). All corpora are scanned together as one DataFrame of documents

    dataset, id, text, part, version, pos

where ``part`` is the file a row came from, ``version`` a fingerprint of that file's size
and time of change, and ``pos`` the row's position in it. ``(part, version, pos)`` names a
row uniquely without any shuffle, whatever its id is: null and repeated ids stay apart, and
no key is ever hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

import pandas as pd
import pyarrow as pa
from pyarrow.parquet import ParquetFile
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from labelloom.deploy import ship_package
from labelloom.fixed_values import POINTER_FIRST_LINE, PSEUDO_CORPUS
from labelloom.sources.files import file_system
from labelloom.sources.listing import listed_files

FILE_TYPE = T.StructType(
    [T.StructField("dataset", T.StringType()), T.StructField("path", T.StringType())]
)
READY, PLACEHOLDER, EMPTY, MISSING = "ready", "placeholder", "empty", "missing"

#: Files whose footers one task reads.
FILES_PER_TASK = 64

# What is not part of a line at its ends.
BLANKS = b" \t\r\x0b\x0c"
_CORPUS_PATH = r"/([^/]+)/\1\.parquet(?:/[^/]+)?$"


def corpus_of_path(path: Column) -> Column:
    """Corpus name of ``…/<name>/<name>.parquet`` or a part file below it, else empty."""
    return F.regexp_extract(path, _CORPUS_PATH, 1)


def file_of_row() -> Column:
    """Path of a row's file, decoded to the form that readers and listings use."""
    encoded = F.col("_metadata.file_path")
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def starts_with_marker(read: Callable[[int], bytes]) -> bool:
    """Whether the first line of what ``read`` gives is the marker, blanks around it aside.

    Reads on only while the line can still be the marker: a file of any other kind is put
    away after its first bytes, however large it is.
    """
    marker, line = POINTER_FIRST_LINE.encode(), b""
    while True:
        more = read(256)
        line = (line + more).lstrip(BLANKS)
        head, end, _ = line.partition(b"\n")
        if end or not more:
            return head.rstrip(BLANKS) == marker
        if not marker.startswith(head[: len(marker)]) or head[len(marker):].strip(BLANKS):
            return False
        line = head[: len(marker)] + head[len(marker) : len(marker) + 1]


def probe_pointers(paths: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Whether each file is a pointer, by opening it."""
    for part in paths:
        found = []
        for path in part:
            system, local = file_system(path)
            with system.open_input_stream(local) as stream:
                found.append(starts_with_marker(stream.read))
        yield pd.Series(found, dtype=bool)


def read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths to what the files' footers say: rows, columns and their types."""
    for batch in batches:
        paths, rows, columns, types = batch.column(0).to_pylist(), [], [], []
        for path in paths:
            system, local = file_system(path)
            with system.open_input_file(local) as source:
                footer = ParquetFile(source)
                rows.append(footer.metadata.num_rows)
                columns.append(footer.schema_arrow.names)
                types.append([from_arrow_type(t).simpleString()
                              for t in footer.schema_arrow.types])
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths), pa.array(rows, pa.int64()),
             pa.array(columns, pa.list_(pa.string())), pa.array(types, pa.list_(pa.string()))],
            names=["path", "n_rows", "columns", "types"])


def footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, n_rows, columns, types)`` of parquet files, read by tasks from the footers."""
    ship_package(spark)
    tasks = max(1, -(-len(paths) // FILES_PER_TASK))
    listed = spark.createDataFrame([(path,) for path in paths], "path string").repartition(tasks)
    return listed.mapInArrow(
        read_footers, "path string, n_rows long, columns array<string>, types array<string>"
    ).persist()


def corpus_files(
    spark: SparkSession, root: str, name: Column | None = None, glob: str = "*.parquet"
) -> DataFrame:
    """``(dataset, path, length, pointer)`` per file below ``root``, empty ones included.

    The listing reads no file. Each file is then opened by a task and read as far as its
    first line may be a pointer's: the test depends on content, not on size.
    """
    ship_package(spark)
    files = listed_files(spark, root, glob)
    dataset = corpus_of_path(F.col("path")) if name is None else name
    probe = F.pandas_udf(probe_pointers, "boolean")
    return files.select(dataset.alias("dataset"), "path", "length").filter(
        F.col("dataset") != ""
    ).withColumn("pointer", probe("path"))


def corpus_manifest(files: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """``(dataset, status, n_files)``: ready, placeholder, empty or missing.

    A corpus with a file of zero bytes, which is no parquet file, is ``empty``. ``names`` adds
    wanted corpora that have no file at all.
    """
    found = files.groupBy("dataset").agg(
        F.when(F.bool_or("pointer"), PLACEHOLDER)
        .when(F.min("length") == 0, EMPTY).otherwise(READY).alias("status"),
        F.count(F.lit(1)).alias("n_files"),
    )
    if names is None:
        return found
    return names.join(found, "dataset", "left").select(
        "dataset",
        F.coalesce("status", F.lit(MISSING)).alias("status"),
        F.coalesce("n_files", F.lit(0)).alias("n_files"),
    )


class UnavailableCorpora(ValueError):
    """Corpora that have no ready files anywhere."""


def route_files(local: DataFrame, fallback: DataFrame) -> DataFrame:
    """``(dataset, path, source)``: files to scan, from one place for each corpus.

    A corpus is ready where all its files are. Ready local corpora come from there, others
    from the fallback if they are ready there. For a corpus ready nowhere there is one row
    with a null path and the source ``unavailable``; ``require_available`` refuses it.
    """
    states = (
        corpus_manifest(local).select("dataset", F.col("status").alias("here"))
        .join(
            corpus_manifest(fallback).select("dataset", F.col("status").alias("there")),
            "dataset", "full",
        )
        .select("dataset", F.when(F.col("here") == READY, "local")
                .when(F.col("there") == READY, "fallback")
                .otherwise("unavailable").alias("source"))
    )
    files = (
        local.select("dataset", "path", F.lit("local").alias("source"))
        .unionByName(fallback.select("dataset", "path", F.lit("fallback").alias("source")))
    )
    return states.join(files, ["dataset", "source"], "left").select("dataset", "path", "source")


def require_available(
    routed: DataFrame, wanted: str | None = None, files: DataFrame | None = None
) -> DataFrame:
    """``routed``, if every corpus in it has files, and ``wanted`` is among them.

    ``files`` are those listed: empty ones of corpora that are refused are named.
    """
    lost = [r.dataset for r in routed.filter("path IS NULL").select("dataset").limit(20).collect()]
    if not lost and wanted is not None and routed.limit(1).count() == 0:
        lost = [wanted]
    if lost:
        empty = [] if files is None else [
            r.path for r in files.filter((F.col("length") == 0) & F.col("dataset").isin(lost))
            .select("path").orderBy("path").limit(20).collect()]
        why = f" (empty: {', '.join(empty)})" if empty else ""
        raise UnavailableCorpora(f"no ready files for {', '.join(sorted(lost))}{why}")
    return routed


def list_corpora(datasets: DataFrame) -> DataFrame:
    """Distinct corpus names without the pseudo-corpus."""
    return datasets.select("dataset").distinct().filter(F.col("dataset") != PSEUDO_CORPUS)


@dataclass(frozen=True)
class CorpusScan:
    """Parquet files to read as documents.

    ``dataset`` names the corpus of a row: a column expression over the table, or
    ``None`` to take it from the file's path.
    """

    spark: SparkSession
    paths: tuple[str, ...]
    id_column: str = "id"
    text_column: str = "text"
    dataset: Column | None = None
    where: Column | None = None
    schema: T.StructType | None = None

    def __post_init__(self) -> None:
        if self.paths:
            self._require_columns(self._table.columns, "corpus")

    def _require_columns(self, columns: Sequence[str], what: str) -> None:
        missing = {self.id_column, self.text_column} - set(columns)
        if missing:
            raise ValueError(f"{what} lacks column(s) {sorted(missing)}")

    def by_id_type(self) -> dict[str, CorpusScan]:
        """Scans of corpora whose ids have one type each, after a look at every file.

        Tasks read the files' footers, some files each; a corpus whose files' ids differ in
        type, or that lacks a column, is refused by name.
        """
        corpus = F.regexp_extract("path", r"^(.*?\.parquet)(?:/[^/]*)?$", 1)
        found = footers(self.spark, self.paths).withColumn("corpus", corpus).withColumn(
            "missing", F.array_except(
                F.array(F.lit(self.id_column), F.lit(self.text_column)), "columns")
        ).withColumn("kind", F.get("types", F.array_position("columns", self.id_column) - 1))
        wrong = found.groupBy("corpus").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("missing")))).alias("missing"),
            F.count_distinct("kind").alias("kinds"),
        ).filter("size(missing) > 0 OR kinds > 1").orderBy("corpus").first()
        if wrong is not None and wrong.missing:
            raise ValueError(f"{wrong.corpus} lacks column(s) {wrong.missing}")
        if wrong is not None:
            raise ValueError(f"{wrong.corpus} has ids of several types")
        kinds: dict[str, list[str]] = {}
        for row in found.select("path", "kind").collect():
            kinds.setdefault(row.kind, []).append(row.path)
        return {
            kind: replace(self, paths=tuple(sorted(own)), schema=None)
            for kind, own in sorted(kinds.items())
        }

    @cached_property
    def _table(self) -> DataFrame:
        """Listed once; a narrower scan inherits the schema instead of inferring it."""
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        table = reader.parquet(*self.paths)
        return table if self.where is None else table.filter(self.where)

    def documents(self, keyed: bool = True) -> DataFrame:
        """``dataset, id, text`` and, if ``keyed``, ``part, version, pos``; no more is read."""
        dataset = corpus_of_path(file_of_row()) if self.dataset is None else self.dataset
        key = [
            file_of_row().alias("part"),
            F.xxhash64("_metadata.file_modification_time", "_metadata.file_size").alias("version"),
            F.col("_metadata.row_index").alias("pos"),
        ]
        return self._table.select(
            dataset.alias("dataset"),
            F.col(self.id_column).alias("id"),
            F.col(self.text_column).alias("text"),
            *(key if keyed else ()),
        )

    @property
    def id_type(self) -> T.DataType:
        return self._table.schema[self.id_column].dataType

    def counts(self) -> DataFrame:
        """``(dataset, n_rows)``; corpora named by their path are there even when empty."""
        counts = corpus_counts(self.documents(keyed=False))
        if self.dataset is not None:
            return counts
        return self._named().join(counts, "dataset", "left").select(
            "dataset", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
        )

    def _named(self) -> DataFrame:
        if self.dataset is not None:
            return self.documents(keyed=False).select("dataset").distinct()
        listed = self.spark.createDataFrame([(path,) for path in self.paths], "path string")
        return listed.select(corpus_of_path(F.col("path")).alias("dataset")).distinct()

    def names(self) -> list[str]:
        """Corpora of the scan; those that a column names need a pass over that column."""
        return sorted(row.dataset for row in self._named().collect() if row.dataset is not None)

    def only(self, paths: Sequence[str]) -> CorpusScan:
        return replace(self, paths=tuple(paths), schema=self.schema or self._schema())

    def _schema(self) -> T.StructType | None:
        return self._table.schema if self.paths else None

    def corpus(self, name: str) -> CorpusScan:
        """The scan of one corpus.

        Path-derived corpora are pruned file by file before anything is read; others
        by a predicate that reaches the parquet reader.
        """
        if self.dataset is None:
            return self.only(
                [path for path in self.paths if path.split("/")[-1] == f"{name}.parquet"
                 or path.split("/")[-2] == f"{name}.parquet"]
            )
        return replace(self, where=self.dataset == name)


def part_counts(documents: DataFrame) -> DataFrame:
    """Rows per corpus and file. With path-derived corpora only file footers are read."""
    return documents.groupBy("dataset", "part").agg(F.count(F.lit(1)).alias("n_rows"))


def file_versions(documents: DataFrame) -> DataFrame:
    """``(part, version, n_rows)`` of the files read."""
    return documents.groupBy("part", "version").agg(F.count(F.lit(1)).alias("n_rows"))


def corpus_counts(documents: DataFrame) -> DataFrame:
    return documents.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_rows"))

