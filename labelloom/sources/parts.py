"""Partial annotation files of interrupted runs, as left beside a finished output.

``<slug>.tmp.parquet`` comes first, then ``<slug>.part1.parquet``, ``.part2`` and so on
up to the first gap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelloom.operators.positions import with_file_rank
from labelloom.sources.corpora import file_of_row
from labelloom.taxonomy import FIELD_NAMES

_PART = r"/([^/]+)/([^/]+?)\.(tmp|part[1-9][0-9]*)\.parquet(?:/[^/]+)?$"


def part_index(path: Column) -> Column:
    """0 for the temporary file, N for ``.partN``, null for anything else."""
    kind = F.regexp_extract(path, _PART, 3)
    return F.when(kind == "tmp", 0).when(
        kind != "", F.replace(kind, F.lit("part"), F.lit("")).cast("int")
    )


def partial_outputs(spark: SparkSession, root: str) -> DataFrame:
    """``(dataset, model_slug, part_index, path)`` of the parts that count.

    The window sees the few part files of one corpus and model.
    """
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        .select(
            F.regexp_extract("path", _PART, 1).alias("dataset"),
            F.regexp_extract("path", _PART, 2).alias("model_slug"),
            part_index(F.col("path")).alias("part_index"),
            "path",
        )
        .filter(F.col("part_index").isNotNull())
    )
    numbered = listed.filter(F.col("part_index") > 0)
    in_order = Window.partitionBy("dataset", "model_slug").orderBy("part_index")
    unbroken = (
        numbered.withColumn("_place", F.dense_rank().over(in_order))
        .filter(F.col("_place") == F.col("part_index"))
        .drop("_place")
    )
    return listed.filter(F.col("part_index") == 0).unionByName(unbroken)


def read_parts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of part files, in the documents' shape: part and position included.

    ``part`` is prefixed by the part's index, so that sorting it gives the part order.
    """
    path = file_of_row()
    order = F.format_string("%09d ", part_index(path))
    return spark.read.parquet(*paths).select(
        F.regexp_extract(path, _PART, 1).alias("dataset"),
        "id",
        F.struct(*FIELD_NAMES).alias("annotation"),
        F.concat(order, path).alias("part"),
        F.col("_metadata.row_index").alias("pos"),
    )


def merge_parts(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, columns matched by name."""
    return reduce(DataFrame.unionByName, parts)


def write_in_order(records: DataFrame, path: str, rows_per_file: int) -> None:
    """Write ``dataset, part, pos, ...`` as files that give the input order by their names.

    Output files are planned from the parts' row counts: running sums say at which rank a part
    begins, and every ``rows_per_file`` ranks of a corpus are a file. Rows go straight to the
    task that writes their file, whose number leads its name, so the order holds across files
    however many there are, and nothing is sorted but the rows of one file. Positions must
    count the rows of a part from 0, and ``dataset`` must not be null.

    The driver sees one row per corpus. Without records nothing is written.
    """
    counts = records.groupBy("dataset", "part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("pos").alias("last"))
    corpora = counts.groupBy("dataset").agg(
        F.sum("n_rows").alias("n"), F.bool_and(F.col("last") + 1 == F.col("n_rows")).alias("whole")
    ).collect()
    gaps = [row.dataset for row in corpora if not row.whole]
    if gaps:
        raise ValueError(f"rows are missing in parts of {sorted(gaps)[:3]}")
    first, n_files = [], 0
    for row in sorted(corpora, key=lambda row: row.dataset):
        first.append((row.dataset, n_files))
        n_files += -(-row.n // rows_per_file)
    if not n_files:
        return
    starts = records.sparkSession.createDataFrame(first, "dataset string, _first long")
    placed = with_file_rank(records, counts, "_rank").join(starts, "dataset").withColumn(
        "_file", F.expr(f"CAST(_first + _rank DIV {rows_per_file} AS INT)"))
    (
        placed.repartitionById(n_files, "_file")
        .sortWithinPartitions("dataset", "part", "pos")
        .drop("part", "pos", "_rank", "_first", "_file")
        .write.partitionBy("dataset").parquet(path)
    )


def merge_part_files(
    spark: SparkSession, root: str, model_slug: str, path: str, rows_per_file: int = 1_000_000
) -> None:
    """The parts of interrupted runs of all corpora below ``root`` as one output, in order."""
    listed = partial_outputs(spark, root).filter(F.col("model_slug") == model_slug)
    paths = sorted(row.path for row in listed.select("path").collect())
    if paths:
        records = read_parts(spark, paths)
        write_in_order(
            records.select("dataset", "part", "pos", "id", "annotation.*"), path, rows_per_file)
