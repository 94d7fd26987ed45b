"""Positions of rows inside corpora, without ever sorting a corpus in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.settings import Settings

BLOCK_ROWS = 65_536


def with_rank(
    rows: DataFrame, group: Sequence[str], name: str = "rank", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add the 0-based rank of each row within ``group`` by ``(part, pos)``.

    Equals one row number over the group, but no task holds a group: rows are ranked
    inside fixed blocks of ``pos``, and a block's offset is the running count of the
    blocks before it. The running count sees one row per group and block, so a group
    with a third of ten billion rows costs fifty thousand rows there.
    Keep wide columns out of ``rows``; they would be shuffled along.
    """
    # As one struct the group is never null, so null keys join by plain equality, which
    # keeps the partitioning of the row window for the join.
    block_key = ["_group", "part", "_block"]
    blocked = rows.withColumn("_group", F.struct(*group)).withColumn(
        "_block", F.expr(f"pos DIV {block_rows}")
    )
    earlier = Window.partitionBy("_group").orderBy("part", "_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        blocked.groupBy(*block_key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    in_block = Window.partitionBy(*block_key).orderBy("pos")
    ranked = blocked.withColumn("_in_block", F.row_number().over(in_block) - 1)
    return ranked.join(offsets, block_key).select(
        *rows.columns, (F.col("_in_block") + F.col("_offset")).alias(name)
    )


def with_file_rank(documents: DataFrame, counts: DataFrame, name: str = "rank") -> DataFrame:
    """The same rank for files that hold a single corpus each, with no shuffle of rows.

    ``counts`` is ``(dataset, part, n_rows)`` from the file footers. Its size is one row
    per file, so the join is left to Spark to broadcast or shuffle by measured size.
    """
    earlier = Window.partitionBy("dataset").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        "dataset", "part", F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        documents.join(offsets, ["dataset", "part"])
        .withColumn(name, F.col("pos") + F.col("_offset"))
        .drop("_offset")
    )


def batch_size(remaining: Column, total: Column, settings: Settings) -> Column:
    """Rows per batch: the configured size, bounded by what is left and by concurrency."""
    concurrency = F.least(F.lit(settings.requests_per_task), total)
    return F.greatest(F.least(F.lit(settings.batch_rows), remaining), concurrency)


def batch_plan(ranked: DataFrame, progress: DataFrame, settings: Settings) -> DataFrame:
    """``batch_id`` of each row still to do, counting from the first one.

    ``ranked`` has ``dataset`` and ``rank``; ``progress`` has one row per corpus
    ``(dataset, n_rows, n_done)``, and the first ``n_done`` rows are skipped.
    """
    left = F.col("n_rows") - F.col("n_done")
    sizes = progress.select(
        "dataset", "n_done", batch_size(left, F.col("n_rows"), settings).alias("_size")
    )
    return (
        ranked.join(sizes, "dataset")
        .filter(F.col("rank") >= F.col("n_done"))
        .withColumn(
            "batch_id", F.expr("(rank - n_done) DIV _size")
        )
        .drop("_size", "n_done")
    )


def after_prefix(ranked: DataFrame, done: DataFrame) -> DataFrame:
    """Positional resume: rows past the first ``n_done`` of their corpus."""
    return (
        ranked.join(done.select("dataset", "n_done"), "dataset", "left")
        .filter(F.col("rank") >= F.coalesce("n_done", F.lit(0)))
        .drop("n_done")
    )
