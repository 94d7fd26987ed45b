"""Which documents are still to do, and which corpora are finished."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.operators.positions import BLOCK_ROWS

ROW_KEY = ("part", "version", "pos", "digest")


def row_digest(id_column: Column, text: Column) -> Column:
    """Fingerprint of a row's content: a row changed in place is not the same row."""
    return F.xxhash64(id_column, text)


def pending_rows(documents: DataFrame, done: DataFrame) -> DataFrame:
    """Documents whose ``(part, version, pos, digest)`` is not in ``done``.

    The key is unique and never null, so the join spreads evenly.
    """
    return documents.join(done.select(*ROW_KEY), list(ROW_KEY), "left_anti")


def pending_ids(documents: DataFrame, done: DataFrame) -> DataFrame:
    """Documents left when ``done`` knows rows only by ``(dataset, id)``.

    Ids and names may repeat and be null. An id done n times frees its first n rows, by
    position. Rows and their done ones are counted per id and block of positions, the
    counts are added up, and only narrow rows are ranked inside their blocks: an id with any
    share of the rows is never gathered. Texts are met once, by position.
    """
    narrow = documents.select(F.struct("dataset", "id").alias("_key"), "part", "pos").withColumn(
        "_block", F.expr(f"pos DIV {BLOCK_ROWS}")
    )
    n_done = done.groupBy(F.struct("dataset", "id").alias("_key")).agg(
        F.count(F.lit(1)).alias("_done")
    )
    blocks = (
        narrow.groupBy("_key", "part", "_block").agg(F.count(F.lit(1)).alias("_rows"))
        .join(n_done, "_key")
        .withColumn("_before", F.coalesce(F.sum("_rows").over(
            Window.partitionBy("_key").orderBy("part", "_block")
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("_key", "part", "_block", (F.col("_done") - F.col("_before")).alias("_free"))
        .filter("_free > 0")
    )
    place = F.row_number().over(Window.partitionBy("_key", "part", "_block").orderBy("pos"))
    freed = (
        narrow.join(blocks, ["_key", "part", "_block"])
        .withColumn("_place", place).filter("_place <= _free").select("part", "pos")
    )
    return documents.join(freed, ["part", "pos"], "left_anti")


def skip_published(corpora: DataFrame, published: DataFrame) -> DataFrame:
    """Corpora whose output path is not published yet."""
    return corpora.join(published.select("path").distinct(), "path", "left_anti")


def completeness(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """State of each corpus from its row count and its annotated row count."""
    done = F.coalesce(actual["n_rows"], F.lit(0)).alias("n_done")
    return with_state(
        expected.join(actual, "dataset", "left").select("dataset", expected["n_rows"], done)
    )


def with_state(counted: DataFrame) -> DataFrame:
    """States of corpora from ``(dataset, n_rows, n_done)``."""
    want, done = F.col("n_rows"), F.col("n_done")
    state = (
        F.when(done > want, "over_complete")
        .when(want == 0, "empty")
        .when(done == 0, "none")
        .when(done < want, "partial")
        .otherwise("complete")
    )
    return counted.select(
        "dataset", want.alias("expected_rows"), done.alias("actual_rows"), state.alias("state")
    )


def over_complete(states: DataFrame) -> DataFrame:
    return states.filter(F.col("state") == "over_complete")


def folder_of(part: Column) -> Column:
    return F.regexp_replace(part, "/[^/]*$", "")


def orphans(done: DataFrame, documents: DataFrame) -> DataFrame:
    """Annotated rows whose folder of files no longer has a row of the same content."""
    there = documents.select(folder_of(F.col("part")).alias("_folder"), F.col("digest"))
    return (
        done.withColumn("_folder", folder_of(F.col("part")))
        .join(there, ["_folder", "digest"], "left_anti").drop("_folder")
    )


def publishable(states: DataFrame) -> DataFrame:
    """States of the corpora whose annotation is whole."""
    return states.filter(F.col("state") == "complete")


def progress(responses: DataFrame) -> DataFrame:
    """Per corpus: rows answered, accepted and refused."""
    accepted = F.col("annotation").isNotNull()
    return responses.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(accepted).alias("n_accepted"),
        F.count_if(~accepted).alias("n_refused"),
    )
