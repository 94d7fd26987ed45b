"""Publishing finished annotations: completeness gate, copy, manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions.paths import annotation_path, publish_message
from labelloom.operators.resume import publishable, skip_published
from labelloom.plans.annotate import annotations_path, annotations_type, replace_corpora
from labelloom.settings import Settings
from labelloom.sources.corpora import corpus_counts
from labelloom.sources.tables import ensure_table

MANIFEST_TYPE = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)


def published_manifest(spark: SparkSession, target: str) -> DataFrame:
    """What the target holds: ``(dataset, path, location, message, n_rows)``.

    ``path`` is the name a corpus is known by, ``location`` the folder with its rows, below
    the target.
    """
    return ensure_table(spark, f"{target}/manifest", MANIFEST_TYPE)


def published_rows(
    spark: SparkSession, target: str, id_type: T.DataType = T.LongType()
) -> DataFrame:
    """All published annotations, read from where the manifest says they are.

    While no corpus with rows is published there are none, and ``id_type`` says what their ids
    would be; otherwise the files do.
    """
    places = [
        f"{target}/{row.location}"
        for row in published_manifest(spark, target).filter("n_rows > 0")
        .select("location").distinct().collect()
    ]
    if not places:
        return spark.createDataFrame([], annotations_type(id_type)).drop("bucket")
    reader = spark.read.option("basePath", f"{target}/annotations")
    return reader.parquet(*places).drop("model_slug")


def published_paths(spark: SparkSession, target: str) -> DataFrame:
    return published_manifest(spark, target).select("path").distinct()


def output_path(settings: Settings) -> Column:
    return annotation_path(F.col("dataset"), F.lit(settings.model_name))


def waiting_corpora(states: DataFrame, manifest: DataFrame, settings: Settings) -> DataFrame:
    """Complete corpora whose path is not published yet: ``(dataset, path)``."""
    complete = publishable(states).select("dataset").withColumn("path", output_path(settings))
    return skip_published(complete, manifest)


def publish(
    spark: SparkSession,
    annotations: DataFrame,
    states: DataFrame,
    target: str,
    settings: Settings,
    rejects: DataFrame | None = None,
) -> list[str]:
    """Copy complete, unpublished corpora to the target and record them.

    The copy replaces whole partitions and the record follows it, so a publish that dies
    in between is repeated without harm. ``rejects`` of these corpora are put beside them.
    Returns the corpora published (names only).
    """
    manifest = published_manifest(spark, target)
    waiting = waiting_corpora(states, manifest, settings)
    names = sorted(row.dataset for row in waiting.select("dataset").collect())
    if not names:
        return []
    ready = annotations.filter(F.col("dataset").isin(names))
    replace_corpora(ready, annotations_path(target, settings))
    if rejects is not None:
        replace_corpora(
            rejects.filter(F.col("dataset").isin(names)),
            f"{target}/rejects/model_slug={settings.model_slug}",
        )
    location = F.format_string(
        f"annotations/model_slug={settings.model_slug.replace('%', '%%')}/dataset=%s", "dataset"
    )
    counted = waiting.select("dataset").join(corpus_counts(ready), "dataset", "left").select(
        "dataset", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    (
        counted
        .select(
            "dataset",
            output_path(settings).alias("path"),
            location.alias("location"),
            publish_message(F.col("dataset"), F.lit(settings.model_name)).alias("message"),
            "n_rows",
        )
        .coalesce(1)
        .write.mode("append")
        .parquet(f"{target}/manifest")
    )
    return names
