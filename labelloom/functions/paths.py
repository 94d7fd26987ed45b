"""Names of annotation outputs as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def model_slug(model_name: Column) -> Column:
    return F.replace(model_name, F.lit("/"), F.lit("--"))


def annotation_path(dataset: Column, model_name: Column) -> Column:
    """Path of a finished annotation relative to the collection: the publish key."""
    return F.concat(
        F.lit("annotations/"), dataset, F.lit("/"), model_slug(model_name), F.lit(".parquet")
    )


def _with_suffix(path: Column, suffix: Column) -> Column:
    return F.concat(F.regexp_replace(path, r"\.parquet$", ""), suffix)


def temp_annotation_path(path: Column) -> Column:
    return _with_suffix(path, F.lit(".tmp.parquet"))


def resume_annotation_path(path: Column, part_index: Column | int) -> Column:
    index = part_index if isinstance(part_index, Column) else F.lit(part_index)
    return _with_suffix(path, F.concat(F.lit(".part"), index.cast("string"), F.lit(".parquet")))


def publish_message(dataset: Column, model_name: Column) -> Column:
    return F.concat(F.lit("Add "), dataset, F.lit(" annotations with "), model_name)
