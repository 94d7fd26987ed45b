"""Tables that may not have been written yet, and a shared scratch root."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ensure_table(
    spark: SparkSession, path: str, schema: T.StructType, partition_keys: Sequence[str] = ()
) -> DataFrame:
    """The parquet table at ``path``, created empty with ``schema`` when it is missing."""
    empty = spark.createDataFrame([], schema).coalesce(1)
    empty.write.mode("ignore").partitionBy(*partition_keys).parquet(path)
    return spark.read.schema(schema).parquet(path)


def scratch_root(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="labelloom-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
