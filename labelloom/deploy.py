"""Making this package importable inside executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

ARCHIVE = "labelloom_package"


def ship_package(spark: SparkSession) -> SparkSession:
    """Send the package's source to all Python workers, once per application.

    Spark serves the archive from the driver, as it does for ``--py-files``.
    """
    context = spark.sparkContext
    if not any(ARCHIVE in name for name in context.listFiles):
        package = Path(__file__).resolve().parent
        base = Path(tempfile.mkdtemp(prefix="labelloom-")) / ARCHIVE
        context.addPyFile(
            shutil.make_archive(str(base), "zip", package.parent, package.name)
        )
    return spark
