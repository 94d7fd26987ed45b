"""Files that tasks and driver open by themselves, on any file system both can reach."""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import SparkSession


def file_system(path: str) -> tuple[FileSystem, str]:
    """The file system of a path or address, and the path within it."""
    if path.startswith("file:") or not urlsplit(path).scheme:
        return LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return FileSystem.from_uri(path)


def full_address(spark: SparkSession, root: str, table: str) -> str:
    """``root`` as Spark resolves it, told by a file of the ``table`` below it."""
    (file, *_) = spark.read.parquet(table).inputFiles()
    below = table.rstrip("/").removeprefix(root.rstrip("/"))
    return unquote(file).rsplit(f"{below}/", 1)[0]


def delete_folder(path: str) -> None:
    system, local = file_system(path)
    system.delete_dir_contents(local, missing_dir_ok=True, accept_root_dir=False)
