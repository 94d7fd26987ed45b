"""Small helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.sources.tables import scratch_root

#: White space that separates words: blank, and the control characters 9 to 13.
SPACES = r"[\x20\x09-\x0D]+"
#: A word: anything between white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the cluster's shared scratch folder: computed once, lineage cut."""
    path = scratch_root(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most_rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES, -1), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
