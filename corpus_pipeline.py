"""From raw documents to shards: five stages, each a call of one operator on whole tables.

``run`` writes what each stage returns and reads it again for the next one, so a failure
costs one stage at most and lineage never grows. Every stage reads all that the one before
kept, and returns the columns of ``documents``; the last one adds the shard.

Stages take what their operators define for nulls, empty texts, repeats and empty tables.
Texts without letters go in the first stage; documents without words are like no other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from labelloom.llm.decontamination import without_items
from labelloom.llm.language import in_known_language
from labelloom.llm.mixing import mixed
from labelloom.llm.shared import read_table, written
from labelloom.llm.sharding import with_shard
from labelloom.llm.similar_texts import one_of_each

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Words of a shingle and percent of similarity that make documents near duplicates.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
SHARDS = 40


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from those labelled; the others go."""
    return in_known_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id."""
    return one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text holds no benchmark item, whatever rows share their id."""
    return without_items(docs, read_table(spark, sf_dir, "benchmark"), by_row=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice."""
    return mixed(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    return with_shard(docs, "doc_id", SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("benchmark leaks", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: The first stage learns, which SQL cannot state; tests use brute force for the others.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
