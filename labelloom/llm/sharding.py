"""Shards by jump consistent hashing: stable keys, no ring table, few moves when shards grow.

A key walks through ever larger shard numbers, each jump drawn from a generator seeded by the
key, and stays in the last one below the number of shards. With one shard more, a key either
stays or moves into the new shard.

The generator is the published 64-bit linear congruential one. Its product is below 10**38,
so it is exact in ``decimal(38, 0)`` whatever the session says about overflow. The seed is
made of 60 bits of the key's MD5, so ids of any type and pattern spread evenly.

Defined results: a null key is a key like any other; rows that repeat a key share its shard
(that is the law), and get slots of their own. A null text has no bytes and the checksum of
no bytes. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelloom.llm.shared import read_table, written

MULTIPLIER = "2862933555777941757"
MODULUS = "18446744073709551616"  # 2 ** 64
TOP_BITS = "8589934592"  # 2 ** 33

#: Jumps tried in the short walk; a longer one (about one key in 10**40) takes the long way.
SHORT_WALK = 64
#: Rows that one task numbers at most, about.
ROWS_PER_BLOCK = 200_000
ROW_BYTES = 16


def shard_seed(key: Column) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")


def jump_hash(seed: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a seed (a whole number below 2**64)."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    number = lambda text: F.lit(text).cast("decimal(38,0)")

    def jump(state: Column, _: Column) -> Column:
        drawn = ((state["seed"] * number(MULTIPLIER)).cast("decimal(38,0)") + 1).cast(
            "decimal(38,0)"
        ) % number(MODULUS)
        low = drawn % number(TOP_BITS)  # taken off first: decimal division rounds
        top = ((drawn - low) / number(TOP_BITS)).cast("double")
        moved = F.struct(
            drawn.cast("decimal(38,0)").alias("seed"),
            state["next"].alias("shard"),
            F.floor((state["next"] + 1) * (F.lit(2147483648.0) / (top + 1)))
            .cast("long")
            .alias("next"),
        )
        return F.when(state["next"] < shards, moved).otherwise(state)

    def walk(state: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, jump)

    start = F.struct(
        seed.cast("decimal(38,0)").alias("seed"),
        F.lit(0).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("next"),
    )
    end = walk(start, min(shards, SHORT_WALK))
    if shards > SHORT_WALK:
        end = F.when(end["next"] < shards, walk(end, shards)).otherwise(end)
    return end["shard"].cast("int")


def with_shard(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    return df.withColumn(name, jump_hash(shard_seed(F.col(key)), shards))


def with_slots(df: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Number the rows of every shard without a gap, from 0, as the column ``slot``.

    Rows are numbered inside blocks of their shard, chosen by a hash of ``order``, and the
    blocks' counts are added up: no task holds a whole shard. ``df`` is read twice.
    """
    spark = df.sparkSession
    largest = df.groupBy(shard).count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, -(-largest // ROWS_PER_BLOCK), spark.sparkContext.defaultParallelism // 4)
    placed = df.withColumn("block_", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    before = W.partitionBy(shard).orderBy("block_").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy(shard, "block_")
        .agg(F.count("*").alias("rows_"))
        .withColumn("start_", F.coalesce(F.sum("rows_").over(before), F.lit(0)))
        .drop("rows_")
    )
    inside = W.partitionBy(shard, "block_").orderBy(*order)
    numbered = placed.withColumn("row_", F.row_number().over(inside))
    return (
        numbered.join(starts, [shard, "block_"])
        .withColumn("slot", (F.col("start_") + F.col("row_") - 1).cast("long"))
        .drop("block_", "row_", "start_")
    )


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """Every document's size, checksum, shard, slot, and its shard were there one more."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        jump_hash(shard_seed(F.col("doc_id")), shards).alias("shard"),
        jump_hash(shard_seed(F.col("doc_id")), shards + 1).alias("grown_shard"),
    )
    return with_slots(written(narrow, "shards"), "shard", ["doc_id", "text_crc32", "size"])


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
