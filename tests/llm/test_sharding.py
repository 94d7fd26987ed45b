import hashlib
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from labelloom.llm.sharding import jump_hash, op9_sharding, shard_documents, shard_seed, with_slots


def jump(seed, shards):
    """The published algorithm."""
    b, j = -1, 0
    while j < shards:
        b = j
        seed = (seed * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((seed >> 33) + 1)))
    return b


def seed_of(key):
    text = "" if key is None else str(key)
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def test_jump_equals_the_published_algorithm(spark):
    keys = spark.range(3000).select("id")
    for shards in (1, 2, 7, 40, 1000):
        got = keys.select("id", jump_hash(shard_seed(F.col("id")), shards).alias("s")).collect()
        assert {r.id: r.s for r in got} == {k: jump(seed_of(k), shards) for k in range(3000)}


def test_query_equals_brute_force(spark, sf_dir):
    rows = op9_sharding(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert r["size"] == len(data) + 16 and r.text_crc32 == zlib.crc32(data)
        assert r.shard == jump(seed_of(r.doc_id), 40)
        assert r.grown_shard in (r.shard, 40) and r.grown_shard == jump(seed_of(r.doc_id), 41)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_nulls_repeats_and_clashing_columns(documents):
    docs = documents([(1, "a"), (1, "a"), (1, "b"), (None, None), (None, "é"), (3, "")])
    docs = docs.withColumns({"shard": F.lit("x"), "slot": F.lit(9), "block_": F.lit(1)})
    rows = shard_documents(docs, 3).collect()
    assert sorted((r.doc_id or 0, r["size"]) for r in rows) == [
        (0, 16), (0, 18), (1, 17), (1, 17), (1, 17), (3, 16)
    ]
    assert len({r.shard for r in rows if r.doc_id == 1}) == 1
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)


def test_slots_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr("labelloom.llm.sharding.ROWS_PER_BLOCK", 10)
    df = spark.range(500).select("id", (F.col("id") % 3).alias("shard"))
    rows = with_slots(df, "shard", ["id"]).collect()
    for shard, n in Counter(r.shard for r in rows).items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_empty(documents):
    assert shard_documents(documents([]), 4).count() == 0
