import re
from collections import Counter, defaultdict

import corpus_pipeline
from labelloom.llm.mixing import fair_queue
from labelloom.llm.sharding import op9_sharding
from labelloom.llm.similar_texts import one_of_each
from pyspark.sql import functions as F


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    width = min(width, len(words)) or 1
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def near_duplicate_groups(rows):
    root = {d: d for d, _ in rows}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    sets, posted = {}, defaultdict(list)
    for d, text in sorted(rows):
        sets[d] = own = shingles(text)
        for e in {e for x in own for e in posted[x]}:
            if 100 * len(own & sets[e]) >= 80 * len(own | sets[e]):
                root[max(top(d), top(e))] = min(top(d), top(e))
        for x in own:
            posted[x].append(d)
    return {d: top(d) for d in root}


def test_stages_equal_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near duplicates", "benchmark leaks", "mixing", "sharding"]

    kept = stages["language"](spark, docs, sf_dir)
    assert kept.columns == columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert set(texts) == {r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text))}

    single = stages["near duplicates"](spark, kept, sf_dir)
    groups = near_duplicate_groups(list(texts.items()))
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(groups.values()))

    items = [shingles(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = stages["benchmark leaks"](spark, single, sf_dir)
    leaks = {d for d in set(groups.values())
             if any(len(i & shingles(texts[d])) >= 0.8 * len(i) for i in items)}
    assert clean.columns == columns
    assert {r.doc_id for r in clean.collect()} == set(groups.values()) - leaks

    mix = stages["mixing"](spark, clean, sf_dir)
    assert mix.columns == columns
    want = {r.doc_id: r.copies for r in fair_queue(clean).collect() if r.copies}
    assert Counter(r.doc_id for r in mix.collect()) == want

    shards = stages["sharding"](spark, mix, sf_dir)
    assert shards.columns == [*columns, "shard"]
    by_id = {r.doc_id: r.shard for r in op9_sharding(spark, sf_dir).collect()}
    assert all(r.shard == by_id[r.doc_id] for r in shards.collect())

    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, shards.collect()))


def test_rows_that_are_there_twice(documents):
    text = "one two three four five six seven eight"
    docs = documents([(1, text, "en", "a"), (1, text, "en", "a"), (2, text + " nine", "en", "a"),
                      (None, text, "en", "b"), (None, "x y z", "en", None), (3, None), (3, "")])
    rows = one_of_each(docs.withColumn("root", F.lit(1)), 5, 80).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in rows) == [
        (0, "x y z"), (1, text), (3, ""), (3, "")]


def test_repeated_rows_are_mixed_together(documents):
    docs = documents([(1, "a b c", "en", "s")] * 3 + [(None, "d", "en", None), (2, None)])
    rows = corpus_pipeline.mix_sources(None, docs.withColumn("rows_", F.lit(0)), "")
    taken = sum(r.copies for r in fair_queue(docs).collect())
    assert rows.count() == taken


def test_empty(spark, documents):
    sf_dir, docs = "/root/testdata/sf0.001", documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_clean_rows_stay_beside_contaminated_ones_of_their_id(spark, documents, tmp_path):
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    leak = "so a b c d e f g it is"
    docs = documents([(1, leak), (1, "clean"), (None, leak), (None, "x y"), (None, None),
                      (2, leak), (3, ""), (3, leak), (3, leak)])
    docs = docs.withColumns({"text_key": F.lit(1), "leak_text_key_": F.lit(2)})
    kept = corpus_pipeline.drop_benchmark_leaks(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [
        (0, ""), (0, "x y"), (1, "clean"), (3, "")]
