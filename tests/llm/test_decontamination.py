import pytest
from pyspark.sql import functions as F

from labelloom.llm import decontamination
from labelloom.llm.decontamination import OP3_SQL, find_items, op3_decontamination, without_items
from oracle_check import compare, connect


def test_query_equals_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), sf_dir, op3_decontamination, OP3_SQL) > 0


def words(*ranges):
    return " ".join(f"w{i}" for a, b in ranges for i in range(a, b))


@pytest.mark.parametrize("most_rows", [1_000_000, 0])
def test_containment_is_exact_at_the_threshold(spark, documents, monkeypatch, most_rows):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", most_rows)
    items = spark.createDataFrame(
        [(1, words((0, 24))), (2, "Ab\tc\nd"), (3, None), (4, " "), (5, "x y z u v")],
        "item_id long, text string",
    )
    docs = documents([
        (10, words((500, 900), (0, 20), (300, 400))),  # 16 of 20 shingles
        (11, words((500, 900), (0, 19), (300, 400))),  # 15 of 20
        (12, words((0, 12), (40, 60), (8, 24))),  # 8 and 12, none shared
        (13, "q " * 5000 + "aB C D q"),
        (14, None), (15, ""), (None, "x y z u v"), (16, "x y z u"), (13, "ab c"),
    ])
    got = {(r.doc_id, r.item_id): r.containment for r in find_items(docs, items).collect()}
    assert got == {(10, 1): 0.8, (12, 1): 1.0, (13, 2): 1.0, (None, 5): 1.0}
    kept = without_items(docs.withColumn("hash", F.lit(0)), items)
    assert sorted(r.doc_id for r in kept.collect()) == [11, 14, 15, 16]
    assert kept.columns == [*docs.columns, "hash"]


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert find_items(documents([]), items).count() == 0
    assert find_items(documents([(1, "a b")]), items.where("false")).count() == 0
