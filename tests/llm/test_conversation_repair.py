import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import conversation_repair as repair
from labelloom.llm.conversation_repair import (
    AUDIT,
    END,
    FORWARD,
    LAST,
    LETTERS,
    OP11_SQL,
    audit_conversations,
    cheapest,
    op11_repair,
    price,
    profiles,
    repair_conversations,
)
from oracle_check import compare, connect

SCHEMA = "conv_id long, turn long, role string, text string, edits string, letter int"


def least(rows):
    """Cost and audit of the cheapest repair, by all paths from the end."""
    best = [(3 * len(e), e.translate(AUDIT)) for e in LAST]
    for letter in reversed(rows):
        best = [
            min((cost + best[there][0], audit + best[there][1])
                for there, cost, audit, _ in FORWARD[letter][state])
            for state in range(4)
        ]
    return best[0]


def searched(pieces):
    known, tables = profiles()
    after = [0]
    for piece in reversed(pieces[1:]):
        number = after[-1]
        for letter in reversed(piece):
            number = int(tables[letter][number])
        after.append(number)
    state, edits = 0, ""
    for piece, number in zip(pieces, reversed(after), strict=True):
        made, state = cheapest(piece, state, known[number])
        edits += made
    edits += LAST[state]
    return price("".join(pieces), edits), edits.translate(AUDIT)


def test_search_from_both_sides_finds_the_least_audit():
    rng = random.Random(3)
    words = ["".join(w) for n in (1, 2, 3) for w in itertools.product(LETTERS, repeat=n)]
    words += ["".join(rng.choices(LETTERS, k=rng.randint(4, 50))) for _ in range(1000)]
    for word in words:
        assert searched([word]) == least(word), word


def test_pieces_make_the_same_repair():
    rng = random.Random(4)
    for _ in range(1000):
        word = "".join(rng.choices(rng.choice([LETTERS, "uuuaas"]), k=rng.randint(4, 60)))
        cuts = sorted(rng.sample(range(1, len(word)), rng.randint(1, 3)))
        pieces = [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]
        assert searched(pieces) == least(word), (word, pieces)


def test_profiles_are_few_and_closed():
    known, tables = profiles()
    assert known[0] == END and len(known) < 200
    assert all(len(t) == len(known) and t.max() < len(known) for t in tables.values())


def test_query_equals_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), sf_dir, op11_repair, OP11_SQL) > 0


def rough_rows():
    """Nulls, repeats, equal turns, unknown and empty roles, blanks and a very long text."""
    rng = random.Random(5)
    rows = [(None, None, None, None), (None, 1, "user", "hi."), (None, None, "user", "hi."),
            (1, 5, "assistant", "So.\x0b "), (1, 5, "assistant", "So.\x0b "), (1, None, "", "x"),
            (2, 0, "user", "w. " * 100_000), (2, 1, "assistant", "\x0c \t"), (3, 0, "tool", "é")]
    roles = ["system", "user", "assistant", "tool", "", "User", None]
    texts = ["a.", "b!", "b", "", " ", None, "c?\n", "é. ½"]
    for conv in range(10, 60):
        rows += [(conv, rng.choice([*range(9), None]), rng.choice(roles), rng.choice(texts))
                 for _ in range(rng.randint(1, 12))]
    # One conversation with a third of all rows, one that repeats a single row.
    rows += [(7, t, rng.choice(roles), rng.choice(["a.", f"t{t}.", f"t{t}", f"t{t}!"]))
             for t in range(300)]
    rows += [(8, 0, "user", "same.")] * 90
    return [(*r, "x", 0) for r in rows]


@pytest.mark.parametrize("piece", [256, 7])
def test_rough_conversations_equal_sql(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(repair, "PIECE_ROWS", piece)
    path = str(tmp_path)
    spark.createDataFrame(rough_rows(), SCHEMA).write.parquet(f"{path}/conversations.parquet")
    con = connect("/root/testdata/sf0.001")
    con.execute("CREATE OR REPLACE VIEW conversations AS "
                f"SELECT * FROM '{path}/conversations.parquet/*.parquet'")
    assert compare(spark, con, path, op11_repair, OP11_SQL) == 56


def test_no_group_is_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(repair, "PIECE_ROWS", 20)
    rows = spark.range(500).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), F.col("id").cast("string"), F.lit(".")).alias("text"))
    pieces = repair.edited_pieces(rows).select(F.size("rows").alias("n")).collect()
    assert max(r.n for r in pieces) <= 20 and sum(r.n for r in pieces) == 500
    assert audit_conversations(rows).first().audit == "K" * 500


def test_repaired_rows_follow_the_pattern(spark):
    rows = spark.createDataFrame(rough_rows(), SCHEMA)
    steps = repair_conversations(rows).where("edit <> 'D'").collect()
    talks = {}
    for s in sorted(steps, key=lambda s: (s.piece, s.step)):
        talks.setdefault(s.conv_id, []).append(s.role[:1])
    assert talks
    for talk in talks.values():
        pairs = talk[1:] if talk[0] == "s" else talk
        assert "".join(pairs) == "ua" * (len(pairs) // 2) and pairs


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(none).count() == 0
    assert audit_conversations(none).count() == 0


def test_fold_of_a_piece_is_a_table():
    known, tables = profiles()
    made = np.arange(len(known))
    for letter in reversed("uab"):
        made = tables[letter][made]
    assert len(made) == len(known)
