import random

import pytest
from pyspark.sql import functions as F

from labelloom.fixed_values import SYSTEM_PROMPT, TRUNCATION_MARK
from labelloom.functions.prompts import (
    EMPTY_PROMPT_CHARS,
    chat_messages,
    char_budget_limit,
    fits_context,
    truncate_content,
    user_prompt,
)
from labelloom.operators.token_budget import (
    CharCounter,
    ModelCounter,
    chat,
    chat_template_counter,
    longest_fits,
)
from labelloom.plans.attempts import bounded_prompts, retry_bounds
from labelloom.settings import Settings

SETTINGS = Settings("lab/annotator-1")


def char_count(messages):
    return sum(len(message["content"]) for message in messages)


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, text string")


def test_budgets():
    assert SETTINGS.input_budget(1) == 7_424
    assert SETTINGS.input_budget(2) == 6_912
    assert SETTINGS.model_slug == "lab--annotator-1"


def test_truncation(spark):
    df = texts(spark, "sand dunes", "sand", "", "🌊🌊🌊🌊🌊", None)
    got = [r[0] for r in df.orderBy("id").select(truncate_content(F.col("text"), 4)).collect()]
    assert got == ["sand\n<truncated_content>", "sand", "", "🌊🌊🌊🌊\n<truncated_content>", None]


@pytest.mark.parametrize("text", ["{content} {0} %s %d", "a\nb", "😀é", ""])
def test_prompt_holds_the_text_verbatim(spark, text):
    row = texts(spark, text).select(chat_messages(F.col("text")).alias("m")).first()
    user = f"<start_of_document>\n{text}\n<end_of_document>\n"
    assert [tuple(m) for m in row["m"]] == [("system", SYSTEM_PROMPT), ("user", user)]
    assert chat(user) == [m.asDict() for m in row["m"]]


def test_fits_context_at_its_edges(spark):
    df = spark.createDataFrame([(7100,), (7424,), (7425,), (9000,), (6912,), (6913,)], "n int")
    rows = df.select(
        "n", fits_context(F.col("n"), SETTINGS, 1), fits_context(F.col("n"), SETTINGS, 2)
    ).collect()
    assert {n: (first, second) for n, first, second in rows} == {
        7100: (True, False), 7424: (True, False), 7425: (False, False), 9000: (False, False),
        6912: (True, True), 6913: (True, False),
    }


def test_budget_of_a_long_text(spark):
    bound = CharCounter().bound(F.col("text"), F.length("text"), EMPTY_PROMPT_CHARS + 333)
    row = texts(spark, "tide " * 144).select(bound.alias("b")).first()["b"]
    assert row.asDict() == {
        "char_limit": 313, "prompt_tokens": EMPTY_PROMPT_CHARS + 333, "over_budget": False,
    }


def test_budget_below_the_empty_prompt(spark):
    bound = CharCounter().bound(F.col("text"), F.length("text"), 100)
    rows = texts(spark, "abc", "", None).orderBy("id").select(
        bound.alias("b"), user_prompt(F.col("text"), bound["char_limit"]).alias("p")
    ).collect()
    assert rows[0]["b"]["char_limit"] == 0 and rows[0]["b"]["over_budget"]
    assert TRUNCATION_MARK in rows[0]["p"]
    assert rows[1]["b"]["over_budget"] and TRUNCATION_MARK not in rows[1]["p"]
    assert rows[2]["b"] is None and rows[2]["p"] is None


def test_closed_form_equals_the_search(spark):
    rng = random.Random(3)
    df = texts(spark, *["x" * rng.randrange(0, 120) for _ in range(2_000)])
    for budget, cap in [(-20, 30), (0, 50), (15, 100), (20, 0), (21, 40), (60, 61), (200, 70)]:
        limit = char_budget_limit(F.length("text"), EMPTY_PROMPT_CHARS + budget, cap)
        for text, n in df.select("text", limit).collect():
            limits, _ = longest_fits([text], EMPTY_PROMPT_CHARS + budget, cap, char_count)
            assert n == limits[0]


def test_model_counter_equals_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id as id", "text")
    docs = docs.unionByName(texts(spark, "", None))
    counter = ModelCounter(lambda: lambda messages: sum(len(m["content"]) for m in messages))
    for attempt in (1, 2):
        plain = bounded_prompts(docs, CharCounter(), SETTINGS, attempt).drop("text")
        counted = bounded_prompts(docs, counter, SETTINGS, attempt).drop("text")
        assert sorted(map(str, plain.collect())) == sorted(map(str, counted.collect()))
    plain, counted = (
        retry_bounds(bounded_prompts(docs, c, SETTINGS), c, SETTINGS).drop("text")
        for c in (CharCounter(), counter)
    )
    assert sorted(map(str, plain.collect())) == sorted(map(str, counted.collect()))


# What fits of a text of ten characters, the lengths probed, the result.
PROBES = [
    ({10}, [10], 10),
    ({0, 1, 2, 3, 4, 5, 6}, [10, 5, 8, 6, 7], 6),
    ({2}, [10, 5, 2, 3], 2),
    ({0, 9}, [10, 5, 2, 0, 1], 0),
    ({5, 8, 9}, [10, 5, 8, 9, 10], 9),
    (set(), [10, 5, 2, 0], 0),
]


@pytest.mark.parametrize(("fitting", "probes", "limit"), PROBES)
def test_probes_decide_when_counts_are_not_monotone(fitting, probes, limit):
    seen = []

    def count(messages):
        content = messages[1]["content"]
        n = content.count("x")
        assert (TRUNCATION_MARK in content) == (n < 10)
        seen.append(n)
        return 1 if n in fitting else 7

    limits, tokens = longest_fits(["x" * 10], 3, 50, count)
    assert (seen, limits.tolist()) == (probes, [limit])
    assert tokens.tolist() == [1 if limit in fitting else 7]


def test_texts_are_halved_in_step():
    rounds = []

    def count(messages):
        raise AssertionError("counted one by one")

    def count_many(chats):
        rounds.append(len(chats))
        return [char_count(chat) for chat in chats]

    count.many = count_many
    texts = ["y" * n for n in (0, 7, 300, 60_000, 49_000)]
    limits, _ = longest_fits(texts, EMPTY_PROMPT_CHARS + 120, 50_000, count)
    assert limits.tolist() == [0, 7, 100, 100, 100]
    assert rounds[0] == 5 and rounds[1] == 3 and len(rounds) <= 18


def test_chat_template_adapter():
    class Tokenizer:
        def apply_chat_template(self, conversation, *, add_generation_prompt, tokenize):
            assert add_generation_prompt is True and tokenize is True
            return [0] * char_count(conversation)

    count = chat_template_counter(Tokenizer)()
    assert count(chat("abc")) == len(SYSTEM_PROMPT) + 3


def test_retry_sends_only_unfit_texts_to_the_counter(spark, tmp_path):
    log = str(tmp_path / "counted")

    def factory():
        def count(messages):
            with open(log, "a") as f:
                f.write("x\n")
            return sum(len(m["content"]) for m in messages)

        return count

    df = texts(spark, "a" * 10, "b" * 4_500, "c" * 9_000).coalesce(1)
    first = bounded_prompts(df, CharCounter(), SETTINGS)
    rows = retry_bounds(first, ModelCounter(factory), SETTINGS).collect()
    assert [r["char_limit"] for r in rows] == [10, 4_078, 4_078]
    with open(log) as f:
        assert len(f.readlines()) <= 2 * 18
