"""Preference pairs: the common turns once as prompt, the rest as two masked completions.

Both sides of a pair are conversations. Their longest common prefix of turns (same role, same
text) is rendered once; what follows on each side is rendered as its completion. A
completion comes with the spans that carry loss, in characters of prompt plus completion:
what the assistant says, with the mark that ends it. All else is masked.

Defined results: turns are ordered by turn number, then role, then text, nulls first; a
repeated turn stays. A null role is rendered as ``unknown``, a null text as empty, and both
equal their like only. A pair that has one side only gets an empty completion for the other
one. Equal sides share all turns and have two empty completions. The opening of a mark
inside a text or a role is broken by a blank, and so is the closing of one and a line feed in
a role, so that neither can pose as turns. Texts of any length are rendered whole. Null pair
ids form one pair. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions.binding import bind
from labelloom.llm.shared import read_table

OPENING, CLOSING, END = "<|", "|>\n", "<|end|>\n"


def _header(turn: Column) -> Column:
    role = F.coalesce(turn["role"], F.lit("unknown"))
    for mark, harmless in ((OPENING, "< |"), (CLOSING.strip(), "| >"), ("\n", " ")):
        role = F.replace(role, F.lit(mark), F.lit(harmless))
    return F.concat(F.lit(OPENING), role, F.lit(CLOSING))


def _body(turn: Column) -> Column:
    text = F.replace(F.coalesce(turn["text"], F.lit("")), F.lit(OPENING), F.lit("< |"))
    return F.concat(text, F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def loss_spans(turns: Column, start: Column) -> Column:
    """Spans ``start:end`` of what the assistant says, joined by commas."""

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_header(turn))
        end = begin + F.length(_body(turn))
        span = F.concat_ws(":", begin.cast("string"), end.cast("string"))
        spoken = turn["role"].eqNullSafe(F.lit("assistant"))
        return F.struct(
            end.alias("at"),
            F.when(spoken, F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"]).alias("spans"),
        )

    zero = F.struct(
        start.cast("int").alias("at"), F.array().cast("array<string>").alias("spans")
    )
    return F.aggregate(turns, zero, step, lambda s: F.array_join(s["spans"], ","))


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Formatted pairs from two tables of ``pair_id``, ``turn``, ``role``, ``text``."""
    columns = ["pair_id", "turn", "role", "text"]
    sides = chosen.select(*columns, F.lit(True).alias("good")).unionByName(
        rejected.select(*columns, F.lit(False).alias("good"))
    )
    said = F.struct("turn", "role", "text")
    paired = sides.groupBy("pair_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("good"), said))).alias("good"),
        F.sort_array(F.collect_list(F.when(~F.col("good"), said))).alias("bad"),
    )
    same = F.zip_with(
        "good", "bad",
        lambda a, b: a.isNotNull() & b.isNotNull()
        & a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]),
    )
    first = F.array_position(same, F.lit(False))
    paired = bind(
        paired, "n_common", F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")
    )
    tail = lambda side: F.slice(side, F.col("n_common") + 1, F.size(side) + 1)
    paired = bind(paired, "prompt", render(F.slice("good", 1, F.col("n_common"))))
    start = F.length("prompt")
    return paired.select(
        "pair_id", "n_common", "prompt",
        render(tail("good")).alias("chosen"), render(tail("bad")).alias("rejected"),
        loss_spans(tail("good"), start).alias("chosen_loss"),
        loss_spans(tail("bad"), start).alias("rejected_loss"),
    )


def borrowed_replies(turns: DataFrame) -> DataFrame:
    """A rejected side for every conversation: its last reply replaced by a neighbour's.

    ``turns`` has conv_id, turn, role, text. The neighbour is the conversation with the next
    id, or else the one before. Without a reply of its own a conversation stays as it is;
    without a neighbour's it ends before its last reply.
    """
    reply = F.when(F.col("role") == "assistant", F.struct("turn", "role", "text"))
    last = turns.groupBy("conv_id").agg(F.max(reply).alias("reply"))
    told = last.select(
        "conv_id",
        F.explode(F.array(F.col("conv_id") - 1, F.col("conv_id") + 1)).alias("to"),
        F.col("reply.text").alias("given"),
        F.col("reply").isNotNull().alias("has"),
    ).where("has").groupBy("to").agg(F.max_by("given", "conv_id").alias("given"))
    ends = last.alias("l").join(told.alias("t"), F.col("l.conv_id") == F.col("t.to"), "left").select(
        "l.conv_id", "l.reply", "t.given", F.col("t.to").isNotNull().alias("lent")
    )
    before = turns.alias("c").join(
        ends.alias("e"), F.col("c.conv_id").eqNullSafe(F.col("e.conv_id"))
    ).where(
        F.col("e.reply").isNull() | (F.struct("c.turn", "c.role", "c.text") < F.col("e.reply"))
    ).select("c.conv_id", "c.turn", "c.role", "c.text")
    lent = ends.where(F.col("reply").isNotNull() & F.col("lent")).select(
        "conv_id", "reply.turn", "reply.role", F.col("given").alias("text")
    )
    return before.unionByName(lent)


def op4_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return preference_pairs(
        turns.withColumnRenamed("conv_id", "pair_id"),
        borrowed_replies(turns).withColumnRenamed("conv_id", "pair_id"),
    )


#: The same with one row for each turn.
OP4_SQL = """
WITH replies AS (
  SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) = 1
), told AS (
  SELECT conv_id + s AS conv_id, max_by(text, conv_id) AS given
  FROM replies, (VALUES (-1), (1)) AS steps(s) GROUP BY 1
), rejected AS (
  SELECT c.conv_id, c.turn, c.role, c.text FROM conversations c LEFT JOIN replies r USING (conv_id)
  WHERE r.conv_id IS NULL OR c.turn < r.turn
  UNION ALL
  SELECT conv_id, turn, 'assistant', given FROM replies JOIN told USING (conv_id)
), placed AS (
  SELECT true AS good, *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n
  FROM conversations
  UNION ALL
  SELECT false, *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n
  FROM rejected
), lengths AS (
  SELECT conv_id, n, count(*) = 2 AND min(role) = max(role) AND min(text) = max(text) AS same
  FROM placed GROUP BY conv_id, n
), prefixes AS (
  SELECT conv_id, coalesce(min(n) FILTER (NOT same) - 1, max(n)) AS common
  FROM lengths GROUP BY conv_id
), rendered AS (
  SELECT p.*, common, '<|' || role || '|>' || chr(10) AS head,
         replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM placed p JOIN prefixes USING (conv_id)
), spans AS (
  SELECT *, sum(length(head) + length(body)) OVER
           (PARTITION BY conv_id, good ORDER BY n ROWS UNBOUNDED PRECEDING) AS e
  FROM rendered
)
SELECT conv_id AS pair_id, common::INT AS n_common,
  coalesce(string_agg(head || body, '' ORDER BY n) FILTER (good AND n <= common), '') AS prompt,
  coalesce(string_agg(head || body, '' ORDER BY n) FILTER (good AND n > common), '') AS chosen,
  coalesce(string_agg(head || body, '' ORDER BY n) FILTER (NOT good AND n > common), '')
    AS rejected,
  coalesce(string_agg((e - length(body)) || ':' || e, ',' ORDER BY n)
    FILTER (good AND n > common AND role = 'assistant'), '') AS chosen_loss,
  coalesce(string_agg((e - length(body)) || ':' || e, ',' ORDER BY n)
    FILTER (NOT good AND n > common AND role = 'assistant'), '') AS rejected_loss
FROM spans GROUP BY conv_id, common
"""
