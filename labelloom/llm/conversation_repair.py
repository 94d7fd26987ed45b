"""Conversation structure repair: bidirectional Dijkstra over a lattice of edits.

A conversation's rows, in order of turn, are to read as an optional system turn and then
pairs of user and assistant turns, or as nothing at all. Edits: Keep (free), Rerole to user or
assistant (3), Delete (4, the only one for blank rows and repetitions), Insert an empty user or
assistant turn anywhere (3); a truncated row that is not deleted adds 3. The answer is the
cheapest sequence of edits, and of these the one whose initials, in order, are ASCII-least.

The lattice has a node for each number of rows done and each state of the pattern (nothing
yet, after system, after user, after assistant). An edge is one row's edit with the inserts
before it. No edge's initials start another's from the same node, so audits are compared edge
by edge, and the least audit of a node is the least of its edges' and its neighbours' audits.
A forward heap grows from the first node, a reverse one from the last, always the cheaper.
They stop when their costs together exceed the best crossing; all crossings of that cost are
then at hand, and the one with the least concatenated audit is taken.

A conversation is searched in pieces of at most ``PIECE_ROWS`` rows, which no task exceeds
however long it is. Nearly all are one piece. Of a longer one, what follows a piece matters
only by what it costs from each of the four states and by how the four least audits compare: a
*profile*. Few profiles exist, so each piece first states which profile each profile becomes;
chaining these from the end gives every piece its own, which seeds its reverse heap; chaining
the pieces' ends from the start gives every piece its first state.

Defined results: rows are taken by turn (nulls first), rows of one turn by role, then text.
Null roles and texts are one blank; a null ``conv_id`` is a conversation like any other.
Equal rows are repetitions of each other, counted before they are shuffled. A role's first
character is its initial; empty roles have none. Very long texts pass through unread but for
their ends, and one piece's texts are held at once. Empty tables give empty results; columns
other than the four are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.deploy import ship_package
from labelloom.llm.plain_sql import CRC32
from labelloom.llm.shared import read_table, small_enough, written

PIECE_ROWS = 256
BROADCAST_ROWS = 100_000
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
#: Next state after a turn of the role, by state; -1 where the pattern does not allow it.
STEP = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
ROLES = {"u": "user", "a": "assistant"}
#: A row is a letter: its role's initial (o: other), upper case if truncated, or its fault.
BLANK, AGAIN, OTHER = "b", "d", "o"
LETTERS = "suaoSUAObd"
#: Audit initials of edits: K, D, rerole to U(ser) or A(ssistant), insert u(ser) or a(ssistant).
AUDIT = str.maketrans("UAua", "RRII")


# -- the lattice --------------------------------------------------------------------


def _inserts(state: int) -> list[tuple[int, str]]:
    """States to be had by inserts alone, with the inserts; a cycle never pays."""
    found, at = [(state, "")], 0
    while at < len(found):
        here, edits = found[at]
        for role in "ua":
            there = STEP[role][here]
            if there > 0 and all(there != known for known, _ in found):
                found.append((there, edits + role))
        at += 1
    return found


def _edges(letter: str) -> list[list[tuple[int, int, str, str]]]:
    """By state: (next state, cost, audit, edits) of one row's edit and the inserts before it."""
    out = []
    for state in range(4):
        edges = []
        for here, inserted in _inserts(state):
            options = [(here, DELETE, "D")]
            if letter not in (BLANK, AGAIN):
                more = UNFINISHED if letter.isupper() else 0
                options += [(STEP[r][here], REROLE + more, r.upper()) for r in "ua"]
                options += [(STEP.get(letter.lower(), (-1,) * 4)[here], KEEP + more, "K")]
            edges += [
                (there, INSERT * len(inserted) + cost, (inserted + edit).translate(AUDIT),
                 inserted + edit)
                for there, cost, edit in options if there >= 0
            ]
        out.append(edges)
    return out


FORWARD = {letter: _edges(letter) for letter in LETTERS}
REVERSE = {
    letter: [
        [(state, *edge[1:]) for state in range(4) for edge in FORWARD[letter][state]
         if edge[0] == there]
        for there in range(4)
    ]
    for letter in LETTERS
}
#: Edits that end a conversation in each state.
LAST = ["", "ua", "a", ""]

#: What follows a piece: by state, the cost (the least is 0) and the place of the least audit.
Profile = tuple[tuple[int, ...], tuple[int, ...]]


def _profile(costs: list[int], audits: list) -> Profile:
    order = sorted(set(audits))
    return (
        tuple(c - min(costs) for c in costs), tuple(order.index(audit) for audit in audits)
    )


END = _profile([INSERT * len(e) for e in LAST], [e.translate(AUDIT) for e in LAST])


def profile_before(letter: str, after: Profile) -> Profile:
    """The profile before a row, from the one behind it."""
    best = [
        min((cost + after[0][there], audit, after[1][there])
            for there, cost, audit, _ in FORWARD[letter][state])
        for state in range(4)
    ]
    return _profile([b[0] for b in best], [b[1:] for b in best])


@lru_cache(maxsize=1)
def profiles() -> tuple[list[Profile], dict[str, np.ndarray]]:
    """All profiles that rows can lead to, the end's first, and what each letter makes of them."""
    known, numbers, at = [END], {END: 0}, 0
    tables: dict[str, list[int]] = {letter: [] for letter in LETTERS}
    while at < len(known):
        for letter in LETTERS:
            made = profile_before(letter, known[at])
            if made not in numbers:
                numbers[made] = len(known)
                known.append(made)
            tables[letter].append(numbers[made])
        at += 1
    return known, {letter: np.array(t) for letter, t in tables.items()}


@lru_cache(maxsize=20_000)
def cheapest(rows: str, first: int, after: Profile) -> tuple[str, int]:
    """The edits of a piece and the state they end in, by search from both sides.

    Heaps hold (cost, rows done, audit, state, ...). An edge adds to one of the first two, so a
    node leaves its heap with its least cost and, among paths of that cost, its least audit. A
    reverse audit ends with the place of what follows the piece.
    """
    n = len(rows)
    ahead: list[tuple] = [(0, 0, "", first, "")]
    behind: list[tuple] = [
        (cost, 0, chr(ord("0") + place), state, "", state)
        for state, (cost, place) in enumerate(zip(*after, strict=True))
    ]
    heapify(behind)
    reached: dict[tuple[int, int], tuple] = {}
    leaving: dict[tuple[int, int], tuple] = {}
    best, crossing = math.inf, ("", "", 0)

    def cross(cost: int, audit: str, edits: str, last: int) -> None:
        nonlocal best, crossing
        if (cost, audit) < (best, crossing[0]):
            best, crossing = cost, (audit, edits, last)

    while ahead and behind and ahead[0][0] + behind[0][0] <= best:
        if ahead[0][0] <= behind[0][0]:
            cost, done, audit, state, edits = heappop(ahead)
            if (done, state) in reached:
                continue
            reached[done, state] = cost, audit, edits
            if done == n:
                cross(cost + after[0][state], audit + chr(ord("0") + after[1][state]), edits,
                      state)
                continue
            for there, price, label, made in FORWARD[rows[done]][state]:
                if (done + 1, there) not in reached:
                    heappush(ahead, (cost + price, done + 1, audit + label, there, edits + made))
                if (done + 1, there) in leaving:
                    rest = leaving[done + 1, there]
                    cross(cost + price + rest[0], audit + label + rest[1],
                          edits + made + rest[2], rest[3])
        else:
            cost, left, audit, state, edits, last = heappop(behind)
            done = n - left
            if (done, state) in leaving:
                continue
            leaving[done, state] = cost, audit, edits, last
            if not done:
                continue
            for there, price, label, made in REVERSE[rows[done - 1]][state]:
                if (done - 1, there) not in leaving:
                    heappush(behind, (cost + price, left + 1, label + audit, there, made + edits,
                                      last))
                if (done - 1, there) in reached:
                    start = reached[done - 1, there]
                    cross(start[0] + price + cost, start[1] + label + audit,
                          start[2] + made + edits, last)
    return crossing[1], crossing[2]


def price(rows: str, edits: str) -> int:
    """What edits cost on the rows they are for."""
    total, at = 0, 0
    for edit in edits:
        if edit in "ua":
            total += INSERT
            continue
        if edit == "D":
            total += DELETE
        else:
            total += (KEEP if edit == "K" else REROLE) + UNFINISHED * rows[at].isupper()
        at += 1
    return total


EDITS_TYPE = T.StructType(
    [T.StructField("edits", T.StringType()), T.StructField("cost", T.LongType())])


# -- rows and pieces ----------------------------------------------------------------


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """An equality join in which nulls are equal; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({key: f"{key}_r" for key in keys})
    on = [F.col(key).eqNullSafe(F.col(f"{key}_r")) for key in keys]
    return left.join(renamed, on, how).drop(*(f"{key}_r" for key in keys))


def faulty_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copy, letter``: every row and the letter that tells it.

    Equal rows are counted before anything else. A row repeats an earlier one if its role and
    text have a lesser turn; only what is said in several turns is looked up.
    """
    said = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    rows = (
        conversations.select(
            "conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
        .groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
        .withColumn("said", said)
    )
    rows = written(rows, "conversation-rows")
    repeated = (
        rows.groupBy("conv_id", "said")
        .agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns"))
        .where("turns > 1").drop("turns")
    )
    rows = _same(rows, small_enough(written(repeated, "repeated-turns"), BROADCAST_ROWS),
                 ["conv_id", "said"], "left")
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first")["turn"])
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(OTHER)
    return rows.select(
        "conv_id", "turn", "role", "text", "first",
        F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"),
    ).select(
        "conv_id", "turn", "role", "text", "copy",
        F.when(end == "", BLANK).when(later | (F.col("copy") > 1), AGAIN)
        .when(F.right(end, F.lit(1)).isin(".", "!", "?"), letter).otherwise(F.upper(letter))
        .alias("letter"),
    )


def _held(rows: DataFrame) -> DataFrame:
    held = rows.groupBy("conv_id", "piece").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "copy", "letter")))
        .alias("rows"))
    letters = F.array_join(F.transform("rows", lambda r: r["letter"]), "")
    return held.withColumn("letters", letters)


def pieces_of(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``conv_id, piece, rows, letters``: conversations of one piece, and pieces of others.

    Rows of long conversations are range-sorted over all tasks, and cut by count inside each.
    """
    rows = written(rows, "faulty-rows")
    long = written(
        rows.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > PIECE_ROWS)
        .select("conv_id", F.lit(True).alias("long")), "long-conversations")
    whole = F.lit(0).cast("long")
    if long.limit(1).count() == 0:
        return _held(rows.withColumn("piece", whole)), None
    marked = _same(rows, small_enough(long, BROADCAST_ROWS), ["conv_id"], "left")
    order = ["conv_id", "turn", "role", "text", "copy"]
    placed = (
        marked.where("long").drop("long").repartitionByRange(*order)
        .sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    )
    within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    piece = F.col("at") - within % F.lit(PIECE_ROWS)
    return (
        _held(marked.where("long IS NULL").drop("long").withColumn("piece", whole)),
        _held(placed.withColumn("piece", piece).drop("at")),
    )


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def becomes(letters: pd.Series) -> pd.Series:
    """Which profile each profile becomes before a piece."""
    known, tables = profiles()

    def fold(word: str) -> np.ndarray:
        made = np.arange(len(known))
        for letter in reversed(word):
            made = tables[letter][made]
        return made.astype(np.int32)

    return letters.map(fold)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def ends(letters: pd.Series, after: pd.Series) -> pd.Series:
    """The state a piece ends in, by the one it begins with."""
    known, _ = profiles()
    return pd.Series([
        np.array([cheapest(word, first, known[a])[1] for first in range(4)], np.int32)
        for word, a in zip(letters, after, strict=True)
    ])


@F.pandas_udf(EDITS_TYPE)
def edits_of(letters: pd.Series, first: pd.Series, after: pd.Series, last: pd.Series
             ) -> pd.DataFrame:
    known, _ = profiles()
    out = []
    for word, begin, a, final in zip(letters, first, after, last, strict=True):
        edits, end = cheapest(word, int(begin), known[a])
        edits += LAST[end] if final else ""
        out.append((edits, price(word, edits)))
    return pd.DataFrame(out, columns=["edits", "cost"])


def _chain(id_type: str, column: str, backwards: bool):
    """Per conversation: pass a number along its pieces, each giving the next one's."""
    name = "after" if backwards else "first"
    fields = [f"conv_id {id_type}", "piece long", f"{name} int"]
    if backwards:
        fields.append("last boolean")

    def chain(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("piece", ascending=not backwards)
        now, out = 0, []
        for step in part[column]:
            out.append(now)
            now = int(step[now])
        made = part[["conv_id", "piece"]].assign(**{name: out})
        return made.assign(last=np.arange(len(made)) == 0) if backwards else made

    return chain, ", ".join(fields)


def _with_edits(pieces: DataFrame) -> DataFrame:
    edited = pieces.withColumn("e", edits_of("letters", "first", "after", "last"))
    return edited.select(
        "conv_id", "piece", "rows", "letters", F.col("e.edits").alias("edits"),
        F.col("e.cost").alias("cost"))


def with_edits(single: DataFrame, long: DataFrame | None) -> DataFrame:
    """All pieces with ``edits`` and their ``cost``; only long conversations are chained."""
    edited = _with_edits(
        single.withColumns({"first": F.lit(0), "after": F.lit(0), "last": F.lit(True)}))
    if long is None:
        return edited
    pieces = written(long, "conversation-pieces")
    keys = ["conv_id", "piece"]
    kind = dict(pieces.dtypes)["conv_id"]
    back, made = _chain(kind, "becomes", True)
    after = written(
        pieces.select(*keys, becomes("letters").alias("becomes")).groupBy("conv_id")
        .applyInPandas(back, made), "what-follows")
    onward, made = _chain(kind, "ends", False)
    first = (
        _same(pieces.select(*keys, "letters"), after, keys, "inner")
        .select(*keys, ends("letters", "after").alias("ends")).groupBy("conv_id")
        .applyInPandas(onward, made)
    )
    placed = _same(_same(pieces, after, keys, "inner"), first, keys, "inner")
    return edited.unionByName(_with_edits(placed))


def edited_pieces(conversations: DataFrame) -> DataFrame:
    """``conv_id, piece, rows, letters, edits, cost, steps``; pieces in order of number.

    ``steps`` has an entry for each edit: its initial, turn, repaired role and text.
    """
    ship_package(conversations.sparkSession)
    pieces = with_edits(*pieces_of(faulty_rows(conversations)))

    def step(i):
        edit = F.substring("edits", i, 1)
        done = F.length(F.regexp_replace(F.substring("edits", F.lit(1), i), "[ua]", ""))
        row = F.get("rows", done - 1)
        made = edit.isin("u", "a")
        role = F.when(F.lower(edit) == "u", ROLES["u"]).when(F.lower(edit) == "a", ROLES["a"])
        return F.struct(
            F.translate(edit, "UAua", "RRII").alias("edit"),
            F.when(~made, row["turn"]).alias("turn"),
            F.when(edit.isin("K", "D"), row["role"]).otherwise(role).alias("role"),
            F.when(made, "").otherwise(row["text"]).alias("text"),
        )

    return pieces.withColumn("steps", F.transform(F.sequence(F.lit(1), F.length("edits")), step))


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id, piece, step, edit, turn, role, text``: every edit, in order of piece and step.

    Without the rows whose ``edit`` is ``D``, conversations are as the pattern wants them.
    """
    return edited_pieces(conversations).select(
        "conv_id", "piece", F.posexplode("steps").alias("step", "s")
    ).select("conv_id", "piece", "step", "s.*")


# -- the query ----------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in, by a checksum of conversation and turn."""
    blank = F.lit(" ")
    rows = conversations.select(
        "conv_id", "turn", *(F.coalesce(c, blank).alias(c) for c in ("role", "text")))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), blank))
    fault = F.crc32(name.cast("binary")) % 20
    return rows.withColumn("fault_", fault).where("fault_ <> 0").select(
        "conv_id", "turn",
        F.when(F.col("fault_") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault_") == 1, "")
        .when(F.col("fault_") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault_") == 3, 2).otherwise(1)))
        .alias("copy_"),
    ).drop("copy_")


def _digests(id_field: pa.DataType):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(conv_id, lines), in order, to a digest for each conversation; lines go by."""
        def row(conv, digest):
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], id_field), pa.array([digest.hexdigest()])],
                names=["conv_id", "repaired_sha256"])

        now, whole, empty = (), None, True
        for batch in batches:
            for conv, lines in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if now != (conv,):
                    if now:
                        yield row(now[0], whole)
                    now, whole, empty = (conv,), hashlib.sha256(), True
                if lines.is_valid:
                    whole.update(b"" if empty else b"\n")
                    whole.update(lines.as_py().encode())
                    empty = False
        if now:
            yield row(now[0], whole)

    return digest


def audit_conversations(conversations: DataFrame) -> DataFrame:
    """Per conversation: counts of faults, the cost and audit of its repair, and a digest."""
    pieces = edited_pieces(conversations)
    kept = F.filter("steps", lambda s: s["edit"] != "D")
    initials = F.array_join(F.transform("rows", lambda r: F.when(
        r["role"] == "", " ").otherwise(F.substring(r["role"], 1, 1))), "")
    legal = lambda pair: pair.isin("su", "ua", "au")
    count = lambda letters: F.length(F.regexp_replace("letters", f"[^{letters}]", ""))
    facts = written(pieces.select(
        "conv_id", "piece", "cost",
        count(BLANK).alias("blank"), count(AGAIN).alias("duplicate"),
        count("SUAO").alias("truncated"), initials.alias("initials"),
        F.array_join(F.transform("steps", lambda s: s["edit"]), "").alias("audit"),
        F.when(F.size(kept) > 0, F.array_join(F.transform(
            kept, lambda s: F.concat(s["role"], F.lit(":"), s["text"])), "\n")).alias("lines"),
    ), "edited-conversations")
    inside = F.size(F.filter(
        F.sequence(F.lit(1), F.length("initials") - 1),
        lambda i: ~legal(F.substring("initials", i, 2))))
    inside = F.when(F.length("initials") > 1, inside).otherwise(0)
    sums = facts.groupBy("conv_id").agg(
        *(F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "cost")),
        F.sum(inside).cast("long").alias("illegal"),
        F.sort_array(F.collect_list(F.struct(
            "piece", "audit", F.substring("initials", 1, 1).alias("first"),
            F.right("initials", F.lit(1)).alias("last")))).alias("pieces"),
    )
    seams = F.size(F.filter(
        F.sequence(F.lit(2), F.size("pieces")),
        lambda i: ~legal(F.concat(F.element_at("pieces", i - 1)["last"],
                                  F.element_at("pieces", i)["first"]))))
    sums = sums.select(
        "conv_id", "blank", "duplicate", "truncated", "cost",
        (F.col("illegal") + F.when(F.size("pieces") > 1, seams).otherwise(0)).alias("illegal"),
        F.array_join(F.transform("pieces", lambda p: p["audit"]), "").alias("audit"),
    )
    kind = dict(facts.dtypes)["conv_id"]
    id_field = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    named = "conv_id" if kind in ("bigint", "int") else F.col("conv_id").cast("string")
    digests = (
        facts.select(named, "piece", "lines").repartition("conv_id")
        .sortWithinPartitions("conv_id", "piece").select("conv_id", "lines")
        .mapInArrow(_digests(id_field), f"conv_id {kind if named == 'conv_id' else 'string'}, "
                                        "repaired_sha256 string")
        .withColumn("conv_id", F.col("conv_id").cast(kind))
    )
    return _same(sums, digests, ["conv_id"], "inner")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    rows = damaged(conversations)
    none = F.lit(0).cast("long")
    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = rows.groupBy("conv_id").agg(F.coalesce(turns, none).cast("long").alias("gaps"))
    found = _same(gaps, audit_conversations(rows), ["conv_id"], "inner")
    whole = _same(conversations.select("conv_id").distinct(), found, ["conv_id"], "left")
    return whole.select(
        "conv_id",
        *(F.coalesce(c, none).alias(c)
          for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))
        .alias("repaired_sha256"),
    )


#: All least repairs, row by row from the end.
OP11_SQL = f"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k,
         dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c
  FROM conversations
), marked AS (
  SELECT *, {CRC32.format("k")} % 20 AS fault FROM named
), damaged AS (
  SELECT c, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
         ELSE text END AS text,
         unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM marked
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
  FROM damaged
), repeated AS (
  SELECT *, i > min(i) OVER (PARTITION BY c, role, text) AS again FROM placed
), judged AS (
  SELECT *, substring(role, 1, 1) AS initial, last = '' AS blank, last <> '' AND again AS duplicate,
         last <> '' AND NOT again AND last NOT IN ('.', '!', '?') AS truncated,
         substring(lag(role) OVER (PARTITION BY c ORDER BY i), 1, 1) || substring(role, 1, 1)
           AS pair
  FROM repeated
), counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count_if(blank)::BIGINT AS blank, count_if(duplicate)::BIGINT AS duplicate,
         count_if(truncated)::BIGINT AS truncated,
         count_if(pair NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal, max(i) AS n
  FROM judged GROUP BY c
), step(a, r, b) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), inserts(a, b, audit, said) AS (
  VALUES (0, 0, '', []), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []),
         (0, 2, 'I', ['user:']), (1, 2, 'I', ['user:']), (3, 2, 'I', ['user:']),
         (2, 3, 'I', ['assistant:']), (0, 3, 'II', ['user:', 'assistant:']),
         (1, 3, 'II', ['user:', 'assistant:'])
), edits AS (
  SELECT c, i, a, a AS b, 4 AS cost, 'D' AS audit, []::VARCHAR[] AS said
  FROM judged, (SELECT unnest(range(4))::INT AS a)
  UNION ALL
  SELECT c, i, a, b, CASE WHEN truncated THEN 3 ELSE 0 END, 'K', [role || ':' || text]
  FROM judged JOIN step ON r = initial WHERE NOT blank AND NOT duplicate
  UNION ALL
  SELECT c, i, a, b, CASE WHEN truncated THEN 6 ELSE 3 END, 'R',
         [CASE r WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text]
  FROM judged JOIN step ON r IN ('u', 'a') WHERE NOT blank AND NOT duplicate
), edges AS (
  SELECT c, i, inserts.a, edits.b, 3 * length(inserts.audit) + cost AS cost,
         inserts.audit || edits.audit AS audit, list_concat(inserts.said, edits.said) AS said
  FROM edits JOIN inserts ON inserts.b = edits.a
), least AS (
  SELECT c, n + 1 AS i, s.a, {{'cost': s.cost, 'audit': s.audit, 'said': s.said}} AS best
  FROM counts, (VALUES (0, 0, '', []), (1, 6, 'II', ['user:', 'assistant:']),
                       (2, 3, 'I', ['assistant:']), (3, 0, '', [])) AS s(a, cost, audit, said)
  UNION ALL
  SELECT edges.c, edges.i, edges.a, min({{'cost': edges.cost + best.cost,
         'audit': edges.audit || best.audit, 'said': list_concat(edges.said, best.said)}})
  FROM least JOIN edges ON edges.c = least.c AND edges.i = least.i - 1 AND edges.b = least.a
  GROUP BY edges.c, edges.i, edges.a
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit,
  sha256(coalesce(array_to_string(best.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM named)
LEFT JOIN counts USING (c) LEFT JOIN (SELECT c, best FROM least WHERE i = 1 AND a = 0) USING (c)
"""
