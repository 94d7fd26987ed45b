"""Sources mixed to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order, once per allowed repeat. A
document's virtual finish time is its source's words so far divided by the source's target.
The queues are merged by that time, as one global sort would, and cut where the total budget
is spent; each source has then given its target, up to one document.

Order and cut are found without a task that holds a source or the corpus: shuffled positions
and finish times fall into a fixed number of ranges, ranges are summed and added up, and only
rows inside one range are ordered one by one.

Defined results: a null text has size 0; null is a source of its own, ordered last; a source
without words has target 0. Ties in time go to source, repeat and shuffled position. Rows
that repeat a ``doc_id`` are separate documents, told apart by text. An empty table gives an
empty result. The shuffle depends on ids alone, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelloom.llm.shared import fresh, read_table, small_enough, word_count, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
#: Hexadecimal digits of a shuffled position that make its range: 4,096 ranges a source.
RANGE_DIGITS = 3
#: Ranges of finish time up to the budget's end.
TIME_RANGES = 4096
BROADCAST_ROWS = 1_000_000


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, repeats: int
) -> DataFrame:
    """``source``, ``source_size``, ``target`` from rows of (source, size).

    Targets share ``share`` of all words by weight; none is above ``repeats`` times its
    source's size, and what would be is shared anew by weight. In closed form: sources
    ordered by size per weight are capped from the smallest on, until the level that the
    rest of the budget gives the rest of the weights lies below the next cap.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_level = W.orderBy("level", F.col("source").asc_nulls_last())
    upto = by_level.rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn(
            "weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
        )
        .withColumn("cap", F.col("source_size") * repeats)
        .withColumn("level", F.col("cap").cast("double") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("weights_left", F.sum("weight").over(everything) - F.sum("weight").over(upto)
                    + F.col("weight"))
        .withColumn("spent", F.sum("cap").over(upto) - F.col("cap"))
        .withColumn("reached", (F.col("budget") - F.col("spent")) / F.col("weights_left"))
        .withColumn("open", F.when(F.col("reached") <= F.col("level"), F.col("reached")))
        .withColumn("water", F.min_by("open", F.when(F.col("open").isNotNull(), F.struct(
            "level", F.col("source").isNull(), "source"))).over(everything))
    )
    target = F.least(F.col("cap").cast("double"), F.col("water") * F.col("weight"))
    return sources.select(
        "source",
        "source_size",
        "weight",
        F.coalesce(target, F.col("cap").cast("double")).alias("target"),
    )


def fair_queue(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``text_key``, ``source_size``, ``target``, ``copies``,
    ``taken``.

    ``docs`` has doc_id, source and text. ``copies`` says how often the mix takes the
    document, ``taken`` how many of its words.
    """
    sizes = written(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"),
            F.xxhash64("text").alias("text_key"),
        ),
        "mix-sizes",
    )
    targets = written(source_targets(sizes, weights, share, repeats), "mix-targets")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    queued = sizes.select(
        "doc_id",
        "source",
        "size",
        "text_key",
        F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat"),
    ).withColumn(
        "place",
        F.md5(F.concat(F.col("repeat").cast("string"), F.lit(":"), name).cast("binary")),
    ).withColumn("range", F.substring("place", 1, RANGE_DIGITS))

    queue = ["source", "repeat", "range"]
    ahead = (
        W.partitionBy("source")
        .orderBy("repeat", "range")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    starts = (
        queued.groupBy(*queue)
        .agg(F.sum("size").alias("words"))
        .withColumn("start", F.sum("words").over(ahead) - F.col("words"))
        .drop("words")
    )
    inside = (
        W.partitionBy(*queue)
        .orderBy("place", "doc_id", "size", "text_key")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    running = queued.withColumn("run", F.sum("size").over(inside))
    same = [F.col("a.source").eqNullSafe(F.col("b.source"))] + [
        F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("repeat", "range")
    ]
    timed = running.alias("a").join(starts.alias("b"), same).select(
        "a.doc_id", "a.source", "a.size", "a.text_key", "a.repeat", "a.place",
        (F.col("b.start") + F.col("a.run")).alias("words"),
    )
    timed = timed.alias("a").join(
        targets.alias("t"), F.col("a.source").eqNullSafe(F.col("t.source"))
    ).select(
        "a.*", "t.source_size", "t.target",
        F.when(F.col("t.target") > 0, F.col("a.words") / F.col("t.target"))
        .otherwise(F.lit(float("inf"))).alias("finish"),
    )
    timed = written(
        timed.withColumn(
            "slice",
            F.when(F.col("finish") > 2, 2 * TIME_RANGES)
            .otherwise(F.floor(F.col("finish") * TIME_RANGES)).cast("int"),
        ),
        "mix-times",
    )
    # The words up to and before each slice of time: few rows.
    budget = targets.agg(F.sum("target")).first()[0] or 0
    order = W.orderBy("slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    slices = (
        timed.groupBy("slice")
        .agg(F.sum("size").alias("words"))
        .withColumn("budget", F.lit(float(budget)))
        .withColumn("upto", F.sum("words").over(order))
        .select("slice", "budget", "upto", (F.col("upto") - F.col("words")).alias("before"))
    )
    placed = timed.join(F.broadcast(slices), "slice")  # at most 2 * TIME_RANGES + 1 rows
    whole = placed.where(F.col("upto") <= F.col("budget"))
    torn = placed.where(
        (F.col("upto") > F.col("budget")) & (F.col("before") < F.col("budget"))
    )
    line = (
        W.partitionBy("slice")
        .orderBy("finish", F.col("source").asc_nulls_last(), "repeat", "place", "doc_id", "size",
                 "text_key")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    cut = torn.withColumn("sum", F.col("before") + F.sum("size").over(line)).where(
        F.col("sum") <= F.col("budget")
    )
    keys = ["doc_id", "source", "size", "text_key"]
    # A row that repeats id, source and text is the same document again: they share copies.
    taken = (
        whole.select(*keys, "repeat")
        .unionByName(cut.select(*keys, "repeat"))
        .withColumn("took", F.lit(1))
    )
    copies = (
        timed.select(*keys, "repeat")
        .withColumn("took", F.lit(0))
        .unionByName(taken)
        .groupBy(*keys)
        .agg(F.sum("took").alias("took"), F.sum(1 - F.col("took")).alias("offered"))
        .withColumn("rows", (F.col("offered") / repeats).cast("long"))
        .withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
        .withColumn(
            "copies",
            (F.floor(F.col("took") / F.col("rows"))
             + (F.col("row") <= F.col("took") % F.col("rows")).cast("long")).cast("int"),
        )
    )
    return copies.alias("c").join(
        targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))
    ).select(
        "c.doc_id", "c.source", "c.size", "c.text_key", "t.source_size", "t.target", "c.copies",
        (F.col("c.copies") * F.col("c.size")).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix: rows of ``docs`` as often as it takes them."""
    keys = ["doc_id", "source", "text_key"]
    counts = written(
        fair_queue(docs).groupBy(*keys)
        .agg(F.sum("copies").alias("copies_"), F.count("*").alias("rows_")),
        "mix-copies",
    )
    copies, rows, row = (fresh(docs, c) for c in ("copies_", "rows_", "row_"))
    found = docs.alias("d").join(
        small_enough(counts, BROADCAST_ROWS).alias("n"),
        F.col("d.doc_id").eqNullSafe(F.col("n.doc_id"))
        & F.col("d.source").eqNullSafe(F.col("n.source"))
        & (F.xxhash64("d.text") == F.col("n.text_key")),
    ).select("d.*", F.col("n.copies_").alias(copies), F.col("n.rows_").alias(rows))
    found = found.where(F.col(copies) > 0)
    # Rows that are there more than once share the copies of all.
    same = W.partitionBy("doc_id", "source", "text").orderBy(F.lit(1))
    shared = found.where(F.col(rows) > 1).withColumn(row, F.row_number().over(same)).withColumn(
        copies,
        F.floor(F.col(copies) / F.col(rows))
        + (F.col(row) <= F.col(copies) % F.col(rows)).cast("long"),
    ).drop(row).where(F.col(copies) > 0)
    return (
        found.where(F.col(rows) == 1).unionByName(shared)
        .withColumn(row, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
        .drop(copies, rows, row)
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_queue(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


#: The same in SQL, by plain windows over whole queues.
OP10_SQL = """
WITH sizes AS (
  SELECT doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents
), named AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sizes GROUP BY source
), weighed AS (
  SELECT *, [3, 1, 2][((rank - 1) % 3 + 1)::INT] AS weight, source_size * 2 AS cap FROM named
), levelled AS (
  SELECT *, cap::DOUBLE / weight AS level,
         (sum(source_size) OVER ())::DOUBLE * 1.5 AS budget
  FROM weighed
), filled AS (
  SELECT *, (budget - (sum(cap) OVER upto - cap)::DOUBLE)
            / (sum(weight) OVER () - sum(weight) OVER upto + weight)::DOUBLE AS reached
  FROM levelled
  WINDOW upto AS (ORDER BY level, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), water AS (
  SELECT reached FROM filled WHERE reached <= level
  ORDER BY level, source NULLS LAST LIMIT 1
), targets AS (
  SELECT source, source_size,
         coalesce(least(cap::DOUBLE, (SELECT reached FROM water) * weight), cap::DOUBLE) AS target
  FROM filled
), queued AS (
  SELECT doc_id, source, text, size, repeat,
         md5(repeat::VARCHAR || ':' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM sizes, (VALUES (0), (1)) AS r(repeat)
), timed AS (
  SELECT q.*, t.source_size, t.target,
         CASE WHEN t.target > 0 THEN
           sum(size) OVER (PARTITION BY q.source ORDER BY repeat, place, doc_id, size
                           ROWS UNBOUNDED PRECEDING)::DOUBLE / t.target
         ELSE 'infinity'::DOUBLE END AS finish
  FROM queued q JOIN targets t ON q.source IS NOT DISTINCT FROM t.source
), merged AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, repeat, place, doc_id, size
                            ROWS UNBOUNDED PRECEDING) AS spent
  FROM timed
)
SELECT doc_id, size, source_size, target,
       sum(CASE WHEN spent <= (SELECT sum(target) FROM targets) THEN size ELSE 0 END)::BIGINT
         AS taken
FROM merged GROUP BY doc_id, source, text, size, source_size, target
"""
