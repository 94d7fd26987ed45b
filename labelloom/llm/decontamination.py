"""Benchmark items found inside documents: size-partitioned MinHash containment search.

Items and documents are sets of five-word shingles over lower-cased words; an item with
fewer words is one shingle of all its words. An item is found in a document that holds at
least ``percent`` of the item's shingles.

Similarity of whole sets is no use here: a short item in a long document has hardly any. So
the items are split by size into classes that double, and an item is signed with its ``k``
smallest shingle hashes, ``k`` being one more than the shingles an item of its class may
lack. By the pigeonhole principle a document that contains the item holds one of them, so
the search misses nothing. Documents' shingle hashes stream past the signatures, which are
broadcast when a count shows that they are few and joined by a shuffle when not; only what
was found is looked at again, and decided by comparing the shingles themselves.

Defined results: null or empty texts have no shingles and neither find nor are found. Rows
that repeat an id, null included, count as one document (or item) with the shingles of the
best row; ``without_items`` can judge each row by its own text instead, as the pipeline
does, so that clean rows stay. Repeated shingles count once. Empty tables give an empty result. Columns other
than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions.binding import bind
from labelloom.llm.shared import fresh, read_table, small_enough, words_of, written

WIDTH = 5
PERCENT = 80
#: Rows of two numbers up to which a table is broadcast: about 32 MB.
BROADCAST_ROWS = 1_000_000


def _shingles(words: str, width: int, value) -> Column:
    """``value`` of every run of ``width`` words of the array column ``words``, in order."""
    starts = F.sequence(F.lit(1), F.size(words) - width + 1)
    runs = F.transform(starts, lambda i: value([F.get(words, i - 1 + k) for k in range(width)]))
    return F.when(F.size(words) >= width, runs).otherwise(F.array().cast(
        "array<bigint>" if value is _hash else "array<string>"))


def _hash(words: list[Column]) -> Column:
    return F.xxhash64(*words)


def _text(words: list[Column]) -> Column:
    return F.concat_ws(" ", *words)


def _with_words(df: DataFrame, key: str, name: str) -> DataFrame:
    return bind(
        df.select(F.col(key).alias(name), F.col("text")), "words", words_of(F.lower("text"))
    ).drop("text")


def item_signatures(items: DataFrame, width: int, percent: int) -> DataFrame:
    """Per item: ``shingles`` as texts, ``n_shingles``, ``width`` and the signature."""
    worded = _with_words(items, "item_id", "item_id").where(F.size("words") > 0)
    by_width = [
        F.when(F.size("words") == w, F.array(F.concat_ws(" ", "words"))) for w in range(1, width)
    ]
    shingled = worded.select(
        "item_id",
        F.least(F.size("words"), F.lit(width)).alias("width"),
        F.array_distinct(F.coalesce(*by_width, _shingles("words", width, _text))).alias("shingles"),
        "words",
    ).withColumn("n_shingles", F.size("shingles"))
    hashes = F.coalesce(
        *[
            F.when(F.size("words") == w, F.array(F.xxhash64(*[F.get("words", k) for k in range(w)])))
            for w in range(1, width)
        ],
        _shingles("words", width, _hash),
    )
    upper = F.pow(F.lit(2), F.ceil(F.log2(F.col("n_shingles").cast("double")))).cast("int")
    lacking = F.floor(upper * (100 - percent) / 100).cast("int")
    return shingled.select(
        "item_id", "width", "n_shingles", "shingles",
        F.slice(F.sort_array(F.array_distinct(hashes)), 1, lacking + 1).alias("signature"),
    )


def find_items(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_shingles``, ``n_shared``, ``containment`` of all finds."""
    return _finds(docs.select("doc_id", "text"), items, ["doc_id"], width, percent)


def _finds(
    docs: DataFrame, items: DataFrame, keys: list[str], width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """``find_items`` of documents, which are rows with equal ``keys``."""
    signed = written(item_signatures(items, width, percent), "benchmark-items")
    widths = [r.width for r in signed.select("width").distinct().collect()]  # at most five
    if not widths:
        schema = ", ".join(f"{k} {dict(docs.dtypes)[k]}" for k in keys)
        schema += f", item_id {dict(items.dtypes)['item_id']}"
        return docs.sparkSession.createDataFrame(
            [], f"{schema}, n_shingles int, n_shared int, containment double"
        )
    probes = small_enough(
        signed.select("item_id", F.explode("signature").alias("hash")), BROADCAST_ROWS
    )
    worded = bind(docs.select(*keys, "text"), "words", words_of(F.lower("text"))).drop("text")
    hashed = worded.select(
        *keys, F.explode(F.concat(*[_shingles("words", w, _hash) for w in widths])).alias("hash")
    )
    found = written(
        hashed.join(probes, "hash").select(*keys, "item_id").distinct(), "benchmark-candidates"
    )
    found = small_enough(found, BROADCAST_ROWS)
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
    both = docs.select(*keys, "text").alias("d").join(found.alias("f"), same).select(
        *[f"d.{k}" for k in keys], "f.item_id", "text")
    texts = small_enough(
        signed.select("item_id", "width", "n_shingles", "shingles"), BROADCAST_ROWS // 50
    )
    pairs = bind(both, "words", words_of(F.lower("text"))).drop("text").alias("d").join(
        texts.alias("i"), F.col("d.item_id").eqNullSafe(F.col("i.item_id"))
    )
    own = F.coalesce(
        *[F.when(F.col("width") == w, _shingles("words", w, _text)) for w in widths]
    )
    shared = pairs.select(
        *keys, "d.item_id", "n_shingles",
        F.size(F.array_intersect("shingles", own)).alias("n_shared"),
    )
    return (
        shared.where(F.col("n_shared") * 100 >= F.col("n_shingles") * percent)
        .groupBy(*keys, "item_id")
        .agg(F.max_by(F.struct("n_shingles", "n_shared"),
                      F.struct(F.col("n_shared") / F.col("n_shingles"), "n_shingles")).alias("best"))
        .select(
            *keys, "item_id", "best.n_shingles", "best.n_shared",
            (F.col("best.n_shared") / F.col("best.n_shingles")).alias("containment"),
        )
    )


def without_items(docs: DataFrame, items: DataFrame, by_row: bool = False) -> DataFrame:
    """``docs`` less those in which an item is found; ``by_row``, each row by its own text."""
    keys = ["doc_id", "text_key"] if by_row else ["doc_id"]
    read = docs.select("doc_id", "text")
    if by_row:
        read = read.withColumn("text_key", F.xxhash64("text"))
    names = [fresh(docs, f"leak_{k}_") for k in keys]
    leaks = _finds(read, items, keys).select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    leaks = small_enough(written(leaks.distinct(), "leaks"), BROADCAST_ROWS)
    same = [F.col("doc_id").eqNullSafe(F.col(names[0]))]
    if by_row:
        same.append(F.xxhash64("text") == F.col(names[1]))
    return docs.join(leaks, same, "left_anti")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


#: The same by joining all shingles.
OP3_SQL = """
WITH worded AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') FROM benchmark
), items AS (
  SELECT id AS item_id, least(len(w), 5) AS width, w FROM worded WHERE kind = 'i' AND len(w) > 0
), item_shingles AS (
  SELECT DISTINCT item_id, width, array_to_string(w[s : s + width - 1], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS s FROM items)
), doc_shingles AS (
  SELECT DISTINCT id AS doc_id, width, array_to_string(w[s : s + width - 1], ' ') AS shingle
  FROM (
    SELECT id, width, w, unnest(range(1, len(w) - width + 2)) AS s
    FROM worded, (SELECT DISTINCT width FROM items) WHERE kind = 'd' AND len(w) >= width
  )
), counted AS (
  SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id
)
SELECT doc_id, item_id, n_shingles::INT AS n_shingles, count(*)::INT AS n_shared,
       count(*)::DOUBLE / n_shingles AS containment
FROM doc_shingles JOIN item_shingles USING (width, shingle) JOIN counted USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) * 100 >= n_shingles * 80
"""
