"""Searches in SQL without an index: all shingles joined, all windows grouped."""

from __future__ import annotations

#: The checksum of the text {0}, all ASCII, bit by bit.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    range(1, length({0}) + 1), lambda i: list_transform(range(8),
    lambda j: ((ord(substring({0}, i::INT, 1)) >> j::INT) & 1)::BIGINT)))),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))))"""

OP6_SQL = """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s : s + 3], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 2))) AS s FROM worded WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)
), reached AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.r = links.a
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(r) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

#: Bytes are handled as pairs of hexadecimal digits.
OP8_SQL = """
WITH hexed AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, length(h) // 2 AS n_bytes FROM documents
), windows AS (
  SELECT doc_id, s, substring(h, 2 * s + 1, 200) AS w
  FROM (SELECT *, unnest(range(0, n_bytes - 99)) AS s FROM hexed WHERE n_bytes >= 100)
), firsts AS (
  SELECT w, min(doc_id * 4294967296 + s) AS first FROM windows GROUP BY w HAVING count(*) > 1
), later AS (
  SELECT doc_id, s FROM windows JOIN firsts USING (w) WHERE doc_id * 4294967296 + s > first
), marked AS (
  SELECT doc_id, s, CASE WHEN s <= lag(s) OVER ordered + 100 THEN 0 ELSE 1 END AS new
  FROM later WINDOW ordered AS (PARTITION BY doc_id ORDER BY s)
), islands AS (
  SELECT doc_id, s,
         sum(new) OVER (PARTITION BY doc_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS island
  FROM marked
), spans AS (
  SELECT doc_id, min(s) AS b, max(s) + 100 AS e FROM islands GROUP BY doc_id, island
), gaps AS (
  SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS a FROM spans
), cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(e - b)::BIGINT AS n_removed, max(e) AS last,
         string_agg(substring(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY b) AS kept
  FROM gaps JOIN hexed USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n_bytes::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE kept || substring(h, 2 * last + 1) END))
    AS kept_sha256
FROM hexed LEFT JOIN cut USING (doc_id)
"""
