"""The catalog's queries in plain SQL, written from the definitions alone."""

from __future__ import annotations

import re

from labelloom.catalog.answers import FIRST_ANSWER, SECOND_ANSWER, WHOLE_ANSWER
from labelloom.fixed_values import SYSTEM_PROMPT
from labelloom.stubs import CANONICAL_ANSWER
from labelloom.taxonomy import (
    FIELD_NAMES,
    LIST_DOMAINS,
    LIST_FIELDS,
    SCALAR_DOMAINS,
    taxonomy_rows,
)

MODEL = "lab/annotator-1"
SLUG = "lab--annotator-1"
SYSTEM = len(SYSTEM_PROMPT)
FRAME = len("<start_of_document>\n") + len("\n<end_of_document>\n")
MARK = len("\n<truncated_content>")

DOCS = "SELECT source AS dataset, doc_id AS id, text FROM documents"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _in(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(map(_quote, values)) + ")"


def _truncated(limit: object) -> str:
    return (
        f"CASE WHEN length(text) <= {limit} THEN text "
        f"ELSE left(text, {limit}) || chr(10) || '<truncated_content>' END"
    )


# -- budgets ----------------------------------------------------------------------


def _limit(size: str, budget: int, cap: int = 50_000) -> str:
    room = budget - SYSTEM - FRAME
    capped = f"least({size}, {cap})"
    mark = f"CASE WHEN {capped} < {size} THEN {MARK} ELSE 0 END"
    return (
        f"CASE WHEN {capped} + {mark} <= {room} THEN {capped} "
        f"ELSE greatest(0, least({capped}, {room - MARK})) END"
    )


def _tokens(size: str, limit: str) -> str:
    return (
        f"{SYSTEM + FRAME} + least({size}, {limit}) "
        f"+ CASE WHEN {limit} < {size} THEN {MARK} ELSE 0 END"
    )


def _bounds(budget: int, cap: int = 50_000) -> str:
    return f"""
WITH sized AS (SELECT dataset, id, length(text) AS size FROM ({DOCS})),
limited AS (SELECT *, {_limit('size', budget, cap)} AS lim FROM sized)
SELECT dataset, id, CAST(lim AS INTEGER) AS char_limit,
  CAST({_tokens('size', 'lim')} AS INTEGER) AS prompt_tokens,
  {_tokens('size', 'lim')} > {budget} AS over_budget
FROM limited"""


_RETRY_LIMITS = f"""
WITH sized AS (SELECT dataset, id, length(text) AS size FROM ({DOCS})),
first AS (SELECT *, {_limit('size', 7_424)} AS lim FROM sized),
counted AS (SELECT *, {_tokens('size', 'lim')} AS tok FROM first),
second AS (
  SELECT *, CASE WHEN tok + 1024 + 256 <= 8192 THEN lim
    ELSE {_limit('size', 6_912)} END AS lim2
  FROM counted)
"""


# -- validation -------------------------------------------------------------------


def _answers(answer: str) -> str:
    """``answers(dataset, id, raw, doc)``; ``doc`` only where ``raw`` is a JSON object."""
    return f"""
wholes AS MATERIALIZED (SELECT source AS dataset, doc_id AS id, length(text) AS size,
  {WHOLE_ANSWER} AS whole FROM documents),
raws AS MATERIALIZED (SELECT dataset, id, size, {answer} AS raw FROM wholes),
answers AS MATERIALIZED (SELECT *, CASE WHEN json_valid(raw) THEN
  CASE WHEN json_type(raw) = 'OBJECT' THEN raw END END AS doc FROM raws)"""


def _path(name: str) -> str:
    if name == "time_sensitivity":
        return (
            "coalesce(json_extract(doc, '$.time_sensitivity'), "
            "json_extract(doc, '$.time_sensitive'))"
        )
    return f"json_extract(doc, '$.{name}')"


def _is_list_of_text(name: str) -> str:
    return (
        f"(json_type({_path(name)}) = 'ARRAY' AND len(list_filter("
        f"json_type(doc, '$.{name}[*]'), lambda t: t <> 'VARCHAR')) = 0)"
    )


def _typed(name: str) -> str:
    if name in LIST_FIELDS:
        return _is_list_of_text(name)
    return f"(json_type({_path(name)}) = 'VARCHAR')"


def _text(name: str) -> str:
    return f"json_extract_string({_path(name)}, '$')"


def _items(name: str) -> str:
    return f"json_extract_string(doc, '$.{name}[*]')"


def _known(name: str) -> str:
    if name in LIST_DOMAINS:
        return (
            f"(len(list_filter({_items(name)}, lambda v: v NOT IN {_in(LIST_DOMAINS[name])})) = 0)"
        )
    if name in LIST_FIELDS:
        return "TRUE"
    if name == "one_sentence_description":
        return f"(length({_text(name)}) <= 200)"
    return f"({_text(name)} IN {_in(SCALAR_DOMAINS[name])})"


_ALLOWED_KEYS = _in((*FIELD_NAMES, "time_sensitive"))
_VALID = "coalesce(" + " AND ".join(
    [
        "len(json_keys(doc)) = 18",
        f"len(list_filter(json_keys(doc), lambda k: k NOT IN {_ALLOWED_KEYS})) = 0",
        *(_typed(name) for name in FIELD_NAMES),
        *(_known(name) for name in FIELD_NAMES),
    ]
) + ", FALSE)"


def _fault(name: str) -> str:
    label = "too_long" if name == "one_sentence_description" else "label"
    return (
        f"CASE WHEN {_path(name)} IS NULL THEN 'missing:{name}' "
        f"WHEN NOT coalesce({_typed(name)}, FALSE) THEN 'type:{name}' "
        f"WHEN NOT coalesce({_known(name)}, FALSE) THEN '{label}:{name}' END"
    )


_REASONS = f"""CASE WHEN coalesce(raw, '') = '' THEN 'empty_response'
  WHEN NOT json_valid(raw) THEN 'not_json'
  WHEN doc IS NULL THEN 'not_object'
  ELSE array_to_string(list_concat(
    list_filter([{', '.join(_fault(name) for name in FIELD_NAMES)}], lambda f: f IS NOT NULL),
    list_transform(list_sort(list_filter(json_keys(doc), lambda k: k NOT IN {_ALLOWED_KEYS})),
      lambda k: 'unexpected:' || k)), ',') END"""

_FLAT = ", ".join(
    f"array_to_string({_items(name)}, ',') AS {name}"
    if name in LIST_FIELDS
    else f"{_text(name)} AS {name}"
    for name in FIELD_NAMES
)

_FIRST = _answers(FIRST_ANSWER)
_SECOND = re.sub(r"\b(wholes|raws|answers)\b", r"\g<1>2", _answers(SECOND_ANSWER))
_OPEN = f"(SELECT id FROM answers WHERE NOT {_VALID})"


# -- the prompt-size model --------------------------------------------------------

_STUB_FIELDS = ", ".join(
    {
        "content_length": "CASE WHEN seen < 1000 THEN 'brief' ELSE 'moderate' END",
        "one_sentence_description": "concat('Prompt of ', seen, ' characters.')",
        "content_type": "CASE WHEN seen % 2 = 1 THEN 'analytical,reference' ELSE 'creative' END",
    }.get(
        name,
        _quote(
            ",".join(CANONICAL_ANSWER[name])
            if name in LIST_FIELDS
            else CANONICAL_ANSWER[name]
        ),
    )
    + f" AS {name}"
    for name in FIELD_NAMES
)


def _run(off_label_every: int) -> str:
    """``run``: the prompt size behind each document's last answer; ``accepted``."""
    fine = f"s1 % 7 <> 0 AND s1 % 11 <> 0 AND s1 % {off_label_every} <> 0"
    return _RETRY_LIMITS + f""",
prompts AS (
  SELECT dataset, id, {FRAME} + lim + CASE WHEN lim < size THEN {MARK} ELSE 0 END AS s1,
    {FRAME} + lim2 + CASE WHEN lim2 < size THEN {MARK} ELSE 0 END AS s2
  FROM second),
run AS (
  SELECT dataset, id, {fine} AS at_once, CASE WHEN {fine} THEN s1 ELSE s2 END AS seen
  FROM prompts),
accepted AS (SELECT dataset, id, seen FROM run WHERE at_once OR seen % {off_label_every} <> 0)
"""


_RUN = _run(13)
# The same after toxic documents were edited, under names of its own.
_EDITED_DOCS = (
    "SELECT source AS dataset, doc_id AS id, CASE WHEN toxic = 1 THEN text || ' Edited.' "
    "ELSE text END AS text FROM documents LEFT JOIN labels USING (doc_id)"
)
_EDITED_RUN = re.sub(
    r"\b(sized|first|counted|second|prompts|run|accepted)\b", r"\g<1>_2",
    _RUN.replace(DOCS, _EDITED_DOCS).replace("WITH", "", 1),
)
_RUN_RECORDS = f"{_RUN} SELECT dataset, id, {_STUB_FIELDS} FROM accepted"

# -- corpora at different degrees of completeness ---------------------------------

_STATES = """
WITH marked AS (
  SELECT concat(lang, '-', CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good'
      WHEN quality = 0 THEN 'poor' ELSE 'open' END) AS dataset,
    CASE WHEN toxic = 1 THEN 2 WHEN quality = 1 THEN 1
      WHEN quality = 0 AND length(text) >= 1000 THEN 1 ELSE 0 END AS times
  FROM documents LEFT JOIN labels USING (doc_id)),
counted AS (
  SELECT dataset, count(*) AS expected_rows, CAST(sum(times) AS BIGINT) AS actual_rows
  FROM marked GROUP BY dataset),
states AS (
  SELECT *, CASE WHEN actual_rows > expected_rows THEN 'over_complete'
      WHEN actual_rows = 0 THEN 'none' WHEN actual_rows < expected_rows THEN 'partial'
      ELSE 'complete' END AS state
  FROM counted)
"""

_PROGRESS = """
ranked AS (
  SELECT source AS dataset, doc_id AS id,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rank FROM documents),
progress AS (
  SELECT source AS dataset, count(*) AS n_rows, count(labels.doc_id) AS n_done
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source)
"""

_UNLABELLED = (
    "SELECT source AS dataset, doc_id AS id FROM documents d "
    "WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"
)

_NAMED = f"""
SELECT DISTINCT source AS dataset, concat('annotations/', source, '/{SLUG}.parquet') AS path
FROM documents WHERE source <> 'default'"""

_WORDS = "len(list_filter(string_split_regex(text, '[ \\t\\r\\n\\f]+'), lambda w: w <> ''))"
_BAND = (
    f"CASE WHEN {_WORDS} >= 2000 THEN 'substantial' WHEN {_WORDS} >= 500 THEN 'moderate' "
    f"WHEN {_WORDS} >= 100 THEN 'brief' ELSE 'minimal' END"
)

_TAXONOMY = ", ".join(
    f"({_quote(field)}, {_quote(kind)}, {ordinal}, {_quote(value)})"
    for field, kind, ordinal, value in taxonomy_rows()
)
_GIVEN = " UNION ALL ".join(
    f"SELECT '{name}' AS field, unnest({_items(name)}) AS value FROM good"
    if name in LIST_DOMAINS
    else f"SELECT '{name}' AS field, {_text(name)} AS value FROM good"
    for name in FIELD_NAMES
    if name in LIST_DOMAINS or name in SCALAR_DOMAINS
)

ORACLES: dict[str, str] = {
    "scan_documents": DOCS,
    "select_corpus": f"{DOCS} WHERE source = 'src3'",
    "scan_corpora": """
SELECT source AS dataset, CAST(doc_id AS VARCHAR) AS id, CAST(length(text) AS INTEGER) AS n_chars
FROM documents
UNION ALL SELECT 'benchmark', CAST(item_id AS VARCHAR), CAST(length(text) AS INTEGER)
FROM benchmark
UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), CAST(length(html) AS INTEGER) FROM pages
UNION ALL SELECT 'conversations', concat(conv_id, '-', turn), CAST(length(text) AS INTEGER)
FROM conversations""",
    "list_corpora": "SELECT DISTINCT source AS dataset FROM documents WHERE source <> 'default'",
    "corpus_manifest": """
SELECT 'documents' AS dataset, CASE WHEN count(*) > 0 THEN 'ready' END AS status FROM documents
UNION ALL SELECT 'pages', CASE WHEN count(*) > 0 THEN 'ready' END FROM pages
UNION ALL SELECT 'benchmark', CASE WHEN count(*) > 0 THEN 'ready' END FROM benchmark
UNION ALL SELECT 'conversations', CASE WHEN count(*) > 0 THEN 'ready' END FROM conversations
UNION ALL SELECT 'nothing', 'empty'
UNION ALL SELECT 'absent', 'missing'""",
    "part_counts": "SELECT source AS dataset, count(*) AS n_rows FROM documents GROUP BY source",
    "output_paths": f"""
SELECT dataset, '{SLUG}' AS slug, path,
  concat('annotations/', dataset, '/{SLUG}.tmp.parquet') AS temp_path,
  concat('annotations/', dataset, '/{SLUG}.part2.parquet') AS part_path,
  concat('Add ', dataset, ' annotations with {MODEL}') AS message
FROM ({_NAMED})""",
    "truncate_content": f"SELECT dataset, id, {_truncated(1000)} AS content FROM ({DOCS})",
    "build_prompts": f"""
SELECT dataset, id, 'system' AS first_role, {_quote(SYSTEM_PROMPT)} AS first_content,
  'user' AS second_role,
  '<start_of_document>' || chr(10) || {_truncated(50_000)} || chr(10) || '<end_of_document>'
    || chr(10) AS second_content
FROM ({DOCS})""",
    "prompt_tokens": f"""
SELECT dataset, id, CAST({_tokens('length(text)', '50000')} AS INTEGER) AS prompt_tokens
FROM ({DOCS})""",
    "fits_context": f"""
SELECT dataset, id, tok + 512 + 256 <= 8192 AS fits_first, tok + 1024 + 256 <= 8192 AS fits_second
FROM (SELECT *, {_tokens('length(text)', '50000')} AS tok FROM ({DOCS}))""",
    "token_bounded": _bounds(7_424),
    "token_bounded_capped": _bounds(7_424, 900),
    "token_bounded_tight": _bounds(3_590 - 512 - 256),
    "retry_budget": f"""{_RETRY_LIMITS}
SELECT dataset, id, CAST(lim2 AS INTEGER) AS char_limit,
  CAST({_tokens('size', 'lim2')} AS INTEGER) AS prompt_tokens,
  {_tokens('size', 'lim2')} > CASE WHEN tok + 1024 + 256 <= 8192 THEN 7424 ELSE 6912 END
    AS over_budget
FROM second""",
    "parsed_responses": f"WITH {_FIRST} SELECT dataset, id, {_FLAT} FROM answers WHERE {_VALID}",
    "alias_field": f"""WITH {_FIRST}
SELECT dataset, id, CASE WHEN {_VALID} THEN {_text('time_sensitivity')} END AS time_sensitivity
FROM answers""",
    "response_states": f"""WITH {_FIRST}
SELECT dataset, id, CASE WHEN coalesce(raw, '') = '' THEN 'empty' WHEN {_VALID} THEN 'valid'
  ELSE 'invalid' END AS status FROM answers""",
    "reject_reasons": f"WITH {_FIRST} SELECT dataset, id, {_REASONS} AS reasons FROM answers",
    "retry_merge": f"""WITH {_FIRST}, {_SECOND}
SELECT dataset, id, 1 AS attempt, {_FLAT} FROM answers WHERE {_VALID}
UNION ALL SELECT dataset, id, 2, {_FLAT} FROM answers2 WHERE {_VALID} AND id IN {_OPEN}""",
    "rejects": f"""WITH {_FIRST}, {_SECOND}
SELECT dataset, id, raw, {_REASONS} AS reasons, 2 AS attempts
FROM answers2 WHERE NOT {_VALID} AND id IN {_OPEN}""",
    "annotate_documents": f"""{_RUN}
SELECT dataset, id, {_STUB_FIELDS} FROM (SELECT dataset, id, s1 AS seen FROM prompts)""",
    "annotate_corpora": _RUN_RECORDS,
    "rejected_documents": f"""{_RUN}
SELECT dataset, id, 'label:content_quality' AS reasons, 2 AS attempts
FROM run WHERE NOT at_once AND seen % 13 = 0""",
    "published_corpora": f"""{_run(251)}
SELECT dataset, concat('annotations/', dataset, '/{SLUG}.parquet') AS path,
  concat('Add ', dataset, ' annotations with {MODEL}') AS message, count(*) AS n_rows
FROM run GROUP BY dataset HAVING bool_and(at_once OR seen % 251 <> 0)""",
    "published_rows": f"""{_run(251)}
SELECT dataset, id, {_STUB_FIELDS} FROM accepted WHERE dataset IN (
  SELECT dataset FROM run GROUP BY dataset HAVING bool_and(at_once OR seen % 251 <> 0))""",
    "changed_corpora": f"""{_RUN}, {_EDITED_RUN}
SELECT n.dataset, n.id, concat('Prompt of ', n.seen, ' characters.') AS one_sentence_description,
  o.seen IS NULL OR o.seen <> n.seen AS changed
FROM accepted_2 n LEFT JOIN accepted o USING (id)""",
    "refused_corpora": f"""{_RUN}
SELECT dataset, id, concat('Prompt of ', seen, ' characters.') AS one_sentence_description,
  CAST(NULL AS VARCHAR) AS reason
FROM accepted WHERE dataset <> 'src3'
UNION ALL SELECT source, doc_id, NULL, 'null_text'
FROM documents WHERE source = 'src3' OR text IS NULL""",
    "annotator_records": f"""
SELECT dataset, id, concat(length(text), ' characters') AS one_sentence_description
FROM ({DOCS})""",
    "route_sources": """
SELECT DISTINCT source AS dataset, CASE
  WHEN CAST(substring(source, 4) AS INTEGER) % 2 = 0 THEN 'local'
  WHEN source = 'src5' THEN 'unavailable' ELSE 'fallback' END AS source
FROM documents""",
    "partial_records": f"""WITH {_FIRST}
SELECT 'all' AS dataset, row_number() OVER (ORDER BY id % 4, id) - 1 AS rank, id,
  {_text('one_sentence_description')} AS description
FROM answers WHERE {_VALID} AND id % 4 < 3""",
    "packed_parts": f"""WITH {_FIRST},
placed AS (SELECT id, row_number() OVER (ORDER BY id % 4, id) - 1 AS rank
  FROM answers WHERE {_VALID} AND id % 4 < 3)
SELECT 'all' AS dataset, id, rank, rank // 64 AS file FROM placed""",
    "resume_pending": _UNLABELLED,
    "resume_rows": _UNLABELLED,
    "resume_by_position": f"""WITH {_PROGRESS}
SELECT dataset, id, rank FROM ranked JOIN progress USING (dataset) WHERE rank >= n_done""",
    "batch_plan": f"""WITH {_PROGRESS},
sizes AS (SELECT *, greatest(least(32, n_rows - n_done), least(8, n_rows)) AS size FROM progress)
SELECT dataset, id, rank, CAST((rank - n_done) // size AS BIGINT) AS batch_id
FROM ranked JOIN sizes USING (dataset) WHERE rank >= n_done""",
    "merged_parts": f"""
SELECT dataset, id, concat('Size ', length(text)) AS description FROM ({DOCS})""",
    "skip_published": f"""
SELECT dataset, path FROM ({_NAMED}) WHERE dataset NOT IN (
  SELECT source FROM documents JOIN labels USING (doc_id) GROUP BY source
  HAVING sum(quality) * 4 > count(*) * 3)""",
    "completeness": f"{_STATES} SELECT * FROM states",
    "publishable": f"""{_STATES}
SELECT dataset, expected_rows FROM states WHERE state = 'complete'""",
    "overcomplete": f"""{_STATES}
SELECT dataset, expected_rows, actual_rows FROM states WHERE state = 'over_complete'""",
    "orphans": """
SELECT source AS dataset, doc_id AS id FROM documents JOIN labels USING (doc_id)
WHERE toxic = 1""",
    "progress": f"""WITH {_FIRST}
SELECT dataset, count(*) AS n_rows, count(*) FILTER (WHERE {_VALID}) AS n_accepted,
  count(*) FILTER (WHERE NOT {_VALID}) AS n_refused FROM answers GROUP BY dataset""",
    "taxonomy_usage": f"""WITH {_FIRST},
good AS (SELECT doc FROM answers WHERE {_VALID}),
given AS (SELECT field, value, count(*) AS n FROM ({_GIVEN}) GROUP BY field, value)
SELECT t.field, t.kind, CAST(t.ordinal AS INTEGER) AS ordinal, t.value,
  coalesce(g.n, 0) AS n_given
FROM (VALUES {_TAXONOMY}) AS t(field, kind, ordinal, value)
LEFT JOIN given g ON g.field = t.field AND g.value = t.value""",
    "length_bands": f"SELECT dataset, id, {_BAND} AS band FROM ({DOCS})",
    "length_consistency": f"""WITH {_FIRST},
bands AS (SELECT doc_id AS id, {_BAND} AS computed FROM documents)
SELECT {_text('content_length')} AS answered, computed, count(*) AS n_rows
FROM answers JOIN bands USING (id) WHERE {_VALID} GROUP BY 1, 2""",
}

# The same definitions, computed another way by Spark.
ORACLES |= {
    "prompt_tokens_counted": ORACLES["prompt_tokens"],
    "token_bounded_counted": ORACLES["token_bounded"],
    "resumed_corpora": _RUN_RECORDS,
    "incremental_annotate": _RUN_RECORDS,
}
