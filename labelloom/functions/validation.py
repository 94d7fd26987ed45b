"""Strict validation of model responses with JVM-side expressions.

A response is accepted when it is one JSON object with exactly the 18 answer fields
(one field may use its alias), each of the right JSON type and inside its label set.
Spark's variant parser keeps JSON types apart, so number-to-string coercion, single
quotes, comments and control characters are refused by the parser itself. What it
lets through is closed here:

* trailing text: the response is parsed inside ``[<response>, <guard>]``; text that
  closes the array early would hide the guard, which is the response's own digest, so
  that no response can hold it;
* missing, extra or wrongly typed fields: ``schema_of_variant`` renders an object's
  keys, sorted, with their types, so one pattern covers all fields;
* unpaired surrogate escapes: a pattern, tried only on responses with ``\\u``.

Verdict and record come from one parse inside whole-stage codegen. Reasons cost far
more, and are meant for the few rejected rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.fixed_values import (
    DESCRIPTION_FIELD,
    DESCRIPTION_MAX_CHARS,
    FIELD_ALIASES,
    LIST_FIELDS,
)
from labelloom.functions.binding import bind
from labelloom.taxonomy import ANNOTATION_TYPE, FIELD_NAMES, LIST_DOMAINS, SCALAR_DOMAINS

_LIST_SHAPE = r"ARRAY<(?:STRING|VOID)>"

# A high surrogate escape without a low one after it, or a low one without a high one
# before it; an escaped backslash in front makes the \u plain text.
_UNPAIRED_SURROGATE = (
    r"(?<!\\)(?:\\\\)*(?:"
    r"\\u[dD][89abAB][0-9a-fA-F]{2}(?!\\u[dD][c-fC-F])"
    r"|(?<!\\u[dD][89abAB][0-9a-fA-F]{2})\\u[dD][c-fC-F][0-9a-fA-F]{2})"
)


def _spellings(name: str) -> tuple[str, ...]:
    return (name, FIELD_ALIASES[name]) if name in FIELD_ALIASES else (name,)


def _answer_shape() -> str:
    """Pattern of ``schema_of_variant`` for a complete answer."""
    fields = [
        f"(?:{'|'.join(_spellings(name))}): {_LIST_SHAPE if name in LIST_FIELDS else 'STRING'}"
        for name in sorted(FIELD_NAMES)
    ]
    return "^OBJECT<" + ", ".join(fields) + ">$"


# Every key the cast may meet: the fields in output order, then their aliases.
_CAST_DDL = "struct<" + ",".join(
    f"{name}:{'array<string>' if name in LIST_FIELDS else 'string'}"
    for name in (*FIELD_NAMES, *FIELD_ALIASES.values())
) + ">"


def accept_duplicate_keys(df: DataFrame) -> DataFrame:
    """Let the last of several equal keys win, as strict validators do.

    The parser reads this from the session when the plan runs.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return df


def _guarded_parse(raw: Column) -> Column:
    return F.try_parse_json(F.concat(F.lit("["), raw, F.lit('\n,"'), F.md5(raw), F.lit('"]')))


def _well_formed(raw: Column, parsed: Column) -> Column:
    paired = F.when(
        F.contains(raw, F.lit("\\u")), ~F.rlike(raw, F.lit(_UNPAIRED_SURROGATE))
    ).otherwise(True)
    return F.coalesce(
        (F.try_variant_get(parsed, "$[1]", "string") == F.md5(raw)) & paired,
        F.lit(False),
    )


def _sql_list(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _field(name: str) -> str:
    """SQL of an answer's field, under whichever spelling it came."""
    if name not in FIELD_ALIASES:
        return f"_answer.{name}"
    return "coalesce(" + ", ".join(f"_answer.{s}" for s in _spellings(name)) + ")"


def _labels_known(name: str) -> str:
    """SQL test of a field's labels. Null elements are never known."""
    if name in LIST_DOMAINS:
        return f"size(array_except({_field(name)}, array({_sql_list(LIST_DOMAINS[name])}))) = 0"
    if name in LIST_FIELDS:
        without_null = f"array_except({_field(name)}, array(CAST(NULL AS STRING)))"
        return f"size({without_null}) = size(array_distinct({_field(name)}))"
    if name == DESCRIPTION_FIELD:
        return f"length({_field(name)}) <= {DESCRIPTION_MAX_CHARS}"
    return f"{_field(name)} IN ({_sql_list(SCALAR_DOMAINS[name])})"


_RECORD = "named_struct(" + ", ".join(f"'{n}', {_field(n)}" for n in FIELD_NAMES) + ")"
_ACCEPTED_RECORD = (
    "CASE WHEN " + " AND ".join(map(_labels_known, FIELD_NAMES)) + f" THEN {_RECORD} END"
)


def parse_annotations(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``annotation``: the record in output order, or null for a refused response."""
    response, parsed = F.col(raw), F.col("_parsed")
    shape = F.schema_of_variant(F.try_variant_get(parsed, "$[0]", "variant"))
    complete = F.rlike(shape, F.lit(_answer_shape()))
    parsed_once = bind(accept_duplicate_keys(df), "_parsed", _guarded_parse(response))
    cast_once = bind(
        parsed_once,
        "_answer",
        F.when(
            _well_formed(response, parsed) & complete,
            F.try_variant_get(parsed, "$[0]", _CAST_DDL),
        ),
    )
    annotation = F.expr(_ACCEPTED_RECORD).cast(ANNOTATION_TYPE)
    return bind(cast_once, "annotation", annotation).drop("_parsed", "_answer")


def is_empty_response(raw: Column) -> Column:
    return F.coalesce(raw, F.lit("")) == ""


def response_status(raw: Column, annotation: Column) -> Column:
    return (
        F.when(is_empty_response(raw), "empty")
        .when(annotation.isNull(), "invalid")
        .otherwise("valid")
    )


def _fault(name: str) -> str:
    """SQL of what is wrong with a field, or null."""
    spellings = _spellings(name)
    present = " OR ".join(f"array_contains(_keys, '{s}')" for s in spellings)
    values = ", ".join(f"try_variant_get(_parsed, '$[0].{s}', 'variant')" for s in spellings)
    expected = f"^{_LIST_SHAPE}$" if name in LIST_FIELDS else "^STRING$"
    content = "too_long" if name == DESCRIPTION_FIELD else "label"
    return f"""CASE WHEN NOT ({present}) THEN 'missing:{name}'
        WHEN NOT coalesce(schema_of_variant(coalesce({values})) RLIKE '{expected}', FALSE)
          THEN 'type:{name}'
        WHEN NOT coalesce({_labels_known(name)}, FALSE) THEN '{content}:{name}' END"""


_FAULTS = ", ".join(
    [
        *map(_fault, FIELD_NAMES),
        *(
            f"CASE WHEN array_contains(_keys, '{name}') AND array_contains(_keys, '{alias}') "
            f"THEN 'unexpected:{alias}' END"
            for name, alias in FIELD_ALIASES.items()
        ),
    ]
)
_ALLOWED_KEYS = _sql_list(tuple(s for name in FIELD_NAMES for s in _spellings(name)))
_ALL_FAULTS = f"""concat(
    array_compact(array({_FAULTS})),
    transform(array_sort(array_except(_keys, array({_ALLOWED_KEYS}))),
      key -> concat('unexpected:', key)))"""


def with_reject_reasons(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``reasons``: everything that is wrong with a response, in field order.

    Run it on refused responses; an acceptable one gets an empty list.
    """
    response, parsed = F.col(raw), F.col("_parsed")
    root = F.schema_of_variant(F.try_variant_get(parsed, "$[0]", "variant"))
    df = bind(accept_duplicate_keys(df), "_parsed", _guarded_parse(response))
    df = bind(df, "_answer", F.try_variant_get(parsed, "$[0]", _CAST_DDL))
    df = bind(df, "_keys", F.array_distinct(F.json_object_keys(response)))
    reasons = (
        F.when(is_empty_response(response), F.array(F.lit("empty_response")))
        .when(~_well_formed(response, parsed), F.array(F.lit("not_json")))
        .when(~F.startswith(root, F.lit("OBJECT<")), F.array(F.lit("not_object")))
        .otherwise(F.expr(_ALL_FAULTS))
    )
    return df.withColumn("reasons", reasons).drop("_parsed", "_answer", "_keys")
