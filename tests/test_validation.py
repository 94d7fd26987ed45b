import json
import random
import re

import pytest
from pyspark.sql import functions as F

from labelloom.functions.validation import (
    parse_annotations,
    response_status,
    with_reject_reasons,
)
from labelloom.stubs import CANONICAL_ANSWER
from labelloom.taxonomy import ANNOTATION_TYPE, FIELD_NAMES, LIST_DOMAINS, LIST_FIELDS
from labelloom.fixed_values import ANSWER_FIELDS


def answer(**changes):
    return json.dumps({**CANONICAL_ANSWER, **changes}, ensure_ascii=False)


def without(*names, **more):
    return json.dumps({k: v for k, v in {**CANONICAL_ANSWER, **more}.items() if k not in names})


GOOD = answer()
DUPLICATED = GOOD[:-1] + ',"content_quality":"poor"}'

ACCEPTED = {
    "canonical": GOOD,
    "outer whitespace": " \n\t" + GOOD + "\r\n ",
    "reversed keys": json.dumps(dict(reversed(CANONICAL_ANSWER.items()))),
    "alias": without("time_sensitivity", time_sensitive="evergreen"),
    "duplicate, last wins": DUPLICATED,
    "duplicate, first bad": '{"content_quality":"nope",' + GOOD[1:],
    "duplicate, first wrong type": '{"content_quality":7,' + GOOD[1:],
    "empty lists": answer(content_type=[], country_relevance=[]),
    "repeated element": answer(content_type=["creative", "creative"]),
    "empty description": answer(one_sentence_description=""),
    "empty country": answer(country_relevance=[""]),
    "free country": answer(country_relevance=["Denmark", "supranational", "Denmark"]),
    "escape": GOOD.replace("A short", "\\u00e9 short"),
    "escaped surrogate pair": GOOD.replace("A short", "\\ud83d\\ude00"),
    "escaped backslash before u": GOOD.replace("A short", "\\\\ud800"),
    "nul escape": GOOD.replace("A short", "\\u0000"),
    "200 emoji": answer(one_sentence_description="\U0001f600" * 200),
    "global": answer(regional_relevance=["global"]),
}

REFUSED = {
    "201 code points": answer(one_sentence_description="x" * 201),
    "missing key": without("pii_presence"),
    "extra key": answer(extra="x"),
    "both spellings": answer(time_sensitive="evergreen"),
    "both spellings, reversed": '{"time_sensitive":"evergreen",' + GOOD[1:],
    "alias with extra": without("time_sensitivity", "pii_presence", time_sensitive="evergreen", x="y"),
    "key case": GOOD.replace('"pii_presence"', '"PII_presence"'),
    "padded key": GOOD.replace('"pii_presence"', '" pii_presence"'),
    "key that spells a shape": GOOD.replace('"pii_presence"', '"pii_presence: STRING, x"'),
    "label case": answer(content_quality="Good"),
    "label padded": answer(content_quality=" good"),
    "unknown label": answer(content_quality="fine"),
    "python name of global": answer(regional_relevance=["global_"]),
    "unknown element": answer(content_type=["creative", "fine"]),
    "null field": answer(content_quality=None),
    "null list": answer(content_type=None),
    "null element": answer(content_type=["creative", None]),
    "only null elements": answer(country_relevance=[None]),
    "null among strings": answer(country_relevance=["a", None]),
    "string for list": answer(content_type="creative"),
    "list for string": answer(content_quality=["good"]),
    "object for string": answer(content_quality={"a": "good"}),
    "nested list": answer(content_type=[["creative"]]),
    "number for description": answer(one_sentence_description=5),
    "boolean for description": answer(one_sentence_description=True),
    "number in countries": answer(country_relevance=["a", 5]),
    "only numbers": answer(country_relevance=[5]),
    "root list": f"[{GOOD}]",
    "root null": "null",
    "root string": '"good"',
    "empty": "",
    "blanks": "   ",
    "null": None,
    "truncated": GOOD[: len(GOOD) // 2],
    "truncated by one": GOOD[:-1],
    "trailing text": GOOD + " done",
    "trailing bracket": GOOD + "]",
    "trailing brace": GOOD + "}",
    "trailing brace and text": GOOD + "} x",
    "trailing bracket and text": GOOD + "] x",
    "second object": GOOD + GOOD,
    "second object, comma": GOOD + "," + GOOD,
    "closes the wrapper": GOOD + ',"x"] x',
    "trailing comma": GOOD[:-1] + ",}",
    "code fence": f"```json\n{GOOD}\n```",
    "byte order mark": "﻿" + GOOD,
    "raw tab": GOOD.replace("A short", "A\tshort"),
    "raw newline": GOOD.replace("A short", "A\nshort"),
    "single quotes": GOOD.replace('"', "'"),
    "comment": "/* x */" + GOOD,
    "high surrogate": GOOD.replace("A short", "\\ud800"),
    "low surrogate": GOOD.replace("A short", "\\uDC00"),
    "swapped surrogates": GOOD.replace("A short", "\\udc00\\ud800"),
    "surrogate after backslash": GOOD.replace("A short", "\\\\\\ud800"),
    "not a number": GOOD.replace('"good"', "NaN"),
}


def frame(spark, cases):
    return spark.createDataFrame(list(cases.items()), "name string, raw string")


def verdicts(spark, cases):
    rows = parse_annotations(frame(spark, cases)).collect()
    return {row["name"]: row["annotation"] for row in rows}


def test_accepts(spark):
    got = verdicts(spark, ACCEPTED)
    assert [name for name, record in got.items() if record is None] == []
    assert list(got["canonical"].asDict()) == list(FIELD_NAMES)
    assert got["canonical"].asDict() == CANONICAL_ANSWER
    assert got["alias"]["time_sensitivity"] == "evergreen"
    assert got["duplicate, last wins"]["content_quality"] == "poor"
    assert got["duplicate, first bad"]["content_quality"] == "good"
    assert got["escape"]["one_sentence_description"] == "é short note on a village library."
    assert got["repeated element"]["content_type"] == ["creative", "creative"]


def test_refuses(spark):
    got = verdicts(spark, REFUSED)
    assert [name for name, record in got.items() if record is not None] == []


def test_schema_is_fixed_even_when_all_lists_are_empty(spark):
    df = parse_annotations(frame(spark, {"a": answer(**{name: [] for name in LIST_FIELDS})}))
    assert df.schema["annotation"].dataType == ANNOTATION_TYPE


def test_reasons(spark):
    rows = with_reject_reasons(frame(spark, {**ACCEPTED, **REFUSED})).collect()
    got = {row["name"]: row["reasons"] for row in rows}
    assert {name: got[name] for name in ACCEPTED if got[name]} == {}
    assert [name for name in REFUSED if not got[name]] == []
    assert got["missing key"] == ["missing:pii_presence"]
    assert got["extra key"] == ["unexpected:extra"]
    assert got["both spellings"] == ["unexpected:time_sensitive"]
    assert got["key case"] == ["missing:pii_presence", "unexpected:PII_presence"]
    assert got["unknown element"] == ["label:content_type"]
    assert got["number for description"] == ["type:one_sentence_description"]
    assert got["201 code points"] == ["too_long:one_sentence_description"]
    assert got["null element"] == ["type:content_type"] or got["null element"] == ["label:content_type"]
    assert got["trailing text"] == ["not_json"]
    assert got["root list"] == ["not_object"]
    assert got["empty"] == got["null"] == ["empty_response"]


def test_status(spark):
    df = parse_annotations(frame(spark, {"a": GOOD, "b": "", "c": None, "d": "{"}))
    rows = df.select("name", response_status(F.col("raw"), F.col("annotation")).alias("s")).collect()
    assert dict(map(tuple, rows)) == {"a": "valid", "b": "empty", "c": "empty", "d": "invalid"}


def test_verdict_stays_in_codegen(spark, capsys):
    raw = F.concat(F.lit(GOOD), F.repeat(F.lit(" "), F.col("id").cast("int")))
    parse_annotations(spark.range(10).select(raw.alias("raw"))).explain("formatted")
    plan = capsys.readouterr().out
    projects = [line for line in plan.splitlines() if re.match(r"\(\d+\) Project", line)]
    assert projects and all("codegen id" in line for line in projects)
    assert "Python" not in plan
    assert plan.count("parseJson") <= 4  # one evaluation, named in one node's output and input


def _strict_model():
    pydantic = pytest.importorskip("pydantic")
    from typing import Literal

    fields = {}
    for name, domain in ANSWER_FIELDS.items():
        kind = str if domain is None else Literal[domain]
        kind = list[kind] if name in LIST_FIELDS else kind
        if name == "one_sentence_description":
            fields[name] = (kind, pydantic.Field(max_length=200))
        elif name == "time_sensitivity":
            choices = pydantic.AliasChoices("time_sensitivity", "time_sensitive")
            fields[name] = (kind, pydantic.Field(validation_alias=choices))
        else:
            fields[name] = (kind, ...)
    return pydantic.create_model(
        "Answer", __config__=pydantic.ConfigDict(extra="forbid"), **fields
    )


def _mutate(rng, text):
    pieces = ['"', "{", "}", "[", "]", ",", ":", " x", "\\", "\\ud800", "\\udc00", "null", "1",
              '"good"', '"time_sensitive":"evergreen",', "\n", "\t", "'", '""', "true"]
    for _ in range(rng.choice([0, 1, 1, 1, 2])):
        at = rng.randrange(len(text) + 1)
        how = rng.random()
        if how < 0.4:
            text = text[:at] + rng.choice(pieces) + text[at:]
        elif how < 0.6:
            text = text[:at] + text[at + rng.randrange(1, 4):]
        elif how < 0.8:
            text = text + rng.choice(pieces)
        else:
            old = rng.choice(["good", "slowly_changing", "reference", "minimal", "safe", "time_sensitivity"])
            text = text.replace(old, rng.choice(["good", "creative", "none", "time_sensitive", ""]), 1)
    return text


def test_fuzz_against_a_strict_model(spark):
    model = _strict_model()
    rng = random.Random(7)
    base = [*ACCEPTED.values(), GOOD, DUPLICATED]
    raws = [_mutate(rng, rng.choice(base)) for _ in range(8_000)]

    def strict(raw):
        try:
            return model.model_validate_json(raw).model_dump(mode="json")
        except ValueError:
            return None

    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    got = {row["i"]: row["annotation"] for row in parse_annotations(df).collect()}
    bad = []
    accepted = 0
    for i, raw in enumerate(raws):
        want = strict(raw)
        have = got[i].asDict() if got[i] else None
        accepted += want is not None
        if want != have:
            bad.append((raw, want is not None, have is not None))
    assert accepted > 1_000
    assert bad == []


def test_response_format_matches_a_strict_model():
    from labelloom.taxonomy import response_format

    schema = response_format()["json_schema"]["schema"]
    model_schema = _strict_model().model_json_schema()
    assert schema["required"] == model_schema["required"] == list(FIELD_NAMES)
    assert schema["additionalProperties"] is False is model_schema["additionalProperties"]
    for name, want in model_schema["properties"].items():
        have = dict(schema["properties"][name])
        if name not in LIST_FIELDS and name != "one_sentence_description":
            assert have.pop("title") == "".join(w.title() for w in name.split("_"))
            want.pop("title")
        if name in LIST_DOMAINS:
            have = {**have, "items": {k: v for k, v in have["items"].items() if k != "title"}}
        assert have == want
