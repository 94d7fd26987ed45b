"""The label taxonomy as Spark schema, dimension table and response format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from labelloom.fixed_values import (
    ANSWER_FIELDS,
    DESCRIPTION_FIELD,
    DESCRIPTION_MAX_CHARS,
    LIST_FIELDS,
    RESPONSE_NAME,
)

FIELD_NAMES = tuple(ANSWER_FIELDS)
SCALAR_DOMAINS = {
    name: values
    for name, values in ANSWER_FIELDS.items()
    if values is not None and name not in LIST_FIELDS
}
LIST_DOMAINS = {
    name: ANSWER_FIELDS[name] for name in LIST_FIELDS if ANSWER_FIELDS[name] is not None
}

ANNOTATION_TYPE = T.StructType(
    [
        T.StructField(
            name,
            T.ArrayType(T.StringType()) if name in LIST_FIELDS else T.StringType(),
        )
        for name in FIELD_NAMES
    ]
)

TAXONOMY_TYPE = T.StructType(
    [
        T.StructField("field", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("ordinal", T.IntegerType(), False),
        T.StructField("value", T.StringType(), False),
    ]
)


def taxonomy_rows() -> list[tuple[str, str, int, str]]:
    return [
        (name, "list" if name in LIST_FIELDS else "scalar", ordinal, value)
        for name, values in ANSWER_FIELDS.items()
        if values is not None
        for ordinal, value in enumerate(values)
    ]


def taxonomy(spark: SparkSession) -> DataFrame:
    """The 131 labels as a dimension ``(field, kind, ordinal, value)``."""
    return spark.createDataFrame(taxonomy_rows(), TAXONOMY_TYPE)


def response_format() -> dict:
    """The structured-output request: one flat, closed JSON schema of the 18 fields."""

    def label_set(name: str) -> dict:
        return {
            "enum": list(ANSWER_FIELDS[name]),
            "title": name.title().replace("_", ""),
            "type": "string",
        }

    def property_of(name: str) -> dict:
        title = name.replace("_", " ").title()
        if name == DESCRIPTION_FIELD:
            return {"maxLength": DESCRIPTION_MAX_CHARS, "title": title, "type": "string"}
        if name in LIST_FIELDS:
            items = label_set(name) if name in LIST_DOMAINS else {"type": "string"}
            return {"items": items, "title": title, "type": "array"}
        return label_set(name)

    return {
        "type": "json_schema",
        "json_schema": {
            "name": RESPONSE_NAME,
            "schema": {
                "additionalProperties": False,
                "properties": {name: property_of(name) for name in FIELD_NAMES},
                "required": list(FIELD_NAMES),
                "title": RESPONSE_NAME,
                "type": "object",
                "x-guidance": {"whitespace_flexible": False},
            },
            "strict": True,
        },
    }
