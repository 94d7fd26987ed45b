"""The two attempts of an annotation as DataFrame transformations.

    documents -> first_attempt -> outcome: accepted | retry | refused | error
    retry rows -> second_attempt -> outcome: accepted | refused | error

Neither runs anything. Outcomes of an attempt must be written before they are read
again, or every reader would call the model anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.prompts import fits_context, user_prompt
from labelloom.functions.validation import parse_annotations
from labelloom.operators.call_log import CallLog
from labelloom.operators.model_call import (
    ClientFactory,
    TextAnnotator,
    model_response,
    text_record,
)
from labelloom.operators.token_budget import Counter
from labelloom.settings import Settings
from labelloom.taxonomy import ANNOTATION_TYPE

# An error is a call that brought no answer: the row stays open.
ACCEPTED, RETRY, REFUSED, ERROR = "accepted", "retry", "refused", "error"


def bounded_prompts(
    documents: DataFrame, counter: Counter, settings: Settings, attempt: int = 1
) -> DataFrame:
    """Add ``char_limit, prompt_tokens, over_budget`` for an attempt's input budget."""
    bound = counter.bound(
        F.col("text"), F.col("_size"), settings.input_budget(attempt),
        settings.max_content_chars,
    )
    return (
        documents.withColumn("_size", F.length("text"))
        .withColumn("_bound", bound)
        .select(*documents.columns, "_bound.*")
    )


def retry_bounds(first: DataFrame, counter: Counter, settings: Settings) -> DataFrame:
    """The second attempt's bounds, replacing the first attempt's.

    The same prompt is sent again when it leaves room for the larger output; only the
    other texts are bounded anew, and only those reach a Python counter.
    """
    same = fits_context(F.col("prompt_tokens"), settings, 2)
    again = counter.bound(
        F.when(~same, F.col("text")), F.col("_size"), settings.input_budget(2),
        settings.max_content_chars,
    )

    def merged(name: str) -> Column:
        return F.when(same, F.col(name)).otherwise(F.col("_again")[name]).alias(name)

    kept = [name for name in first.columns
            if name not in ("char_limit", "prompt_tokens", "over_budget")]
    return first.withColumn("_size", F.length("text")).withColumn("_again", again).select(
        *kept, merged("char_limit"), merged("prompt_tokens"), merged("over_budget")
    )


def _row(log: CallLog | None) -> list[Column]:
    return [F.col(c) for c in ("part", "version", "pos")] if log else []


def answered(
    bounded: DataFrame,
    client_factory: ClientFactory,
    settings: Settings,
    attempt: int,
    log: CallLog | None = None,
) -> DataFrame:
    """Add ``raw``, ``error`` and ``annotation``. Texts are whole; only prompts are cut."""
    prompt = user_prompt(F.col("text"), F.col("char_limit"))
    response = model_response(prompt, client_factory, settings, attempt, _row(log), log)
    return parse_annotations(
        bounded.withColumn("_response", response).select(*bounded.columns, "_response.*")
    )


def text_annotations(
    documents: DataFrame,
    annotator: TextAnnotator,
    settings: Settings,
    log: CallLog | None = None,
) -> DataFrame:
    """Outcomes of an annotator of whole texts: its records, unchecked, in one attempt."""
    record = text_record(F.col("text"), annotator, settings, _row(log), log)
    outcome = (
        F.when(F.col("text").isNull(), REFUSED)
        .when(F.col("error").isNotNull(), ERROR)
        .otherwise(ACCEPTED)
    )
    return (
        documents.withColumn("_response", record).select(*documents.columns, "_response.*")
        .withColumns({
            "annotation": F.from_json("raw", ANNOTATION_TYPE),
            "outcome": outcome,
            "text": F.lit(None).cast("string"),
            "char_limit": F.lit(None).cast("int"),
            "prompt_tokens": F.lit(None).cast("int"),
            "over_budget": F.lit(None).cast("boolean"),
        })
    )


def first_attempt(
    documents: DataFrame,
    counter: Counter,
    client_factory: ClientFactory,
    settings: Settings,
    log: CallLog | None = None,
) -> DataFrame:
    """Outcomes of attempt 1. ``text`` stays with rows to retry, so that the second
    attempt never goes back to the corpus; it is dropped everywhere else."""
    if isinstance(client_factory, TextAnnotator):
        return text_annotations(documents, client_factory, settings, log)
    called = answered(
        bounded_prompts(documents, counter, settings), client_factory, settings, 1, log
    )
    outcome = (
        F.when(F.col("text").isNull(), REFUSED)
        .when(F.col("error").isNotNull(), ERROR)
        .when(F.col("annotation").isNotNull(), ACCEPTED)
        .otherwise(RETRY)
    )
    return called.withColumn("outcome", outcome).withColumn(
        "text", F.when(F.col("outcome") == RETRY, F.col("text"))
    )


def second_attempt(
    retries: DataFrame,
    counter: Counter,
    client_factory: ClientFactory,
    settings: Settings,
    log: CallLog | None = None,
) -> DataFrame:
    """Outcomes of attempt 2, for the rows attempt 1 left to retry."""
    called = answered(
        retry_bounds(retries.drop("raw", "error", "annotation", "outcome"), counter, settings),
        client_factory, settings, 2, log,
    )
    outcome = (
        F.when(F.col("error").isNotNull(), ERROR)
        .when(F.col("annotation").isNotNull(), ACCEPTED)
        .otherwise(REFUSED)
    )
    return called.withColumn("outcome", outcome).withColumn(
        "text", F.lit(None).cast("string")
    )


def records(outcomes: DataFrame) -> DataFrame:
    """``dataset, id`` and the 18 labels of the accepted rows."""
    return outcomes.filter(F.col("outcome") == ACCEPTED).select(
        "dataset", "id", "annotation.*"
    )
