"""Calling the labelling model from Spark tasks.

The client is injected as a factory and built once per task. Only the user message
crosses to Python and only the response crosses back; ids and texts stay in the JVM and are
re-attached row by row, in order. With a log of answers, the row's file and position go along.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.operators.call_log import CallLog, TaskLog
from labelloom.operators.token_budget import Messages, chat
from labelloom.settings import Settings
from labelloom.taxonomy import response_format

# call(messages, max_tokens, response_format) -> response text, or None
ModelCall = Callable[[Messages, int, dict], str | None]
ClientFactory = Callable[[], ModelCall]

RESPONSE_TYPE = "struct<raw:string,error:string>"
#: Answers that may wait for an earlier one, per request under way; rows handed on at once.
WAITING_PER_REQUEST, ROWS_PER_BATCH = 32, 1_000


def chat_completions(make_client: Callable[[], object], model_name: str) -> ClientFactory:
    """Factory for clients with the common ``chat.completions.create`` interface."""

    def build() -> ModelCall:
        client = make_client()

        def call(messages: Messages, max_tokens: int, response_format: dict) -> str | None:
            response = client.chat.completions.create(
                model=model_name,
                messages=messages,
                response_format=response_format,
                max_tokens=max_tokens,
            )
            return response.choices[0].message.content

        return call

    return build


@dataclass(frozen=True)
class TextAnnotator:
    """Factory for annotators that offer ``annotate(text) -> record`` instead of a chat.

    They get whole texts: no prompt, no budget, no second attempt. Their records are taken
    as they are.
    """

    make_annotator: Callable[[], object]


def in_order(
    call: Callable[..., object], rows: Iterable[tuple], in_flight: int, most_waiting: int
) -> Iterator:
    """``call`` of every row, in order, ``in_flight`` at a time.

    A call starts as soon as another has ended, whether or not an earlier one still runs:
    results wait for their turn, up to ``most_waiting`` of them.
    """
    waiting: deque[Future] = deque()
    with ThreadPoolExecutor(in_flight) as requests:
        try:
            for row in rows:
                if len(waiting) >= most_waiting:
                    yield waiting.popleft().result()
                waiting.append(requests.submit(call, *row))
                while waiting and waiting[0].done():
                    yield waiting.popleft().result()
            while waiting:
                yield waiting.popleft().result()
        finally:
            for future in waiting:
                future.cancel()


def _answers(
    contents: Column,
    build: Callable[[], Callable[[str], str | None]],
    settings: Settings,
    row: Sequence[Column] = (),
    log: CallLog | None = None,
) -> Column:
    """``raw`` and ``error`` per row; null contents are not sent.

    Marked non-deterministic so that the optimizer neither duplicates nor reorders the
    call. What goes wrong in one call is that row's error: it is never taken for an answer,
    and takes no other row's answer with it. With a ``log``, answers are written there as
    they come, under ``row`` (part, version, pos), and those that are there are not asked for.
    """
    in_flight = settings.requests_per_task
    row = row if log else [F.lit(None).cast(kind) for kind in ("string", "long", "long")]

    @F.pandas_udf(RESPONSE_TYPE)
    def respond(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        call = build()
        kept = TaskLog(log) if log else None

        def one(content: str | None, part, version, pos) -> tuple[str | None, str | None]:
            if content is None:
                return None, None
            try:
                raw = call(content)
            except Exception as error:  # noqa: BLE001 - whatever a client raises
                return None, f"{type(error).__name__}: {error}"
            if kept:
                kept.add((part, version, pos), raw)
            return raw, None

        def answer(content: str | None, part, version, pos, known: tuple):
            return (known[1], None) if known[0] else one(content, part, version, pos)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                asked = list(zip(*(c.tolist() for c in batch), strict=True))
                found = kept.find_all(key for content, *key in asked if content is not None) \
                    if kept else {}
                for content, *key in asked:
                    known = tuple(key) in found
                    yield content, *key, (known, found.pop(tuple(key)) if known else None)

        answers = in_order(answer, rows(), in_flight, in_flight * WAITING_PER_REQUEST)
        try:
            while part := list(islice(answers, ROWS_PER_BATCH)):
                yield pd.DataFrame(part, columns=["raw", "error"], dtype=object)
        finally:
            answers.close()
            if kept:
                kept.flush()

    return respond.asNondeterministic()(contents, *row)


def model_response(
    user_content: Column,
    client_factory: ClientFactory,
    settings: Settings,
    attempt: int,
    row: Sequence[Column] = (),
    log: CallLog | None = None,
) -> Column:
    """The model's response to each prompt."""
    max_tokens = settings.output_budget(attempt)
    answer_format = response_format()

    def build() -> Callable[[str], str | None]:
        call = client_factory()
        return lambda content: call(chat(content), max_tokens, answer_format)

    return _answers(user_content, build, settings, row, log)


def text_record(
    text: Column,
    annotator: TextAnnotator,
    settings: Settings,
    row: Sequence[Column] = (),
    log: CallLog | None = None,
) -> Column:
    """The annotator's record of each whole text, as JSON."""
    make_annotator = annotator.make_annotator

    def build() -> Callable[[str], str | None]:
        own = make_annotator()
        return lambda content: json.dumps(own.annotate(content))

    return _answers(text, build, settings, row, log)


def spread(documents: DataFrame, slots: int | None, *keys: str) -> DataFrame:
    """Deal rows out to ``slots`` tasks for the calls; without a number, leave the scan's.

    Set it for corpora whose files have few splits; a scan of many splits is wide already,
    and moving its text would be a shuffle for nothing.
    """
    return documents if slots is None else documents.repartition(slots, *keys)
