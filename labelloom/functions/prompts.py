"""Prompt text and character budgets as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelloom.fixed_values import (
    DOCUMENT_CLOSE,
    DOCUMENT_OPEN,
    MAX_CONTENT_CHARS,
    SYSTEM_PROMPT,
    TRUNCATION_MARK,
)
from labelloom.settings import Settings

EMPTY_PROMPT_CHARS = len(SYSTEM_PROMPT) + len(DOCUMENT_OPEN) + len(DOCUMENT_CLOSE)


def _int(value: Column | int) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def truncate_content(text: Column, limit: Column | int = MAX_CONTENT_CHARS) -> Column:
    """The text itself up to ``limit`` code points, else its head plus the truncation mark."""
    limit = _int(limit)
    return F.when(F.length(text) <= limit, text).otherwise(
        F.concat(F.left(text, limit), F.lit(TRUNCATION_MARK))
    )


def user_prompt(text: Column, limit: Column | int = MAX_CONTENT_CHARS) -> Column:
    return F.concat(F.lit(DOCUMENT_OPEN), truncate_content(text, limit), F.lit(DOCUMENT_CLOSE))


def chat_messages(text: Column, limit: Column | int = MAX_CONTENT_CHARS) -> Column:
    """``array<struct<role, content>>``; the text is concatenated, never formatted."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(
        message("system", F.lit(SYSTEM_PROMPT)), message("user", user_prompt(text, limit))
    )


def prompt_chars(size: Column, limit: Column | int = MAX_CONTENT_CHARS) -> Column:
    """Characters of the whole prompt of a text of ``size``, without building it."""
    limit = _int(limit)
    mark = F.when(limit < size, len(TRUNCATION_MARK)).otherwise(0)
    return F.lit(EMPTY_PROMPT_CHARS) + F.least(size, limit) + mark


def char_budget_limit(
    size: Column, input_budget: int, cap: int = MAX_CONTENT_CHARS
) -> Column:
    """Longest head of a text of ``size`` whose prompt stays within a character budget.

    The capped text is kept when it fits as it is; otherwise the mark must fit too.
    Zero when not even the mark fits, so the prompt may still exceed the budget.
    """
    room, mark = input_budget - EMPTY_PROMPT_CHARS, len(TRUNCATION_MARK)
    capped = F.least(size, F.lit(cap))
    needed = capped + F.when(capped < size, mark).otherwise(0)
    return F.when(needed <= room, capped).otherwise(
        F.greatest(F.lit(0), F.least(capped, F.lit(room - mark)))
    )


def fits_context(prompt_tokens: Column, settings: Settings, attempt: int) -> Column:
    """Whether prompt, reserved output and margin fit the context window together."""
    reserved = settings.output_budget(attempt) + settings.prompt_margin
    return prompt_tokens + F.lit(reserved) <= F.lit(settings.max_context_tokens)
