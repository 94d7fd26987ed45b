"""Deterministic stand-ins for a labelling model: no network, no randomness.

They see exactly what a model would see (messages and output budget), so results
depend on the whole prompt path and can be recomputed by SQL.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

CANONICAL_ANSWER = {
    "content_integrity": "mostly_complete",
    "content_ratio": "mostly_content",
    "content_length": "brief",
    "one_sentence_description": "A short note on a village library.",
    "content_type": ["reference", "news_report"],
    "business_sector": ["nonprofit_ngo"],
    "technical_content": ["basic_technical"],
    "information_density": "moderate",
    "content_quality": "good",
    "audience_level": "beginner",
    "commercial_bias": "minimal",
    "time_sensitivity": "slowly_changing",
    "content_safety": "safe",
    "educational_value": "basic",
    "reasoning_indicators": "explanatory",
    "pii_presence": "contains_pii",
    "regional_relevance": ["european", "global"],
    "country_relevance": ["Denmark", "supranational"],
}


@dataclass(frozen=True)
class PromptSizeModel:
    """Answers from the size of the prompt's user message, in characters.

    ``flaky`` makes it fail as models do, by that size: cut off (multiples of 7) or
    silent (of 11) under the smaller output budget, and off the label set (of
    ``off_label_every``) under any. The factory returns itself, so an instance is a client factory too.
    """

    flaky: bool = False
    small_output: int = 512
    off_label_every: int = 13

    def __call__(self):
        return self.answer

    def answer(self, messages: list, max_tokens: int, response_format: dict) -> str | None:
        size = len(messages[1]["content"])
        label = "unheard_of" if self.flaky and size % self.off_label_every == 0 else "good"
        text = json.dumps(
            {
                **CANONICAL_ANSWER,
                "content_length": "brief" if size < 1_000 else "moderate",
                "one_sentence_description": f"Prompt of {size} characters.",
                "content_type": ["analytical", "reference"] if size % 2 else ["creative"],
                "content_quality": label,
            }
        )
        if self.flaky and max_tokens <= self.small_output:
            if size % 7 == 0:
                return text[: len(text) // 2]
            if size % 11 == 0:
                return None
        return text
