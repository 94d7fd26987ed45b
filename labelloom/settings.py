"""Run settings shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

from labelloom import fixed_values as fixed


@dataclass(frozen=True)
class Settings:
    """How documents are prompted, called and committed.

    ``slots`` deals rows out to that many tasks for the model call; ``None`` leaves them
    where the scan has them. In-flight requests on the whole cluster are running tasks x
    ``requests_per_task``. ``parts_per_commit`` files make a bucket and a commit, and
    ``commits_at_once`` commits run side by side, so that none waits for another's slowest
    task. Answers are logged as they come, ``batch_rows`` to a file, so that no lost task or
    run pays for more than that twice; ``log_answers`` turns this off. ``batch_rows`` is also
    the batch of ``batch_plan``. A row whose call failed in ``call_tries`` runs is refused.

    A corpus with refused rows is not complete, unless ``publish_refused`` is set.
    """

    model_name: str
    max_context_tokens: int = fixed.MAX_CONTEXT_TOKENS
    max_content_chars: int = fixed.MAX_CONTENT_CHARS
    output_budgets: tuple[int, int] = fixed.OUTPUT_TOKEN_BUDGETS
    prompt_margin: int = fixed.PROMPT_TOKEN_MARGIN
    batch_rows: int = fixed.BATCH_ROWS
    requests_per_task: int = fixed.IN_FLIGHT_REQUESTS
    slots: int | None = None
    log_answers: bool = True
    parts_per_commit: int = 64
    commits_at_once: int = 4
    call_tries: int = 5
    publish_refused: bool = False
    on_invalid: str = "quarantine"

    def __post_init__(self) -> None:
        if self.on_invalid not in ("quarantine", "fail"):
            raise ValueError(f"on_invalid must be quarantine or fail, not {self.on_invalid}")

    @property
    def model_slug(self) -> str:
        return self.model_name.replace("/", "--")

    def output_budget(self, attempt: int) -> int:
        return self.output_budgets[attempt - 1]

    def input_budget(self, attempt: int) -> int:
        """Prompt tokens left once output and margin are reserved (7424, then 6912)."""
        return self.max_context_tokens - self.output_budget(attempt) - self.prompt_margin
