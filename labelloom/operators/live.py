"""Counts of a run while it goes on, taken from its commits by observed metrics.

Each write of outcomes is observed: one aggregate beside the write, no second pass and no
further job. The granule is a commit: what a bucket of files adds is known when it is written.
"""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: ``report(corpus, attempt, outcomes)`` after each commit: what it added for a corpus.
Report = Callable[[str | None, int, dict[str, int]], None]


@dataclass
class LiveProgress:
    """Outcomes per corpus and attempt so far, of one run or stream.

    Corpora are named by the files that are called for; rows of others (retries that an
    earlier run left) are counted together, under None. Commits run side by side, so reports
    come one at a time, from the thread of the commit.
    """

    report: Report | None = None
    counts: dict[tuple[str | None, int], Counter] = field(default_factory=dict)
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)

    def corpora(self) -> list[str]:
        with self._lock:
            return sorted({name for name, _ in self.counts if name is not None})

    def observed(
        self, outcomes: DataFrame, attempt: int, corpora: Iterable[str], kinds: Iterable[str]
    ) -> tuple[DataFrame, Callable[[], None]]:
        """``outcomes`` to be written, and what to call when they are."""
        names, kinds, observation = sorted(set(corpora)), list(kinds), Observation()
        named = F.col("dataset").isin(names) if names else F.lit(False)
        places = [(name, F.col("dataset") == name) for name in names]
        places.append((None, ~F.coalesce(named, F.lit(False))))
        metrics = [
            F.count_if(own & (F.col("outcome") == kind)).alias(f"{at}_{kind}")
            for at, (_, own) in enumerate(places) for kind in kinds
        ]

        def written() -> None:
            found = observation.get
            for at, (name, _) in enumerate(places):
                added = {kind: found[f"{at}_{kind}"] for kind in kinds if found[f"{at}_{kind}"]}
                if added or name is not None:
                    self._add(name, attempt, added)

        return outcomes.observe(observation, *metrics), written

    def _add(self, name: str | None, attempt: int, added: dict[str, int]) -> None:
        with self._lock:
            self.counts.setdefault((name, attempt), Counter()).update(added)
            if self.report and added:
                self.report(name, attempt, added)

    def totals(self, *kinds: str) -> dict[str | None, int]:
        """Rows per corpus whose outcome is one of ``kinds``, over both attempts."""
        out: Counter = Counter()
        with self._lock:
            for (name, _), counted in self.counts.items():
                out[name] += sum(counted[kind] for kind in kinds)
        return dict(out)
