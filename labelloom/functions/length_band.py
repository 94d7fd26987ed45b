"""Length bands named in the prompt, computed from the text itself."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelloom.fixed_values import LENGTH_BAND_EDGES


def word_count(text: Column) -> Column:
    """Runs of characters between ASCII whitespace."""
    return F.regexp_count(text, F.lit(r"[^ \t\r\n\f]+"))


def length_band(text: Column) -> Column:
    """The band whose lower edges the word count reaches.

    Every comparison is made, not a chain of cases: an expression that always runs is
    computed once, while one under a condition is counted again in each branch.
    """
    words = word_count(text)
    names, edges = zip(*reversed(LENGTH_BAND_EDGES))
    reached = sum(((words >= least).cast("int") for least in edges), F.lit(1))
    return F.elt(reached, F.lit("minimal"), *map(F.lit, names))
