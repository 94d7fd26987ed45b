"""Computing an expensive value once, whatever is done with it later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters and projections cannot inline.

    The optimizer moves a filter below a plain projection by copying the projected
    expression into it, which repeats the work, and multiplies it when definitions build
    on each other. Exploding a one-element list keeps the value a row's own, adds no row
    and stays in whole-stage codegen. Filters on other columns still move down.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
