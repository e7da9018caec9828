"""Counts of what passes through a step, taken along with the step itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, name: str, **wanted: Column) -> tuple[DataFrame, Observation]:
    """``df`` as it is, and its row count (``rows``) and other aggregates once an action has run over it: no pass of their own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in wanted.items())), seen
