"""Distinct values and distinct keepers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_distinct(frame: DataFrame, columns: Sequence[str], name: str = "name") -> DataFrame:
    """Distinct non-NULL values of several columns, from one scan of the frame."""
    values = frame.select(F.explode(F.array(*columns)).alias(name))
    return values.where(F.col(name).isNotNull()).distinct()


def union_distinct_all(
    parts: Sequence[tuple[DataFrame, Sequence[str]]], name: str = "name"
) -> DataFrame:
    """Distinct non-NULL values over columns of several frames."""
    values = [union_distinct(frame, columns, name) for frame, columns in parts]
    return reduce(DataFrame.unionByName, values).distinct() if len(values) > 1 else values[0]


def first_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` values of each key.

    An aggregate, not a window: each task keeps one row per key before the
    shuffle, so a hot key costs one row per task. Where only the order column is
    kept the aggregate hashes; with more columns it sorts. ``order`` should identify a
    row within its key, then the result does not depend on the run.
    """
    if len(order) == 1 and set(frame.columns) == {*keys, *order}:
        least = F.min(order[0]).alias(order[0])
        return frame.groupBy(*keys).agg(least).select(*frame.columns)
    rest = [c for c in frame.columns if c not in keys and c not in order]
    row = F.min(F.struct(*order, *rest)).alias("row")
    return frame.groupBy(*keys).agg(row).select(*keys, "row.*").select(*frame.columns)
