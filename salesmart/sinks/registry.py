"""Dense ids that stay: each member keeps the number it was given first.

The registry is a table of every version: (dimension, id, dense_id), a part per load. Each
dimension has a high-water mark, the largest number given, in the version's notes. Members
that the registry lacks are numbered behind it in the order of their keys, by buckets (see
``dense_ids``), so that there are no gaps and a load that is done again gives the same
numbers. A refresh keeps the registry: members that come again have their old numbers, and
the numbers of members that are gone are not given to others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.dense import dense_ids, with_dense_keys
from salesmart.schema import DIMENSIONS, FOREIGN_KEYS
from salesmart.sinks.snapshots import Attempt

IDS = "dense_ids"
HIGH_WATER = "high_water"

Reader = Callable[[str], DataFrame]


def unnumbered(attempt: Attempt, name: str, known: DataFrame | None) -> DataFrame:
    """Keys of the members without a number."""
    if known is not None and name in attempt.base.tables and not attempt.refresh:
        # All others were there when the registry was last brought up to date.
        return attempt.added(name).select("id")
    members = attempt.read(name).select("id")
    if known is None:
        return members
    return members.join(known.where(F.col("dimension") == name).select("id"), "id", "left_anti")


def register(attempt: Attempt, names: Iterable[str] = DIMENSIONS) -> None:
    """Number the members that are new in this version."""
    attempt.keep(IDS, HIGH_WATER)
    marks = dict(attempt.notes.get(HIGH_WATER, {}))
    names = list(names)
    known = attempt.read(IDS) if marks else None
    new = [
        dense_ids(unnumbered(attempt, name, known)).select(
            F.lit(name).alias("dimension"),
            "id",
            (F.col("dense_id") + marks.get(name, 0)).cast("bigint").alias("dense_id"),
        )
        for name in names
    ]
    counted = {n: F.count_if(F.col("dimension") == n) for n in names}
    attempt.add(
        IDS,
        reduce(DataFrame.unionByName, new),
        lambda w: w.partitionBy("dimension"),
        merge=lambda rows: rows,
        **counted,
    )
    seen = attempt.observed[IDS]
    attempt.notes[HIGH_WATER] = {n: marks.get(n, 0) + (seen.get(n) or 0) for n in names}


def dense_reader(read: Reader) -> Reader:
    """Tables with dense ids instead of keys; only 8-byte keys are joined."""

    def ids(dimension: str) -> DataFrame:
        return read(IDS).where(F.col("dimension") == dimension).select("id", "dense_id")

    def read_dense(name: str) -> DataFrame:
        references = {fk: ids(dim) for fk, dim in FOREIGN_KEYS.get(name, {}).items()}
        own = ids(name) if name in DIMENSIONS else None
        return with_dense_keys(read(name), references, own)

    return read_dense
