"""Conversations as Spark rows: each whole in one task's stream, or in pieces where it is long.

A conversation is all rows of one ``conv_id`` (NULL is one, too), in the order of ``turn``
(NULLs first), then role and text, so that ties have one order in every run. One with more
rows or bytes than a bound is cut into pieces of at most that size, which several tasks
work on; the pieces of a conversation are numbered in its order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from salesmart.llm.common import stored

PIECE_ROWS = 2_000
PIECE_BYTES = 32 << 20
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20
# Code points of a text that take part in choosing where long conversations are split.
HEAD = 40


def in_order() -> list[Column]:
    return [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def split_long(
    rows: DataFrame, name: str, most_rows: int = PIECE_ROWS, most_bytes: int = PIECE_BYTES
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of conversations within the bounds, and the others' rows with ``part`` and ``pos``.

    The others are None if there are none. They are dealt by ranges of their order, so
    that a conversation with a third of all rows is dealt over a third of the tasks, and
    stored. Rows alike in all columns are told apart by where they were read.
    """
    size = rows.groupBy("conv_id").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")
    )
    long = stored(
        size.where((F.col("n") > most_rows) | (F.col("bytes") > most_bytes)).select("conv_id"),
        f"{name}-long",
    )
    if long.isEmpty():
        return rows, None
    same = F.col("conv_id").eqNullSafe(F.col("_long"))
    long = long.withColumnRenamed("conv_id", "_long")
    light = rows.join(long, same, "left_anti")
    heavy = rows.join(long, same, "left_semi").withColumn("_row", F.monotonically_increasing_id())
    ranges = [*in_order()[:3], F.left("text", F.lit(HEAD)), F.col("_row")]
    heavy = heavy.repartitionByRange(*ranges).sortWithinPartitions(*in_order(), "_row").drop("_row")
    schema = T.StructType([*heavy.schema, *T.StructType.fromDDL("part bigint, pos bigint")])
    numbered = heavy.mapInArrow(_number(most_rows, most_bytes), schema)
    return light, stored(numbered, f"{name}-rows")


def _number(most_rows: int, most_bytes: int):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, pos, size, before = TaskContext.get().partitionId() << 33, 0, 0, None
        for batch in batches:
            parts, places = [], []
            sizes = pa.compute.binary_length(batch.column("text")).to_pylist()
            for conv, n in zip(batch.column("conv_id").to_pylist(), sizes):
                n = n or 0
                new = (conv,) != before
                if new or pos == most_rows or pos and size + n > most_bytes:
                    part, pos, size, before = part + (before is not None), 0, 0, (conv,)
                parts.append(part)
                places.append(pos)
                pos, size = pos + 1, size + n
            columns = [*batch.columns, pa.array(parts, pa.int64()), pa.array(places, pa.int64())]
            names = [*batch.schema.names, "part", "pos"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return number


def ordered(light: DataFrame) -> DataFrame:
    """Each conversation's rows one after another in one partition, in order."""
    return light.repartition("conv_id").sortWithinPartitions(*in_order())


def pieces(heavy: DataFrame, columns: list[str]) -> DataFrame:
    """(conv_id, part, rows): the rows of each piece as a list in order."""
    row = F.struct("pos", *columns)
    listed = heavy.groupBy("conv_id", "part").agg(F.collect_list(row).alias("rows"))
    return listed.withColumn("rows", F.array_sort("rows"))


def runs(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[object, list]]:
    """(conv_id, its rows) of a stream in which conversations follow one another."""

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", *columns)))

    for conv, found in groupby(rows(), itemgetter(0)):
        yield conv, [r[1:] for r in found]


def mapped(frame: DataFrame, make: Callable[[Iterator], Iterator[dict]], schema: str) -> DataFrame:
    """Rows that ``make`` gives as dicts from a stream of batches, in batches of bounded size."""
    fields = T.StructType.fromDDL(schema)
    target = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in make(batches):
            held.append(row)
            size += row.pop("_bytes", 0)
            if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(held, target)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, target)

    return frame.mapInArrow(run, fields)
