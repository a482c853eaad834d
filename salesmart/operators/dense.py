"""Dense ids 1..n, for consumers who want small numbers instead of hash keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY_BITS = 60
BUCKET_BITS = 12


def dense_ids(
    members: DataFrame,
    key: str = "id",
    tie_break: Sequence[str] = (),
    name: str = "dense_id",
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """Number the members 1..n in the order of their surrogate key.

    The leading key bits split the members into equally filled buckets whose
    order is the key order. Rows are numbered inside their bucket, and the
    number of members in the buckets before it is added. At most
    2 ** bucket_bits bucket counts exist, whatever the data size; the running
    total over them is the only single-task step. Nothing depends on sampled
    split points, so a recomputed task gives the same ids.

    ``tie_break`` tells members with colliding keys apart.
    """
    bucket = F.shiftright(key, KEY_BITS - bucket_bits).cast("int")
    split = members.withColumn("bucket", bucket)
    counts = split.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("bucket").orderBy(key, *tie_break)
    numbered = split.withColumn("position", F.row_number().over(within))
    return numbered.join(F.broadcast(offsets), "bucket").select(
        (F.col("offset") + F.col("position")).alias(name), *members.columns
    )


def with_dense_keys(
    table: DataFrame, foreign_keys: Mapping[str, DataFrame], own: DataFrame | None = None
) -> DataFrame:
    """Replace the hash keys of a table by dense ids.

    ``foreign_keys`` gives, per column, the numbered members it refers to, with
    the columns ``id`` and ``dense_id``; one table may serve several columns.
    A reference to nothing stays NULL. ``own`` renumbers the table's ``id``.
    """
    columns = {**({"id": own} if own is not None else {}), **foreign_keys}
    result = table
    for column, members in columns.items():
        ids = members.select(F.col("id").alias(column), F.col("dense_id").alias(f"{column}__dense"))
        result = result.join(ids, column, "left")
    return result.select(
        *(F.col(f"{c}__dense").alias(c) if c in columns else F.col(c) for c in table.columns)
    )
