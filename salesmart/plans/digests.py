"""Reconciliation by content: are the rows of two tables the same, and if not, which differ.

Both sides are summed up to a count and a digest per bucket of their key, which do not depend
on the order of rows; only these go through a shuffle. Rows are looked at in the buckets that
differ alone: there, each row counts +1 on one side and -1 on the other, and what does not
cancel is missing on a side or differs. That finds two swapped references, which keep every
count and total.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.keys import row_digest
from salesmart.schema import DIMENSIONS, WAREHOUSE_TABLES

Reader = Callable[[str], DataFrame]

# Buckets that the digests of a table are kept for. A wrong row makes one of them be read.
BUCKETS = 4096


def row_key(table: str) -> str:
    return "id" if table in DIMENSIONS else "source_id"


def _bucketed(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def bucket_digests(rows: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, digest): tasks add up their own rows first."""
    digest = row_digest(*sorted(rows.columns))
    return _bucketed(rows, key, buckets).groupBy("bucket").agg(
        F.count("*").alias("n"), digest.alias("digest")
    )


def differing_buckets(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Buckets whose digests differ, of two tables of digests."""
    sides = [wanted.select("bucket", "n", "digest", F.lit(1).alias("sign"))]
    sides.append(stored.select("bucket", "n", "digest", F.lit(-1).alias("sign")))
    both = reduce(DataFrame.unionByName, sides).groupBy("bucket", "n", "digest")
    return both.agg(F.sum("sign").alias("sign")).where("sign <> 0").select("bucket").distinct()


def differences(
    wanted: DataFrame, stored: DataFrame, key: str, buckets: int = BUCKETS
) -> DataFrame:
    """Rows of one side that the other lacks: the key, ``side`` (wanted, stored), and the row.

    A row that differs is there once for each side; one that is repeated, as often as it is
    there too often.
    """
    columns = sorted(wanted.columns)
    bad = differing_buckets(
        bucket_digests(wanted.select(*columns), key, buckets),
        bucket_digests(stored.select(*columns), key, buckets),
    )
    # At most ``buckets`` numbers.
    bad = F.broadcast(bad)
    sides = [
        _bucketed(rows.select(*columns), key, buckets)
        .join(bad, "bucket", "left_semi")
        .withColumn("sign", F.lit(sign))
        for rows, sign in ((wanted, 1), (stored, -1))
    ]
    left = reduce(DataFrame.unionByName, sides).groupBy(*columns).agg(F.sum("sign").alias("sign"))
    side = F.when(F.col("sign") > 0, "wanted").otherwise("stored")
    return left.where("sign <> 0").select(
        side.alias("side"), F.abs("sign").alias("times"), *columns
    )


def differing_columns(found: DataFrame, key: str) -> DataFrame:
    """(key, columns): for each key with a row on both sides, what differs; else NULL."""
    columns = [c for c in found.columns if c not in (key, "side", "times")]
    wanted, stored = (F.col("side") == s for s in ("wanted", "stored"))
    values = [
        F.struct(F.min(F.when(wanted, F.struct(c))).alias("w"), F.min(F.when(stored, F.struct(c))).alias("s"))
        .alias(f"{c}__both")
        for c in columns
    ]
    per_key = found.groupBy(key).agg(F.countDistinct("side").alias("sides"), *values)
    differ = F.array_compact(
        F.array(
            *(
                F.when(~F.col(f"{c}__both.w").eqNullSafe(F.col(f"{c}__both.s")), F.lit(c))
                for c in columns
            )
        )
    )
    return per_key.select(key, F.when(F.col("sides") == 2, differ).alias("columns"))


def dq_digest(wanted: Reader, stored: Reader, buckets: int = BUCKETS) -> DataFrame:
    """Per table: its rows as wanted and as stored, and how many rows differ, with their keys."""
    tables = []
    for name in WAREHOUSE_TABLES:
        rows, found = wanted(name), stored(name)
        rows = rows.select(*sorted(rows.columns))
        found = found.select(*rows.columns)
        key = row_key(name)
        differ = differences(rows, found, key, buckets).agg(
            F.countDistinct(key).alias("differing_rows"),
            F.min(key).alias("first_key"),
            F.max(key).alias("last_key"),
        )
        counts = [
            side.agg(F.count("*").alias(n)) for side, n in ((rows, "wanted_rows"), (found, "stored_rows"))
        ]
        parts = [
            frame.select(F.lit(name).alias("table_name"), "*") for frame in (*counts, differ)
        ]
        tables.append(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    numbers = ["wanted_rows", "stored_rows", "differing_rows", "first_key", "last_key"]
    return merged.groupBy("table_name").agg(*(F.max(n).alias(n) for n in numbers))
