"""JDBC sources: connection settings and partitioned reads."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Environment names and defaults of the two stores.
POSTGRES_DEFAULTS = {"PG_HOST": "postgres", "PG_PORT": "5432", "PG_DATABASE": "main_db"}
CLICKHOUSE_DEFAULTS = {
    "CH_HOST": "clickhouse-server",
    "CH_PORT": "8123",
    "CH_DATABASE": "analytics",
    "CH_DRIVER": "com.clickhouse.jdbc.ClickHouseDriver",
}
POSTGRES_DRIVER = "org.postgresql.Driver"


@dataclass(frozen=True)
class JdbcStore:
    url: str
    options: Mapping[str, str] = field(repr=False)

    def table(self, name: str) -> dict[str, str]:
        return {"url": self.url, "dbtable": name, **self.options}


def postgres(env: Mapping[str, str] = os.environ) -> JdbcStore:
    get = {**POSTGRES_DEFAULTS, **env}
    options = {"driver": POSTGRES_DRIVER}
    for option, variable in (("user", "PG_USER"), ("password", "PG_PASSWORD")):
        if variable in get:
            options[option] = get[variable]
    url = f"jdbc:postgresql://{get['PG_HOST']}:{get['PG_PORT']}/{get['PG_DATABASE']}"
    return JdbcStore(url, options)


def clickhouse(env: Mapping[str, str] = os.environ) -> JdbcStore:
    get = {**CLICKHOUSE_DEFAULTS, **env}
    options = {"driver": get["CH_DRIVER"], "user": get.get("CH_USER", "default")}
    if "CH_PASSWORD" in get:
        options["password"] = get["CH_PASSWORD"]
    url = f"jdbc:clickhouse://{get['CH_HOST']}:{get['CH_PORT']}/{get['CH_DATABASE']}"
    return JdbcStore(url, options)


def partition_options(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Split one table read into ranges of a numeric column, one connection each."""
    if partitions < 1 or lower > upper:
        raise ValueError(f"no ranges in {lower}..{upper} / {partitions}")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


# Counts a table is split by: buckets of one query, and how often a full one is split again.
BUCKETS, DEPTH = 1024, 4

# (smallest value, value after the largest, rows) of a range that holds rows.
Range = tuple[int, int, int]


def counted_ranges(
    count: Callable[[int, int, int], Mapping[int, int]],
    lower: int,
    upper: int,
    most: int,
    depth: int = DEPTH,
) -> list[Range]:
    """Ranges between ``lower`` and ``upper`` (inclusive) with their rows, ``most`` each if possible.

    ``count(first, width, end)`` gives the rows per bucket of ``width`` values from ``first`` on
    and before ``end``. Buckets with too many rows are counted again in smaller ones, so that
    gaps and dense stretches are found wherever they are.
    """
    width = max(1, -(-(upper - lower + 1) // BUCKETS))
    end = upper + 1
    ranges = []
    for bucket, rows in sorted(count(lower, width, end).items()):
        first, last = lower + bucket * width, min(lower + (bucket + 1) * width, end)
        if rows > most and width > 1 and depth > 1:
            ranges += counted_ranges(count, first, last - 1, most, depth - 1)
        else:
            ranges.append((first, last, rows))
    return ranges


def range_predicates(column: str, ranges: Sequence[Range], partitions: int) -> list[str]:
    """Conditions, each row in exactly one, that hold about equal numbers of rows.

    The first one also holds what lies below all ranges and NULL, the last one what lies above.
    """
    total = sum(rows for _, _, rows in ranges)
    cuts, seen = [], 0
    for _, end, rows in ranges[:-1]:
        seen += rows
        # A share is full; a range that fills several shares ends one partition.
        if seen * partitions >= total:
            cuts.append(end)
            seen = 0
    if not cuts:
        return ["1 = 1"]
    first = f"{column} < {cuts[0]} or {column} is null"
    between = [f"{column} >= {a} and {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [first, *between, f"{column} >= {cuts[-1]}"]


def bucket_query(table: str, column: str, first: int, width: int, end: int) -> str:
    """Rows per bucket, counted by the database; a row per bucket comes back."""
    bucket = f"floor(({column} - {first}) / {float(width)})"
    return (
        f"(select {bucket} as bucket, count(*) as n from {table} "
        f"where {column} >= {first} and {column} < {end} group by {bucket}) as buckets"
    )


def read_table(
    spark: SparkSession,
    store: JdbcStore,
    table: str,
    column: str | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a table; with ``column``, over connections that read about equally many rows.

    The database counts the rows per range of the column first, so that gaps in the numbers
    and dense stretches do not leave some connections idle and others with most of the rows.
    """
    options = {**store.table(table), "fetchsize": str(fetch_size)}

    def ask(query: str) -> DataFrame:
        return spark.read.format("jdbc").options(**store.table(query)).load()

    if column:
        bounds = f"(select min({column}) as lo, max({column}) as hi, count(*) as n from {table}) as bounds"
        row = ask(bounds).first()
        if row.lo is not None:

            def count(first: int, width: int, end: int) -> dict[int, int]:
                found = ask(bucket_query(table, column, first, width, end)).collect()
                return {int(r.bucket): int(r.n) for r in found}

            # Ranges of a quarter of a connection's share make the shares even enough.
            most = max(1, int(row.n) // (4 * partitions))
            ranges = counted_ranges(count, int(row.lo), int(row.hi), most)
            predicates = range_predicates(column, ranges, partitions)
            properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
            return spark.read.jdbc(store.url, table, predicates=predicates, properties=properties)
    return spark.read.format("jdbc").options(**options).load()
