"""spark-submit: snowflake tables -> the six marts, as a full refresh.

Marts of tables in a folder are made of the sums that each load of the tables has left, so
no sale is read, and are one version of the target folder together.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from salesmart.plans.marts import MARTS, MARTS_OF_SUMS
from salesmart.plans.sums import SUMS
from salesmart.session import build_session, scan_bytes, size_shuffles
from salesmart.sinks.jdbc import postgres_table, write_clickhouse
from salesmart.sinks.snapshots import Attempt, Snapshot, reader, remove_old, snapshot
from salesmart.sinks.tables import mart_rows
from salesmart.sources.jdbc import clickhouse, postgres, read_table


def file_reader(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """Reads the tables, or marts, that are the last version of a folder now."""
    return reader(spark, folder)


def postgres_reader(spark: SparkSession) -> Callable[[str], DataFrame]:
    store = postgres()
    # The dimensions have a numeric id to split their reads by, the fact its source id.
    return lambda name: read_table(
        spark, store, postgres_table(name), column="source_id" if name == "fact_sales" else "id"
    )


def store_files(spark: SparkSession, tables: str, target: str) -> Snapshot | None:
    """All marts of the tables' last version; None if the target holds them already.

    They are written at once: most are small and would leave the cluster idle one by one.
    """
    attempt = Attempt(spark, target, refresh=True)
    version = snapshot(spark, tables).version
    made_of = {"tables": tables, "version": version}
    if attempt.base.notes == made_of:
        return None
    read = reader(spark, tables, version)
    with ThreadPoolExecutor(len(MARTS_OF_SUMS)) as pool:
        list(pool.map(lambda m: attempt.replace(m, mart_rows(MARTS_OF_SUMS[m](read), m)), MARTS_OF_SUMS))
    attempt.notes |= made_of
    return attempt.commit()


def store_clickhouse(read: Callable[[str], DataFrame], marts=MARTS) -> None:
    store = clickhouse()
    for name, build in marts.items():
        write_clickhouse(build(read), store, name)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--tables", help="folder of the snowflake tables")
    source.add_argument("--postgres", action="store_true", help="read them from PostgreSQL")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--target", help="folder for the marts")
    target.add_argument("--clickhouse", action="store_true", help="write to ClickHouse")
    args = parser.parse_args()
    spark = build_session("build marts")
    if args.tables:
        read = file_reader(spark, args.tables)
        size_shuffles(spark, scan_bytes(read(SUMS)))
        if args.clickhouse:
            store_clickhouse(read, MARTS_OF_SUMS)
        else:
            store_files(spark, args.tables, args.target)
            remove_old(spark, args.target)
    else:
        read = postgres_reader(spark)
        if args.clickhouse:
            store_clickhouse(read)
        else:
            attempt = Attempt(spark, args.target, refresh=True)
            for name, build in MARTS.items():
                attempt.replace(name, mart_rows(build(read), name))
            attempt.commit()
    spark.stop()


if __name__ == "__main__":
    main()
