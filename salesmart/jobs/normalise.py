"""spark-submit: staged sales -> the 18 snowflake tables, as a full refresh or with the next files.

Tables in a folder are versions (see ``sinks/snapshots.py``): readers see all tables of one
version, and a run that dies leaves the version before. A version is committed only if the
rules of ``plans/gates.py`` hold. It notes which staged loads it holds; ``--add`` reads the
others only, adds their new members, their sales and the sums of these sales.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from decimal import Decimal
from itertools import count

from pyspark.sql import SparkSession

from salesmart.functions.keys import PLAIN, Keys
from salesmart.operators.upsert import unseen_keys
from salesmart.plans.collisions import from_note, noted, settled
from salesmart.plans.gates import enforce, fact_metrics
from salesmart.plans.sums import SUMS, merged, sums_of
from salesmart.plans.warehouse import Warehouse
from salesmart.schema import DIMENSIONS, FLAT_COLUMNS
from salesmart.session import build_session, remove_folder, scan_bytes, shared_folder
from salesmart.sinks.jdbc import write_postgres
from salesmart.sinks.registry import IDS, register
from salesmart.sinks.snapshots import Attempt, Snapshot, remove_old
from salesmart.sinks.tables import fact_rows, read_staging, staged_loads
from salesmart.sources.base import SalesSource, from_flat
from salesmart.sources.jdbc import postgres, read_table

# Notes of a version: the staged loads that it holds, and how its keys are computed.
STAGED, KEYS = "staged", "keys"

# The sales take longest: they come first, and the dimensions are written while they are.
LONGEST_FIRST = ("fact_sales", *DIMENSIONS)

# A warehouse whose keys are computed in a given way.
Make = Callable[[Keys], Warehouse]


def expected_of(loads: dict[str, dict], parts: Sequence[str]) -> dict[str, int | Decimal]:
    """Rows and money that the loads have noted."""
    noted = [loads[p] for p in parts]
    return {
        "rows": sum(n["rows_loaded"] for n in noted),
        "revenue": sum((Decimal(n["revenue"]) for n in noted), Decimal(0)),
    }


def _by_year(writer):
    return writer.partitionBy("sale_year")


def write_sales(attempt: Attempt, warehouse: Warehouse, write) -> None:
    """The fact and, from what was written, its sums per foreign key."""
    write("fact_sales", fact_rows(warehouse.table("keyed")), _by_year, **fact_metrics())
    # Six roles of very different numbers of members: one file per role or few more.
    by_role = lambda w: w.partitionBy("role")
    sums = sums_of(attempt.added("fact_sales")).hint("rebalance", "role")
    if write == attempt.add:
        attempt.add(SUMS, sums, by_role, merge=lambda s: merged(s).hint("rebalance", "role"))
    else:
        attempt.replace(SUMS, sums, by_role)


def store_files(
    make: Make,
    target: str,
    staged: Sequence[str] | None = None,
    expected: dict[str, int | Decimal] | None = None,
    ids: bool = False,
) -> Snapshot:
    """Replace all tables at once; ``staged`` are the loads they are made of.

    With ``ids``, or where the target has them already, members have dense ids that stay.
    """
    warehouse = settled(make)
    attempt = Attempt(warehouse.spark, target, refresh=True)

    def replace(name: str) -> None:
        if name == "fact_sales":
            write_sales(attempt, warehouse, attempt.replace)
        else:
            attempt.replace(name, warehouse.table(name))

    warehouse.store(LONGEST_FIRST, replace)
    enforce(attempt, expected)
    if ids or IDS in attempt.base.tables:
        register(attempt)
    if staged is not None:
        attempt.notes[STAGED] = list(staged)
    attempt.notes[KEYS] = noted(warehouse.source.keys)
    return attempt.commit()


def add_sales(
    make: Make,
    attempt: Attempt,
    expected: dict[str, int | Decimal] | None = None,
    ids: bool = False,
) -> Snapshot:
    """Add sales that the tables do not hold, with their members and their sums."""
    warehouse = settled(make, from_note(attempt.notes.get(KEYS)), attempt.read)

    def add(name: str) -> None:
        if name == "fact_sales":
            write_sales(attempt, warehouse, attempt.add)
            return
        unseen = unseen_keys(warehouse.table(name), attempt.read(name))
        attempt.add(name, unseen, merge=lambda rows: rows)

    warehouse.store(LONGEST_FIRST, add)
    enforce(attempt, expected)
    if ids or IDS in attempt.base.tables:
        register(attempt)
    attempt.notes[KEYS] = noted(warehouse.source.keys)
    return attempt.commit()


def _staged(spark: SparkSession, staging: str, parts: Sequence[str], work: str | None) -> Make:
    rounds = count()

    def make(keys: Keys) -> Warehouse:
        root = work and f"{work}/{next(rounds)}"
        return Warehouse(spark, staged_source(spark, staging, parts, keys), root)

    return make


def add_files(
    spark: SparkSession, staging: str, target: str, work: str | None, ids: bool = False
) -> Snapshot | None:
    """Add the staged loads that the tables do not hold; None if there are none."""
    attempt = Attempt(spark, target)
    if STAGED not in attempt.notes:
        raise ValueError(f"{target} does not tell which files it holds: refresh it first")
    loads = staged_loads(spark, staging)
    parts = [p for p in loads if p not in attempt.notes[STAGED]]
    if not parts:
        return None
    attempt.notes[STAGED] = [*attempt.notes[STAGED], *parts]
    return add_sales(_staged(spark, staging, parts, work), attempt, expected_of(loads, parts), ids)


def refresh_files(
    spark: SparkSession, staging: str, target: str, work: str | None, ids: bool = False
) -> Snapshot:
    """Build all tables from all that is staged."""
    loads = staged_loads(spark, staging)
    parts = [*loads]
    return store_files(_staged(spark, staging, parts, work), target, parts, expected_of(loads, parts), ids)


def store_postgres(warehouse: Warehouse) -> None:
    store = postgres()
    for name in (*DIMENSIONS, "fact_sales"):
        write_postgres(warehouse.plan(name), store, name)


def staged_source(
    spark: SparkSession, staging: str, parts: Sequence[str] | None = None, keys: Keys = PLAIN
) -> SalesSource:
    rows = read_staging(spark, staging, parts)
    sales = rows.where("status = 'loaded'").select(*FLAT_COLUMNS)
    return from_flat(sales, scan_bytes(rows), keys)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--staging", help="folder of the staging table")
    source.add_argument("--table", help="staging table in PostgreSQL (PG_* environment)")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--target", help="folder for the tables")
    target.add_argument("--postgres", action="store_true", help="write to PostgreSQL")
    parser.add_argument("--add", action="store_true", help="add the files that are not there yet")
    parser.add_argument("--ids", action="store_true", help="number the members 1, 2, 3 ..")
    args = parser.parse_args()
    if args.add and not (args.staging and args.target):
        parser.error("--add goes from --staging to --target")
    spark = build_session("normalise sales")
    # Intermediate tables are stored wherever the job runs, and removed when it is done.
    shared = shared_folder(spark) or args.target
    work = shared and f"{shared.rstrip('/')}/_work-{spark.sparkContext.applicationId}"
    if args.add:
        add_files(spark, args.staging, args.target, work, args.ids)
    elif args.staging and args.target:
        refresh_files(spark, args.staging, args.target, work, args.ids)
    else:
        if args.staging:
            sales = staged_source(spark, args.staging)
        else:
            sales = from_flat(read_table(spark, postgres(), args.table, column="id"))
        if args.postgres:
            store_postgres(Warehouse(spark, sales, work))
        else:
            rounds = count()
            make = lambda keys: Warehouse(
                spark, from_flat(sales.flat, sales.input_bytes, keys), f"{work}/{next(rounds)}"
            )
            store_files(make, args.target, ids=args.ids)
    if args.target:
        remove_old(spark, args.target)
    if work:
        remove_folder(spark, work)
    spark.stop()


if __name__ == "__main__":
    main()
