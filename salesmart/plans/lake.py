"""Tables that grow by loads, from one sales input: a refresh with its first years, then the rest."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.keys import Keys
from salesmart.plans.warehouse import Warehouse
from salesmart.sinks.snapshots import Attempt, Snapshot

# First days of the second and third load.
LOAD_DAYS = ("1997-01-01", "1999-01-01")


def load_number() -> Column:
    """1, 2 or 3; sales without a day come last."""
    day = F.col("sale_date")
    first, second = (F.lit(d).cast("date") for d in LOAD_DAYS)
    return F.when(day < first, 1).when(day < second, 2).otherwise(3)


def of_loads(warehouse: Warehouse, *numbers: int) -> Callable[[Keys], Warehouse]:
    """The warehouse of some loads' sales. It has the keys of the whole one, whatever is asked."""

    def make(_keys: Keys) -> Warehouse:
        sales = warehouse.table("keyed").where(load_number().isin(*numbers))
        name = "-".join(map(str, numbers))
        return Warehouse(
            warehouse.spark, replace(warehouse.source, keyed=sales), f"{warehouse.root}/loads-{name}"
        )

    return make


def stopped_refresh(spark: SparkSession, folder: str, rows: DataFrame) -> None:
    """What a refresh leaves that dies after a table."""
    Attempt(spark, folder, refresh=True).replace("dim_countries", rows)


def grown(warehouse: Warehouse, folder: str, ids: bool = True) -> list[Snapshot]:
    """Three loads, one after another."""
    from salesmart.jobs.normalise import add_sales, store_files

    done = [store_files(of_loads(warehouse, 1), folder, ids=ids)]
    for number in (2, 3):
        attempt = Attempt(warehouse.spark, folder)
        done.append(add_sales(of_loads(warehouse, number), attempt))
    return done
