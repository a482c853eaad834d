"""Random flat rows full of NULLs and clashes, against the same SQL as the real data."""

import random
from decimal import Decimal

import duckdb
import pandas as pd
import pytest
from conftest import BASE

import __spark_entry__ as entry
import oracle_queries
from salesmart.plans.marts import MARTS
from salesmart.plans.quality import CHECKS
from salesmart.plans.reports import REPORTS
from salesmart.plans.warehouse import Warehouse
from salesmart.schema import FLAT_SCHEMA, WAREHOUSE_TABLES
from salesmart.sinks.export import EXPORTS
from salesmart.sources.base import from_flat

NAMES = [*WAREHOUSE_TABLES, *MARTS, *REPORTS, *CHECKS, *EXPORTS]


def random_value(rng, column):
    if rng.random() < 0.12:
        return None
    if column == "id":
        return rng.randrange(100)
    if column.endswith("_date"):
        return f"{rng.randint(1, 12):02}/{rng.randint(1, 3):02}/{rng.choice([2020, 2021])}"
    if column in ("product_price", "sale_total_price"):
        return Decimal(rng.randrange(0, 100_000)) / 100
    if column in ("product_weight", "product_rating"):
        return rng.randrange(2, 10) / 2
    if isinstance(BASE[column], int):
        return rng.randrange(5)
    return rng.choice(["a", "b", "é", "", "x y", "it's", 'q"q', "\\", chr(31), "n"])


@pytest.fixture(scope="module", params=[1, 2])
def both(request, spark, tmp_path_factory):
    rng = random.Random(request.param)
    rows = [tuple(random_value(rng, c) for c in BASE) for _ in range(150)]
    flat = spark.createDataFrame(rows, FLAT_SCHEMA).repartition(3)
    root = tmp_path_factory.mktemp("random")
    warehouse = Warehouse(spark, from_flat(flat), str(root / "w"))
    flat.write.parquet(str(root / "flat"))
    connection = duckdb.connect()
    connection.execute(
        f"create table flat_rows as select * from read_parquet('{root}/flat/*.parquet')"
    )
    # What the reconciliation reads before any join.
    connection.execute(
        "create view lineitem as select sale_total_price as l_extendedprice from flat_rows"
    )
    return warehouse, connection


def normal(row):
    return tuple((pd.isna(v), str(v)) for v in row)


@pytest.mark.parametrize("name", NAMES)
def test_random_rows_equal_sql(both, name):
    warehouse, connection = both
    builders = {**REPORTS, **CHECKS, **EXPORTS}
    if name in builders:
        frame = builders[name](warehouse.table)
    else:
        frame = warehouse.plan(name)
    sql = entry.oracle_sql()[name]
    assert oracle_queries.FLAT in sql
    result = connection.execute(
        sql.replace(oracle_queries.FLAT, "flat AS (SELECT * FROM flat_rows)")
    )
    columns = [d[0] for d in result.description]
    expected = sorted(
        normal(r[columns.index(c)] for c in frame.columns) for r in result.fetchall()
    )
    assert sorted(normal(r) for r in frame.collect()) == expected
