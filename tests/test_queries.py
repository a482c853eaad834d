"""Every registered query against its SQL, and what its plan may not contain."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

# The corpus operators have tests of their own, in tests/llm.
CORPUS = re.compile(r"op\d+_|pipeline$")
QUERIES = {n: q for n, q in entry.queries().items() if not CORPUS.match(n)}
ORACLE = {n: q for n, q in entry.oracle_sql().items() if not CORPUS.match(n)}


@pytest.fixture(scope="session")
def duck(testdata):
    connection = duckdb.connect()
    for file in os.listdir(testdata):
        name = file.removesuffix(".parquet")
        connection.execute(
            f"create view {name} as select * from read_parquet('{testdata}/{file}')"
        )
    return connection


def test_every_query_has_an_expectation():
    assert set(QUERIES) == set(ORACLE)


def normal(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, testdata, name):
    frame = QUERIES[name](spark, testdata)
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    expected = sorted(
        normal(r[columns.index(c)] for c in frame.columns) for r in result.fetchall()
    )
    assert sorted(normal(r) for r in frame.collect()) == expected
    assert expected


@pytest.mark.parametrize("name", QUERIES)
def test_plan_has_no_cross_join_and_no_python(spark, testdata, name):
    plan = QUERIES[name](spark, testdata)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in plan, operator


def test_keyed_rows_read_the_sales_once_and_only_needed_columns(spark, testdata):
    from salesmart.sources.retail import retail_source

    source = retail_source(spark, testdata)
    plan = source.keyed._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    sales = [s for s in scans if "l_orderkey" in s]
    assert len(sales) == 1
    assert "l_discount" not in sales[0] and "l_shipdate" not in sales[0]


def test_entry(spark, testdata):
    assert entry.entry(spark).columns == ["category", "total_revenue", "total_quantity"]
