"""One part and one order hold a third of the sales each; joins are shuffled and split."""

import duckdb
import pytest
from conftest import rows

import oracle_queries
from salesmart.plans.warehouse import Warehouse
from salesmart.sources.retail import TABLES, retail_source

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4000",
    "spark.sql.files.maxPartitionBytes": "30000",
    "spark.sql.files.openCostInBytes": "1",
}
HOT = """
select case when l_linenumber % 3 = 0 then 8 else l_orderkey end as l_orderkey,
       case when l_linenumber % 3 = 1 then 5 else l_partkey end as l_partkey,
       * exclude (l_orderkey, l_partkey)
from read_parquet('{}')"""


@pytest.fixture
def skewed(spark, testdata, tmp_path):
    connection = duckdb.connect()
    for table in TABLES:
        source, target = f"{testdata}/{table}.parquet", f"{tmp_path}/{table}.parquet"
        query = HOT if table == "lineitem" else "select * from read_parquet('{}')"
        connection.execute(
            f"copy ({query.format(source)}) to '{target}' (row_group_size 2048)"
        )
        connection.execute(f"create view {table} as select * from read_parquet('{target}')")
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield str(tmp_path), connection
    for name in SETTINGS:
        spark.conf.unset(name)


def test_hot_keys_are_split_and_results_stay_whole(spark, skewed, tmp_path):
    path, connection = skewed
    source = retail_source(spark, path)
    keyed = source.keyed
    ((sales,),) = connection.execute("select count(*) from lineitem").fetchall()
    assert len(keyed.collect()) == sales
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert "skew=true" in final and "BroadcastHashJoin" not in final

    warehouse = Warehouse(spark, source, str(tmp_path / "w"))
    sql = oracle_queries.oracle_sql()
    for name in ("fact_sales", "sales_by_product", "sales_by_supplier", "dim_products"):
        frame = warehouse.plan(name)
        result = connection.execute(sql[name])
        columns = [d[0] for d in result.description]
        expected = [tuple(r[columns.index(c)] for c in frame.columns) for r in result.fetchall()]
        assert rows(frame) == sorted(expected, key=repr)
