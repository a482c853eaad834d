import json
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from salesmart.schema import ENTITIES, FOREIGN_KEYS, MART_SCHEMAS, MART_SORT_KEYS, WAREHOUSE_TABLES
from salesmart.sinks import export, jdbc
from salesmart.sinks.jdbc import (
    clickhouse_ddl,
    postgres_column_types,
    postgres_ddl,
    postgres_table,
    without_nulls,
    write_clickhouse,
    write_options,
    write_postgres,
)
from salesmart.sinks.tables import append_dimension, write_fact, write_mart
from salesmart.session import BYTES_PER_PARTITION, initial_partitions, sized_side
from salesmart.sources.jdbc import (
    bucket_query,
    clickhouse,
    counted_ranges,
    partition_options,
    postgres,
    range_predicates,
)


def test_mart_is_replaced_and_sorted(spark, warehouse, tmp_path):
    sales = [
        {"customer_email": f"c{i}@example.com", "customer_country": f"C{i % 3}"} for i in range(30)
    ]
    mart = warehouse(*sales).plan("sales_by_customer")
    path = str(tmp_path / "mart")
    for _ in range(2):
        write_mart(mart, "sales_by_customer", path)
    stored = spark.read.parquet(path)
    assert rows(stored) == rows(mart.select(*stored.columns))
    assert stored.schema == MART_SCHEMAS["sales_by_customer"]
    for part in stored.groupBy(F.input_file_name().alias("f")).count().collect():
        inside = stored.where(F.input_file_name() == part.f)
        keys = [(r.country, r.customer_id) for r in inside.collect()]
        assert keys == sorted(keys)


@pytest.mark.parametrize("mart", MART_SCHEMAS)
def test_mart_plans_fit_the_stored_schema(warehouse, mart):
    frame = warehouse({}).plan(mart)
    assert frame.columns == MART_SCHEMAS[mart].fieldNames()
    assert [f.dataType for f in frame.schema] == [f.dataType for f in MART_SCHEMAS[mart]]
    assert set(MART_SORT_KEYS[mart]) <= set(frame.columns)


def test_fact_is_partitioned_by_year(spark, warehouse, tmp_path):
    w = warehouse({}, {"sale_date": "01/01/2020"}, {"sale_date": None})
    path = str(tmp_path / "fact")
    for _ in range(2):
        write_fact(w.plan("keyed"), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 3
    assert {r.sale_year for r in stored.select("sale_year").collect()} == {2021, 2020, None}
    plan = stored.where("sale_year = 2020")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sale_year" in plan


def test_dimension_append_is_idempotent(spark, warehouse, tmp_path):
    path = str(tmp_path / "dim")
    warehouse({}).plan("dim_customers").write.parquet(path)
    more = warehouse({}, {"customer_age": 77}).plan("dim_customers")
    for _ in range(2):
        append_dimension(spark, more, path)
    assert spark.read.parquet(path).count() == 2


def test_postgres_options():
    env = {"PG_HOST": "db", "PG_USER": "u", "PG_PASSWORD": "p"}
    store = postgres(env)
    assert store.url == "jdbc:postgresql://db:5432/main_db"
    options = write_options(store, "public.dim_cities", 8, 500)
    assert options == {
        "url": store.url,
        "dbtable": "public.dim_cities",
        "driver": "org.postgresql.Driver",
        "user": "u",
        "password": "p",
        "batchsize": "500",
        "numPartitions": "8",
    }
    assert "p" not in repr(store).split("url=")[1].replace(store.url, "")[:3]
    assert postgres({}).url == "jdbc:postgresql://postgres:5432/main_db"


@pytest.mark.parametrize("name", WAREHOUSE_TABLES)
def test_postgres_definitions_fit_the_frames(warehouse, name):
    frame = warehouse({}).plan(name)
    ddl = postgres_ddl(name, frame.schema)
    lines = [x.strip().rstrip(",") for x in ddl.split("\n")[1:-1]]
    assert [x.split()[0] for x in lines] == frame.columns
    assert sum("PRIMARY KEY" in x for x in lines) == 1
    targets = {x.split()[0]: x.split(" REFERENCES ")[1].split()[0] for x in lines if "REFERENCES" in x}
    assert targets == {k: postgres_table(d) for k, d in FOREIGN_KEYS.get(name, {}).items()}


def test_what_a_parent_empties_is_written_after_it():
    order = list(WAREHOUSE_TABLES)
    for table, keys in FOREIGN_KEYS.items():
        assert all(order.index(parent) < order.index(table) for parent in keys.values())


def test_postgres_write_empties_with_references(warehouse, monkeypatch):
    from pyspark.sql import DataFrameWriter

    seen = {}
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **o: seen.update(o) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: None)
    write_postgres(warehouse({}).plan("dim_countries"), postgres({}), "dim_countries")
    assert (seen["truncate"], seen["cascadeTruncate"]) == ("true", "true")
    assert seen["dbtable"] == "public.dim_countries"
    seen.clear()
    ran = []
    monkeypatch.setattr(jdbc, "run_statements", lambda spark, store, statements: ran.extend(statements))
    write_clickhouse(warehouse({}).plan("sales_by_time"), clickhouse({}), "sales_by_time")
    assert "truncate" not in seen and "MergeTree" in seen["createTableOptions"]
    # The mart itself is only touched by the exchange of names.
    assert seen["dbtable"] == "sales_by_time__next"
    assert ran[0].startswith("CREATE TABLE IF NOT EXISTS sales_by_time (")
    assert ran[1:] == ["EXCHANGE TABLES sales_by_time AND sales_by_time__next", "DROP TABLE sales_by_time__next"]


def test_clickhouse_options():
    store = clickhouse({"CH_PORT": "1"})
    assert store.url == "jdbc:clickhouse://clickhouse-server:1/analytics"
    assert store.table("m")["driver"] == "com.clickhouse.jdbc.ClickHouseDriver"


def test_partitioned_read_options():
    assert partition_options("id", 1, 100, 4) == {
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "100",
        "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        partition_options("id", 5, 1, 4)


IDS = {
    "even": range(10_000),
    "one stretch": [*range(500), *range(10**12, 10**12 + 9_500)],
    "growing gaps": [i**3 for i in range(-2_000, 2_000)],
    "one id": [7],
    "two far": [-(2**40), 2**40],
    "repeated": [*([5] * 3_000), *range(6, 1_006)],
}


@pytest.mark.parametrize("name", IDS)
def test_reads_are_split_by_counted_rows(spark, name):
    ids = list(IDS[name])
    asked = []

    def count(first, width, end):
        asked.append(width)
        found = {}
        for i in ids:
            if first <= i < end:
                found[(i - first) // width] = found.get((i - first) // width, 0) + 1
        return found

    partitions = 8
    most = max(1, len(ids) // (4 * partitions))
    ranges = counted_ranges(count, min(ids), max(ids), most)
    assert sum(n for _, _, n in ranges) == len(ids)
    predicates = range_predicates("id", ranges, partitions)
    assert len(predicates) <= partitions
    frame = spark.createDataFrame([(i,) for i in [*ids, None, min(ids) - 5, max(ids) + 5]], "id bigint")
    held = [frame.where(p) for p in predicates]
    sizes = [h.count() for h in held]
    assert sum(sizes) == len(ids) + 3
    assert rows(frame) == sorted((r for h in held for r in rows(h)), key=repr)
    if name not in ("repeated", "one id", "two far"):
        # Even ranges between smallest and largest would give most rows to one connection.
        assert max(sizes) <= 1.5 * len(ids) / partitions
    assert len(asked) < 200


def test_buckets_are_counted_by_the_database():
    query = bucket_query("t", "id", -5, 10, 100)
    assert query == (
        "(select floor((id - -5) / 10.0) as bucket, count(*) as n from t "
        "where id >= -5 and id < 100 group by floor((id - -5) / 10.0)) as buckets"
    )


def test_files_of_the_fact_are_narrow_in_three_columns(spark, tmp_path):
    """Part of the pieces of files that a filter on one value has to read, by their statistics."""
    import pyarrow.parquet as pq

    from salesmart.functions.keys import surrogate_key
    from salesmart.sinks.tables import fact_rows

    number = F.col("id")
    keyed = spark.range(60_000).select(
        number.alias("source_id"),
        *(surrogate_key(F.lit(c), F.pmod(F.xxhash64(number, F.lit(c)), F.lit(n))).alias(f"{c}_key")
          for c, n in (("customer", 999), ("seller", 5), ("product", 2000), ("store", 125), ("supplier", 100))),
        *(F.lit(True).alias(f"{c}_flag") for c in ("customer", "seller", "product", "store", "supplier")),
        F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.xxhash64(number), F.lit(366)).cast("int")).alias("sale_date"),
        *(F.lit(1).alias(c) for c in ("date_id", "product_quantity", "product_price", "sale_quantity", "total_price")),
    )
    names = {e.key: f"{e.name}_key" for e in ENTITIES.values()} | {e.flag: f"{e.name}_flag" for e in ENTITIES.values()}
    keyed = keyed.withColumnsRenamed({v: k for k, v in names.items()})
    small = {"parquet.block.size": "16384", "parquet.page.size.row.check.min": "50", "parquet.block.size.row.check.min": "100",
             "parquet.block.size.row.check.max": "100", "parquet.enable.dictionary": "false"}

    def share(frame, folder):
        frame.write.options(**small).partitionBy("sale_year").parquet(str(tmp_path / folder))
        groups = [
            pq.ParquetFile(f).metadata.row_group(g)
            for f in (tmp_path / folder).rglob("*.parquet")
            for g in range(pq.ParquetFile(f).num_row_groups)
        ]
        assert len(groups) >= 100
        found = {}
        for column in ("sale_date", "product_id", "store_id"):
            limits = [
                (c.statistics.min, c.statistics.max)
                for g in groups
                for c in (g.column(i) for i in range(g.num_columns))
                if c.path_in_schema == column
            ]
            values = [r[0] for r in frame.select(column).distinct().limit(100).collect()]
            reads = [sum(a <= v <= b for a, b in limits) / len(limits) for v in values]
            found[column] = sum(reads) / len(reads)
        return found

    ordered = fact_rows(keyed)
    clustered = share(ordered, "clustered")
    by_chance = ordered.withColumn("chance", F.xxhash64("source_id")).repartitionByRange(4, "chance")
    plain = share(by_chance.sortWithinPartitions("sale_year", "chance").drop("chance"), "plain")
    assert all(v > 0.9 for v in plain.values()), plain
    assert all(v < 0.35 for v in clustered.values()), clustered


def test_target_table_definitions(warehouse):
    assert postgres_table("dim_product_materials") == "public.dim_product_verbose"
    assert postgres_table("dim_cities") == "public.dim_cities"
    products = warehouse({}).plan("dim_products").schema
    assert postgres_column_types(products) == "name VARCHAR(64), description VARCHAR(1024)"
    ddl = clickhouse_ddl("sales_by_time")
    assert "total_revenue Decimal(24,2)" in ddl
    assert ddl.endswith("ENGINE = MergeTree() ORDER BY (year, month)")


def test_nulls_are_replaced_only_for_the_strict_store(warehouse):
    mart = warehouse({"customer_country": None}).plan("sales_by_customer")
    (row,) = without_nulls(mart).collect()
    assert row.country == ""
    assert row.total_spent == Decimal("20.00")
    assert without_nulls(mart).schema.fieldNames() == mart.columns


def test_documents_and_hashes(warehouse):
    w = warehouse({"customer_country": None})
    docs = {
        (r.collection, r.document_id): json.loads(r.body)
        for r in export.export_documents(w.table).collect()
    }
    assert len(docs) == 6
    month = docs[("sales_by_time", "2021-5")]
    assert month["total_revenue"] == "20.00"
    entries = {r.entry: r.fields for r in export.export_kv(w.table).collect()}
    assert entries["sales_by_time:2021-5"]["total_orders"] == "1"
    customer = next(v for k, v in entries.items() if k.startswith("sales_by_customer:"))
    assert "country" not in customer
    assert customer["total_spent"] == "20.00"


def test_graph_edges_meet_nodes(warehouse):
    w = warehouse({}, {"customer_email": "b@example.com", "customer_country": None})
    nodes = [r.node_id for r in export.export_nodes(w.table).collect()]
    assert len(nodes) == len(set(nodes))
    edges = export.export_edges(w.table).collect()
    assert {r.relation for r in edges} == {"IN_CATEGORY", "IN_CITY", "IN_COUNTRY"}
    assert all(r.from_id in nodes and r.to_id in nodes for r in edges)


def test_broadcast_needs_few_bytes_and_few_rows(spark, tmp_path):
    path = str(tmp_path / "side")
    spark.range(300_000).write.parquet(path)
    sales = spark.range(100).withColumnRenamed("id", "sale")

    def joined(width):
        side = spark.read.parquet(path)
        plan = sales.join(sized_side(side, [side], width), F.col("sale") == F.col("id"))
        return plan._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in joined(1)
    assert "SortMergeJoin" in joined(4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        assert "SortMergeJoin" in joined(1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitions_grow_with_the_input():
    assert initial_partitions(10, 200) == 200
    assert initial_partitions(100 * 1024**4, 200) == 100 * 1024**4 // BYTES_PER_PARTITION
