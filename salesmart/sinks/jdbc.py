"""JDBC sinks: table definitions and full-refresh writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schema import FOREIGN_KEYS, MART_SCHEMAS, MART_SORT_KEYS
from salesmart.sources.jdbc import JdbcStore

# Names that differ between the warehouse and the PostgreSQL schema.
POSTGRES_TABLES = {"dim_product_materials": "dim_product_verbose", "fact_sales": "facts_sales"}

# Text widths of the PostgreSQL columns that are not VARCHAR(64).
POSTGRES_WIDTHS = {"description": 1024}

POSTGRES_TYPES = {
    T.LongType: "BIGINT",
    T.IntegerType: "INTEGER",
    T.FloatType: "REAL",
    T.DoubleType: "DOUBLE PRECISION",
    T.DateType: "DATE",
}

CLICKHOUSE_TYPES = {
    T.LongType: "Int64",
    T.IntegerType: "Int32",
    T.DoubleType: "Float64",
    T.StringType: "String",
    T.DateType: "Date",
}


def postgres_table(name: str) -> str:
    return f"public.{POSTGRES_TABLES.get(name, name)}"


def postgres_column_types(schema: T.StructType) -> str:
    """Text columns with the widths of the target schema, for ``createTableColumnTypes``."""
    return ", ".join(
        f"{f.name} VARCHAR({POSTGRES_WIDTHS.get(f.name, 64)})"
        for f in schema
        if isinstance(f.dataType, T.StringType)
    )


def postgres_type(field: T.StructField) -> str:
    if isinstance(field.dataType, T.DecimalType):
        return f"NUMERIC({field.dataType.precision},{field.dataType.scale})"
    if isinstance(field.dataType, T.StringType):
        return f"VARCHAR({POSTGRES_WIDTHS.get(field.name, 64)})"
    return POSTGRES_TYPES[type(field.dataType)]


def postgres_ddl(name: str, schema: T.StructType) -> str:
    """CREATE TABLE of a dimension or the fact, with its key and its references.

    ``schema`` is that of the frame to be written, so that the columns agree. To
    be run once, in the order of ``WAREHOUSE_TABLES``: parents come first.
    """
    key = "source_id" if name == "fact_sales" else "id"
    references = FOREIGN_KEYS.get(name, {})
    columns = []
    for field in schema:
        text = f"{field.name} {postgres_type(field)}"
        if field.name == key:
            text += " PRIMARY KEY"
        if field.name in references:
            text += f" REFERENCES {postgres_table(references[field.name])} (id)"
        columns.append(text)
    body = ",\n    ".join(columns)
    return f"CREATE TABLE IF NOT EXISTS {postgres_table(name)} (\n    {body}\n)"


def write_options(store: JdbcStore, table: str, connections: int, batch: int) -> dict[str, str]:
    """Options of a full refresh over ``connections`` connections."""
    return {
        **store.table(table),
        "batchsize": str(batch),
        "numPartitions": str(connections),
    }


def write_postgres(
    frame: DataFrame, store: JdbcStore, name: str, connections: int = 16, batch: int = 10_000
) -> None:
    """Replace the rows of a table; the table, its keys and its grants stay.

    PostgreSQL empties a table that others refer to only together with those, so
    a refresh writes all tables in the order of ``WAREHOUSE_TABLES``: what a
    parent empties is written after it.
    """
    options = write_options(store, postgres_table(name), connections, batch)
    options |= {"truncate": "true", "cascadeTruncate": "true"}
    widths = postgres_column_types(frame.schema)
    if widths:
        options["createTableColumnTypes"] = widths
    # Only the insert runs on so few tasks, not the stage that computes the rows.
    dealt = frame.repartition(connections)
    dealt.write.format("jdbc").options(**options).mode("overwrite").save()


def clickhouse_type(field: T.StructField) -> str:
    if isinstance(field.dataType, T.DecimalType):
        return f"Decimal({field.dataType.precision},{field.dataType.scale})"
    return CLICKHOUSE_TYPES[type(field.dataType)]


def clickhouse_ddl(mart: str) -> str:
    """CREATE TABLE of a mart. Its columns take no NULL, see ``without_nulls``."""
    columns = ",\n    ".join(f"{f.name} {clickhouse_type(f)}" for f in MART_SCHEMAS[mart])
    return (
        f"CREATE TABLE IF NOT EXISTS {mart} (\n    {columns}\n) "
        f"ENGINE = MergeTree() ORDER BY ({', '.join(MART_SORT_KEYS[mart])})"
    )


def without_nulls(frame: DataFrame) -> DataFrame:
    """Empty text and zero instead of NULL, for a store whose columns take none."""
    return frame.select(
        *(
            F.coalesce(
                F.col(f.name),
                F.lit("" if isinstance(f.dataType, T.StringType) else 0).cast(f.dataType),
            ).alias(f.name)
            for f in frame.schema
        )
    )


def next_table(mart: str) -> str:
    return f"{mart}__next"


def exchange_statements(mart: str) -> list[str]:
    """Put the new rows in the mart's place at once, and drop the old ones."""
    after = next_table(mart)
    return [
        clickhouse_ddl(mart),
        f"EXCHANGE TABLES {mart} AND {after}",
        f"DROP TABLE {after}",
    ]


def run_statements(spark: SparkSession, store: JdbcStore, statements: list[str]) -> None:
    """Run SQL by the driver's own connection; no rows go through it."""
    jvm = spark._jvm
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(store.options["driver"])
    properties = jvm.java.util.Properties()
    for name in ("user", "password"):
        if name in store.options:
            properties.setProperty(name, store.options[name])
    connection = jvm.java.sql.DriverManager.getConnection(store.url, properties)
    try:
        statement = connection.createStatement()
        for text in statements:
            statement.execute(text)
    finally:
        connection.close()


def write_clickhouse(
    frame: DataFrame, store: JdbcStore, mart: str, connections: int = 16, batch: int = 100_000
) -> None:
    """Replace a mart without a moment in which readers find no table or half of one.

    The rows go to a second table, which is made anew with Spark's column types and this
    engine; then the two change names. A run that dies leaves the mart as it was, and its
    second table is replaced by the next run.
    """
    options = write_options(store, next_table(mart), connections, batch)
    options["createTableOptions"] = (
        f"ENGINE = MergeTree() ORDER BY ({', '.join(MART_SORT_KEYS[mart])})"
    )
    dealt = without_nulls(frame).repartition(connections)
    dealt.write.format("jdbc").options(**options).mode("overwrite").save()
    run_statements(frame.sparkSession, store, exchange_statements(mart))
