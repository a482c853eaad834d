
from __future__ import annotations

import sys
import warnings
from collections.abc import Callable
from functools import partial, reduce
from itertools import count
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle_queries  # noqa: E402
from salesmart.functions.clean import money, parse_date  # noqa: E402
from salesmart.functions.keys import Keys  # noqa: E402
from salesmart.jobs.normalise import store_files  # noqa: E402
from salesmart.operators.dense import dense_ids, with_dense_keys  # noqa: E402
from salesmart.operators.distinct import first_per_key, union_distinct  # noqa: E402
from salesmart.operators.facts import fact_sales_by_lookup  # noqa: E402
from salesmart.operators.upsert import unseen_members  # noqa: E402
from salesmart.plans.collisions import settled  # noqa: E402
from salesmart.plans.digests import dq_digest  # noqa: E402
from salesmart.plans.feed import unpad, write_feed  # noqa: E402
from salesmart.plans.lake import grown, of_loads, stopped_refresh  # noqa: E402
from salesmart.plans.marts import MARTS, MARTS_OF_SUMS  # noqa: E402
from salesmart.plans.quality import CHECKS, dq_bad_rows  # noqa: E402
from salesmart.plans.reports import REPORTS  # noqa: E402
from salesmart.plans.warehouse import Warehouse, shared_warehouse  # noqa: E402
from salesmart.schema import (  # noqa: E402
    DATE_COLUMNS,
    ENTITIES,
    FOREIGN_KEYS,
    MONEY,
    PET_ATTRIBUTES,
    WAREHOUSE_TABLES,
)
from salesmart.session import DROP_SHUFFLES, SETTINGS, with_settings  # noqa: E402
from salesmart.sinks.changes import EXPORT_KEYS, applied, changes  # noqa: E402
from salesmart.sinks.export import EXPORTS  # noqa: E402
from salesmart.sinks.registry import IDS  # noqa: E402
from salesmart.sinks.snapshots import reader  # noqa: E402
from salesmart.sinks.tables import (  # noqa: E402
    LoadAudit,
    load_csv,
    read_staging,
    staged_sales,
    write_fact,
    write_mart,
)
from salesmart.sources.base import from_flat  # noqa: E402
from salesmart.sources.retail import retail_source  # noqa: E402

# The corpus operators and their pipeline are optional: without their folder the rest works.
try:
    import corpus_pipeline
    import salesmart.llm.queries as llm_queries
except ImportError as missing:
    # Their folder, or a package that only they need: the sales queries do without.
    warnings.warn(f"no corpus queries: {missing}", stacklevel=1)
    llm_queries = corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

# Mart -> its row key, revenue and quantity, for results that hold all marts.
MART_SHAPES = {
    "sales_by_product": ("product_id", "total_revenue", "total_quantity"),
    "sales_by_customer": ("customer_id", "total_spent", "null"),
    "sales_by_time": ("year * 100 + month", "total_revenue", "total_orders"),
    "sales_by_store": ("store_id", "total_revenue", "null"),
    "sales_by_supplier": ("supplier_id", "total_revenue", "null"),
    "product_quality": ("product_id", "null", "total_quantity"),
}
# Mart -> columns that do not come from keys.
NAMED_MARTS = {
    "sales_by_product": ("product_name", "category", "total_revenue", "total_quantity"),
    "sales_by_customer": ("customer_name", "country", "total_spent", "avg_order_value"),
    "sales_by_store": ("store_name", "city", "country", "total_revenue"),
}
NUMBERED = ("dim_customers", "dim_products", "dim_dates")
SHORT_BITS = 16

_SKEW = "spark.sql.adaptive.forceOptimizeSkewedJoin"
_LARGE = "spark.sql.codegen.hugeMethodLimit"


def _warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    for name in (_SKEW, _LARGE):
        spark.conf.set(name, SETTINGS[name])
    return shared_warehouse(spark, sf_dir, retail_source)


def _table(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _warehouse(spark, sf_dir).plan(name)


def _report(build, spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(_warehouse(spark, sf_dir).table)


def _clean_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date text of the sales, padded, un-padded and damaged, with its date."""
    text = F.col("text")
    texts = union_distinct(_table("flat", spark, sf_dir), DATE_COLUMNS, "text")
    forms = F.array(
        text,
        unpad(text),
        F.concat(F.lit("13"), F.substring(text, 3, 8)),
        F.substring(text, 7, 4),
    )
    variants = texts.select(F.explode(forms).alias("date_text")).distinct()
    return variants.withColumn("parsed_date", parse_date(F.col("date_text")))


_LOADS: dict[tuple[str, str], tuple[str, LoadAudit]] = {}


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[str, LoadAudit]:
    """All sales written as a CSV feed with faults in it, then loaded into staging."""
    warehouse = _warehouse(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADS:
        if warehouse.root is None:
            raise ValueError("loading files needs a shared folder: set spark.checkpoint.dir")
        feed, staging = f"{warehouse.root}/feed", f"{warehouse.root}/staging"
        with with_settings(spark, DROP_SHUFFLES):
            write_feed(warehouse.kept("flat"), feed)
        _LOADS[key] = (staging, load_csv(spark, feed, staging))
    return _LOADS[key]


def _load_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging, _ = _loaded(spark, sf_dir)
    return staged_sales(spark, staging).withColumn(
        "product_rating", F.col("product_rating").cast("decimal(2,1)")
    )


def _load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, audit = _loaded(spark, sf_dir)
    return spark.createDataFrame(
        [(audit.rows_read, audit.rows_loaded, audit.rows_rejected)],
        "rows_read bigint, rows_loaded bigint, rows_rejected bigint",
    )


def _bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging, _ = _loaded(spark, sf_dir)
    return dq_bad_rows(read_staging(spark, staging))


def _dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = _warehouse(spark, sf_dir).table("dim_products").select("id", "name")
    return dense_ids(products)


def _dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of the first month as stored, then those the later sales add."""
    warehouse = _warehouse(spark, sf_dir)
    product, keyed = ENTITIES["product"], warehouse.table("keyed")

    def members(sales: DataFrame) -> DataFrame:
        found = warehouse.source.members(product, sales)
        return found.select(F.col(product.key).alias("id"), "name")

    first = F.coalesce(F.col("sale_date") < "1995-02-01", F.lit(False))
    stored = members(keyed.where(first))
    added = unseen_members(members(keyed.where(~first)), stored)
    return stored.withColumn("origin", F.lit("stored")).unionByName(
        added.withColumn("origin", F.lit("added"))
    )


def _fact_sales_by_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _warehouse(spark, sf_dir)

    def dense(name: str) -> DataFrame:
        if name == "date":
            return dense_ids(warehouse.table("dim_dates"))
        entity = ENTITIES[name]
        members = warehouse.table(f"members_{name}")
        return dense_ids(members, entity.key, tuple(entity.attributes))

    return fact_sales_by_lookup(warehouse.plan("flat"), dense)


def _dim_dense(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension with dense ids of its own and of every lookup it refers to."""
    read = _warehouse(spark, sf_dir).table
    numbered = {d: dense_ids(read(d)) for d in set(FOREIGN_KEYS[name].values())}
    members = read(name)
    foreign_keys = {fk: numbered[d] for fk, d in FOREIGN_KEYS[name].items()}
    return with_dense_keys(members, foreign_keys, own=dense_ids(members))


def _fact_sales_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with dense ids; only 8-byte keys are joined."""
    read = _warehouse(spark, sf_dir).table
    numbered = {fk: dense_ids(read(d)) for fk, d in FOREIGN_KEYS["fact_sales"].items()}
    return with_dense_keys(read("fact_sales"), numbered)


def _pet_first_sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sale per distinct pet: the one with the smallest source id."""
    read = _warehouse(spark, sf_dir).table
    customer = ENTITIES["customer"].key
    sales = read("keyed").select(customer, "source_id")
    per_customer = first_per_key(sales, [customer], ["source_id"])
    pets = per_customer.join(read("members_customer").select(customer, *PET_ATTRIBUTES), customer)
    return first_per_key(pets.drop(customer), list(PET_ATTRIBUTES), ["source_id"])


def _stored(spark: SparkSession, sf_dir: str, name: str) -> str:
    root = _warehouse(spark, sf_dir).root
    if root is None:
        raise ValueError("stored tables need a shared folder: set spark.checkpoint.dir")
    return f"{root}/stored/{name}"


def _write_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer mart as stored, sorted by country and customer."""
    path = _stored(spark, sf_dir, "sales_by_customer")
    write_mart(_table("sales_by_customer", spark, sf_dir), "sales_by_customer", path)
    return spark.read.parquet(path)


def _write_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per year, read from the fact as stored, partitioned by year."""
    path = _stored(spark, sf_dir, "fact_sales")
    write_fact(_warehouse(spark, sf_dir).table("keyed"), path)
    yearly = spark.read.parquet(path).groupBy("sale_year")
    return yearly.agg(F.count("*").alias("row_count"), money(F.sum("total_price")).alias("revenue"))


_LAKES: dict[tuple[str, str], str] = {}


def _lake(spark: SparkSession, sf_dir: str) -> str:
    """Tables after a refresh and two loads that were added, with dense ids."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        folder = _stored(spark, sf_dir, "lake")
        grown(_warehouse(spark, sf_dir), folder)
        _LAKES[key] = folder
    return _LAKES[key]


def _refresh_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table after a refresh, one that stopped half-way, and one with all sales."""
    folder, warehouse = _stored(spark, sf_dir, "refreshed"), _warehouse(spark, sf_dir)
    store_files(of_loads(warehouse, 1), folder)
    stopped_refresh(spark, folder, warehouse.table("dim_countries").limit(1))
    version = store_files(of_loads(warehouse, 1, 2, 3), folder).version
    read = reader(spark, folder)
    counts = [
        read(t).agg(F.lit(t).alias("table_name"), F.count("*").alias("row_count"))
        for t in WAREHOUSE_TABLES
    ]
    return reduce(DataFrame.unionByName, counts).withColumn("versions", F.lit(version))


def _marts_of(read, marts) -> DataFrame:
    """All rows of all marts in one shape."""
    parts = []
    for mart, (key, revenue, quantity) in MART_SHAPES.items():
        columns = {"row_key": (key, "bigint"), "revenue": (revenue, MONEY), "quantity": (quantity, "bigint")}
        parts.append(
            marts[mart](read).select(
                F.lit(mart).alias("mart"),
                *(F.expr(e).cast(t).alias(n) for n, (e, t) in columns.items()),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _marts_after_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marts made of the sums that three loads have left."""
    return _marts_of(reader(spark, _lake(spark, sf_dir)), MARTS_OF_SUMS)


def _dense_ids_after_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of customers, products and days after three loads, each as it was given first."""
    found = reader(spark, _lake(spark, sf_dir))(IDS)
    return found.where(F.col("dimension").isin(*NUMBERED))


def _keys_with_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marts without their ids, from tables whose keys are so short that members share them."""
    root = _stored(spark, sf_dir, "short")
    rounds = count()

    def make(keys: Keys) -> Warehouse:
        source = retail_source(spark, sf_dir, keys)
        return Warehouse(spark, source, f"{root}/{next(rounds)}")

    read = settled(make, Keys(bits=SHORT_BITS)).table
    parts = [
        MARTS[mart](read).select(F.lit(mart).alias("mart"), *columns)
        for mart, columns in NAMED_MARTS.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _dq_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables against those made row by row from the flat sales; in the stored fact the
    first and the last sale have each other's customer."""
    warehouse = _warehouse(spark, sf_dir)
    read = warehouse.table
    # The rows are read once for each entity, and not joined anew each time.
    by_row = Warehouse(spark, from_flat(warehouse.kept("flat")), _stored(spark, sf_dir, "by_row"))
    ends = read("fact_sales").agg(
        *(f("source_id").alias(n) for f, n in ((F.min, "first"), (F.max, "last"))),
        F.min_by("customer_id", "source_id").alias("of_first"),
        F.max_by("customer_id", "source_id").alias("of_last"),
    ).first()
    swapped = (
        F.when(F.col("source_id") == ends["first"], F.lit(ends["of_last"]))
        .when(F.col("source_id") == ends["last"], F.lit(ends["of_first"]))
        .otherwise(F.col("customer_id"))
    )

    def stored(name: str) -> DataFrame:
        rows = read(name)
        return rows.withColumn("customer_id", swapped) if name == "fact_sales" else rows

    return dq_digest(by_row.table, stored)


_EXPORTED = count()


def _export_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key-value export of the first load's marts, with the changes up to the last load made.

    Both exports and the changes are stored: as one plan, every mart would be built seven
    times, each with tables that the driver broadcasts.
    """
    folder, root = _lake(spark, sf_dir), _stored(spark, sf_dir, f"exported-{next(_EXPORTED)}")

    def kept(name: str, rows: DataFrame) -> DataFrame:
        rows.write.option("compression", "zstd").parquet(f"{root}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{root}/{name}")

    def exported(version: int) -> DataFrame:
        read = reader(spark, folder, version)
        marts = {m: kept(f"{m}-{version}", MARTS_OF_SUMS[m](read)) for m in MARTS_OF_SUMS}
        return kept(f"export_kv-{version}", EXPORTS["export_kv"](marts.__getitem__))

    old, new = exported(1), exported(3)
    key = EXPORT_KEYS["export_kv"]
    return applied(old, kept("changes", changes(old, new, key)), key)


def entry(spark: SparkSession) -> DataFrame:
    """Revenue by product category."""
    return _report(REPORTS["revenue_by_category"], spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        "src_flat": partial(_table, "flat"),
        "load_csv": _load_csv,
        "load_audit": _load_audit,
        "clean_dates": _clean_dates,
        "dense_ids": _dense_ids,
        "dim_upsert": _dim_upsert,
        "pet_first_sale": _pet_first_sale,
        "write_mart": _write_mart,
        "write_fact": _write_fact,
        "fact_sales_dense": _fact_sales_dense,
        "fact_sales_by_lookup": _fact_sales_by_lookup,
        "dq_bad_rows": _bad_rows,
        "refresh_snapshot": _refresh_snapshot,
        "marts_after_add": _marts_after_add,
        "dense_ids_after_add": _dense_ids_after_add,
        "keys_with_collisions": _keys_with_collisions,
        "dq_digest": _dq_digest,
        "export_changes": _export_changes,
    }
    referring = [t for t in FOREIGN_KEYS if t != "fact_sales"]
    named |= {f"{t}_dense": partial(_dim_dense, t) for t in referring}
    named |= {t: partial(_table, t) for t in (*WAREHOUSE_TABLES, *MARTS)}
    named |= {n: partial(_report, b) for n, b in {**REPORTS, **CHECKS, **EXPORTS}.items()}
    if llm_queries:
        named |= {"pipeline": corpus_pipeline.run, **llm_queries.queries()}
    return named


def oracle_sql() -> dict[str, str]:
    expected = oracle_queries.oracle_sql()
    if llm_queries:
        expected |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            expected["pipeline"] = corpus_pipeline.ORACLE_SQL
    return expected
