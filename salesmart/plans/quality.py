"""Checks that stand in for database constraints and manual inspection.

All of them return counts per table or column. Keys are counted per key first,
inside each task, and only these counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.clean import is_bad_date
from salesmart.plans.marts import money
from salesmart.schema import (
    DATE_COLUMNS,
    DIMENSIONS,
    ENTITIES,
    FOREIGN_KEYS,
    MART_SCHEMAS,
    MONEY,
    NARROW_MONEY,
)

Reader = Callable[[str], DataFrame]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _count_if(condition: Column, weight: Column | None = None) -> Column:
    weight = F.lit(1) if weight is None else weight
    return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0)).cast("bigint")


def _name_of(names: list[str]) -> Column:
    return F.get(F.array(*map(F.lit, names)), F.col("number"))


def dq_duplicate_keys(read: Reader) -> DataFrame:
    """Members, distinct keys and keys held by several members, per dimension."""
    ids = [read(d).select(F.lit(i).alias("number"), "id") for i, d in enumerate(DIMENSIONS)]
    per_key = _union(ids).groupBy("number", "id").agg(F.count("*").alias("n"))
    counts = per_key.groupBy("number").agg(
        F.sum("n").alias("members"),
        F.count("*").alias("distinct_keys"),
        _count_if(F.col("n") > 1).alias("duplicate_keys"),
    )
    return counts.withColumn("dimension", _name_of(list(DIMENSIONS))).drop("number")


def _numbered(columns: list[str], first: int = 0) -> Column:
    """One (number, id) pair per column: small keys for the per-task counting."""
    pairs = (
        F.struct(F.lit(first + i).alias("number"), F.col(c).alias("id"))
        for i, c in enumerate(columns)
    )
    return F.explode(F.array(*pairs)).alias("pair")


def dq_orphans(read: Reader) -> DataFrame:
    """Rows, NULL references and references to no member, per foreign key.

    Each foreign key is counted by itself from a scan of its column, so that the
    fact is not multiplied by its keys; each dimension is read once for all
    references to it.
    """
    references = [
        (table, fk, dim) for table, keys in FOREIGN_KEYS.items() for fk, dim in keys.items()
    ]
    dims = sorted({dim for _, _, dim in references})
    uses = [
        read(table)
        .groupBy(F.col(fk).alias("id"))
        .agg(F.count("*").alias("n"))
        .select(F.lit(i).alias("number"), F.lit(dims.index(dim)).alias("dim"), "id", "n")
        for i, (table, fk, dim) in enumerate(references)
    ]
    targets = [read(dim).select(F.lit(i).alias("dim"), "id") for i, dim in enumerate(dims)]
    targets = _union(targets).distinct().withColumn("found", F.lit(True))
    found = _union(uses).join(targets, ["dim", "id"], "left")
    is_null = F.col("id").isNull()
    counts = found.groupBy("number").agg(
        F.sum("n").alias("row_count"),
        _count_if(is_null, F.col("n")).alias("null_keys"),
        _count_if(~is_null & F.col("found").isNull(), F.col("n")).alias("orphan_keys"),
    )
    return counts.select(
        _name_of([t for t, _, _ in references]).alias("table_name"),
        _name_of([fk for _, fk, _ in references]).alias("foreign_key"),
        "row_count",
        "null_keys",
        "orphan_keys",
    )


def dq_fanout(read: Reader) -> DataFrame:
    """How far e-mails and product names are from identifying a member.

    ``joined_rows`` is what a join of the sales on that text alone would give.
    """
    entities = list(ENTITIES.values())
    sales = (
        read("keyed")
        .select(_numbered([e.key for e in entities]))
        .groupBy("pair.number", "pair.id")
        .agg(F.count("*").alias("sales"))
    )
    members = _union(
        [
            read(f"members_{e.name}").select(
                F.lit(i).alias("number"),
                F.col(e.key).alias("id"),
                F.col(e.anchor).alias("natural_key"),
            )
            for i, e in enumerate(entities)
        ]
    ).where(F.col("natural_key").isNotNull())
    per_text = (
        members.join(sales, ["number", "id"])
        .groupBy("number", "natural_key")
        .agg(F.count("*").alias("members"), F.sum("sales").alias("sales"))
    )
    counts = per_text.groupBy("number").agg(
        F.count("*").alias("natural_keys"),
        _count_if(F.col("members") > 1).alias("ambiguous_keys"),
        F.max("members").alias("max_members"),
        F.sum("sales").alias("sale_rows"),
        F.sum(F.col("sales") * F.col("members")).cast("bigint").alias("joined_rows"),
    )
    return counts.withColumn("entity", _name_of([e.name for e in entities])).drop("number")


# Mart -> its money total, and the fact rows it leaves out on purpose.
_MART_TOTALS = {
    "sales_by_customer": ("total_spent", "customer_id is null or date_id is null"),
    "sales_by_time": ("total_revenue", "date_id is null"),
    "sales_by_store": ("total_revenue", "store_id is null or date_id is null"),
    "sales_by_supplier": ("total_revenue", "supplier_id is null"),
}


def _total(column: str | Column) -> Column:
    return money(F.coalesce(F.sum(column), F.lit(0)))


def dq_reconcile(read: Reader) -> DataFrame:
    """Rows and money of source, fact and marts; ``gap`` is money nothing accounts for."""
    zero = money(F.lit(0))
    # As it came in, so that a sale lost in a join shows as a gap.
    source = read("raw").agg(
        F.lit("source").alias("layer"),
        F.count("*").alias("row_count"),
        _total("sale_total_price").alias("revenue"),
    )
    fact = read("fact_sales")
    excluded = [
        _total(F.when(F.expr(rule), F.col("total_price"))).alias(mart)
        for mart, (_, rule) in _MART_TOTALS.items()
    ]
    # One fact scan gives the fact totals and what each mart leaves out.
    fact_totals = fact.agg(
        F.count("*").alias("row_count"), _total("total_price").alias("revenue"), *excluded
    )
    sides = F.array(
        F.struct(
            F.lit("fact_sales").alias("layer"),
            F.col("row_count"),
            F.col("revenue"),
            zero.alias("excluded"),
        ),
        *(
            F.struct(
                F.lit(mart).alias("layer"),
                F.lit(None).cast("bigint").alias("row_count"),
                F.lit(None).cast(MONEY).alias("revenue"),
                F.col(mart).alias("excluded"),
            )
            for mart in _MART_TOTALS
        ),
    )
    from_fact = fact_totals.select(F.explode(sides).alias("side")).select("side.*")
    per_product = fact.groupBy("product_id").agg(_total("total_price").alias("revenue"))
    categories = read("dim_products").select(F.col("id").alias("product_id"), "category_id")
    uncategorised = (
        per_product.join(categories, "product_id", "left")
        .where("category_id is null")
        .agg(
            F.lit("sales_by_product").alias("layer"),
            F.lit(None).cast("bigint").alias("row_count"),
            F.lit(None).cast(MONEY).alias("revenue"),
            _total("revenue").alias("excluded"),
        )
    )
    totals = {"sales_by_product": "total_revenue", **{m: c for m, (c, _) in _MART_TOTALS.items()}}
    marts = [
        read(mart).agg(
            F.lit(mart).alias("layer"),
            F.count("*").alias("row_count"),
            _total(column).alias("revenue"),
        )
        for mart, column in totals.items()
    ]
    none = F.lit(None).cast(MONEY)
    layers = _union(
        [
            *(m.withColumn("excluded", none) for m in marts),
            source.withColumn("excluded", zero),
            from_fact,
            uncategorised,
        ]
    )
    # At most a dozen one-row aggregates from here on.
    per_layer = layers.groupBy("layer").agg(
        F.max("row_count").alias("row_count"),
        F.max("revenue").alias("revenue"),
        F.max("excluded").alias("excluded_revenue"),
    )
    of_source = F.max(F.when(F.col("layer") == "source", F.col("revenue"))).over(
        Window.partitionBy()
    )
    unexplained = of_source - F.col("revenue") - F.col("excluded_revenue")
    return per_layer.select("*", money(unexplained).alias("gap"))


def dq_overflow(read: Reader, narrow: str = NARROW_MONEY) -> DataFrame:
    """Values per money column, and how many do not fit the narrow type."""
    columns = [("dim_products", "price"), ("fact_sales", "total_price")]
    for mart, schema in MART_SCHEMAS.items():
        columns += [
            (mart, f.name) for f in schema if isinstance(f.dataType, T.DecimalType)
        ]

    # Marts that are written on first use are written at once, not one after another.
    names = list(dict.fromkeys(t for t, _ in columns))
    with ThreadPoolExecutor(len(names)) as pool:
        tables = dict(zip(names, pool.map(read, names)))

    def check(table: str, column: str) -> DataFrame:
        value = F.col(column)
        too_large = value.isNotNull() & value.try_cast(narrow).isNull()
        return tables[table].agg(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.count(column).alias("non_null"),
            _count_if(too_large).alias("overflowing"),
        )

    return _union([check(t, c) for t, c in columns])


def bad_row_reasons(corrupt: str = "_corrupt_record") -> Column:
    """Why a loaded row is set aside; an empty array for a good one."""
    reasons = [F.when(F.col(corrupt).isNotNull(), F.lit("malformed_record"))]
    for column in DATE_COLUMNS:
        reasons.append(F.when(is_bad_date(F.col(column)), F.lit(f"bad_{column}")))
    return F.array_compact(F.array(*reasons))


def dq_bad_rows(staged: DataFrame) -> DataFrame:
    """Set-aside rows per reason; a row with two faults counts under both."""
    return (
        staged.where(F.size("reasons") > 0)
        .select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("row_count"))
    )


CHECKS: dict[str, Callable[[Reader], DataFrame]] = {
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_orphans": dq_orphans,
    "dq_fanout": dq_fanout,
    "dq_reconcile": dq_reconcile,
    "dq_overflow": dq_overflow,
}
