"""The fact table: one row per sale."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.clean import clean_sales
from salesmart.functions.keys import encode, surrogate_key
from salesmart.schema import ENTITIES, Entity

FACT_COLUMNS = (
    "source_id",
    "customer_id",
    "seller_id",
    "product_id",
    "date_id",
    "store_id",
    "supplier_id",
    "product_quantity",
    "product_price",
    "sale_quantity",
    "total_price",
)

# Entities in the order that sales look them up: those of few members first.
LOOKED_UP = ("seller", "store", "supplier", "customer", "product")


def fact_sales(keyed: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Foreign keys and measures. A sale without an e-mail (or product name) has no such member."""
    foreign_keys = {
        e.foreign_key: F.when(F.col(e.flag), F.col(e.key)) for e in ENTITIES.values()
    }
    return keyed.withColumns(foreign_keys).select(*FACT_COLUMNS, *extra)


def _comparison(entity: Entity, members: DataFrame) -> Callable[..., Column]:
    """What tells the members of an entity apart: their key, or their text if a key is held twice."""
    twice = members.groupBy(entity.key).count().where("count > 1")
    return surrogate_key if twice.isEmpty() else encode


def fact_sales_by_lookup(flat: DataFrame, dense: Callable[[str], DataFrame]) -> DataFrame:
    """The same fact with ids looked up in the dimensions instead of computed.

    ``dense("product")`` gives the members of an entity with a column
    ``dense_id``, ``dense("date")`` the days. Each join compares the whole
    natural key, NULLs included, by its 8-byte hash key, so that no text goes
    through a sale-sized shuffle. An entity with two members of one key, which
    the members tell before any sale is read, is joined by the encoded text.
    """
    clean = clean_sales(flat)
    members = {e.name: dense(e.name) for e in ENTITIES.values()}
    compare = {e.name: _comparison(e, members[e.name]) for e in ENTITIES.values()}
    natural = [
        F.when(
            F.col(e.attributes[e.anchor]).isNotNull(),
            compare[e.name](*(F.col(c) for c in e.attributes.values())),
        ).alias(f"{e.name}_natural")
        for e in ENTITIES.values()
    ]
    sales = clean.select(
        F.col("id").alias("source_id"),
        "sale_date",
        *natural,
        "product_quantity",
        "product_price",
        "sale_quantity",
        F.col("sale_total_price").alias("total_price"),
    )
    days = dense("date").withColumnsRenamed({"dense_id": "date_id", "date": "sale_date"})
    sales = sales.join(days.drop("id"), "sale_date", "left")
    # Customers and products are many: what the few others are looked up to is shuffled as
    # small numbers, and products come last, so that customers' hashes travel once.
    for entity in sorted(ENTITIES.values(), key=lambda e: LOOKED_UP.index(e.name)):
        same = compare[entity.name](*(F.col(a) for a in entity.attributes))
        found = members[entity.name].select(
            F.col("dense_id").alias(entity.foreign_key), same.alias(f"{entity.name}_natural")
        )
        sales = sales.join(found, f"{entity.name}_natural", "left")
        sales = sales.drop(f"{entity.name}_natural")
    return sales.select(*FACT_COLUMNS)
