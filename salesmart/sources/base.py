"""What the warehouse needs to know about its input."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.clean import clean_sales
from salesmart.functions.keys import PLAIN, Keys
from salesmart.schema import DIMENSION_OF, ENTITIES, Entity

MEASURES = {
    "source_id": "id",
    "sale_date": "sale_date",
    "product_quantity": "product_quantity",
    "product_price": "product_price",
    "sale_quantity": "sale_quantity",
    "total_price": "sale_total_price",
}

KEYED_COLUMNS = (
    "source_id",
    *(e.key for e in ENTITIES.values()),
    *(e.flag for e in ENTITIES.values()),
    "sale_date",
    "date_id",
    "product_quantity",
    "product_price",
    "sale_quantity",
    "total_price",
)


@dataclass(frozen=True)
class SalesSource:
    """One sales input.

    ``raw``        price of every sale as it comes in (``sale_total_price``), before any join
    ``flat``       the 50-column rows, one per sale
    ``keyed``      one narrow row per sale: member keys, dates, measures
    ``members``    entity, keyed rows -> distinct members that occur in a sale
    ``input_bytes`` size of the files behind it, 0 if unknown
    ``keys``       how its keys are computed
    ``joined``     rows that ``shape`` makes the flat ones of, one of each, with fewer and
                   narrower columns; the form in which flat rows are stored
    """

    raw: DataFrame
    flat: DataFrame
    keyed: DataFrame
    members: Callable[[Entity, DataFrame], DataFrame]
    input_bytes: int
    keys: Keys = PLAIN
    joined: DataFrame | None = None
    shape: Callable[[DataFrame], DataFrame] | None = None


def attribute_columns(entity: Entity) -> list:
    return [F.col(c).alias(a) for a, c in entity.attributes.items()]


def key_columns(entity: Entity, keys: Keys) -> list:
    """Member key and whether a sale with these attributes has the member at all."""
    return [
        keys.surrogate(
            DIMENSION_OF[entity.name], *(F.col(c) for c in entity.attributes.values())
        ).alias(entity.key),
        F.col(entity.attributes[entity.anchor]).isNotNull().alias(entity.flag),
    ]


def member_key(entity: Entity, keys: Keys):
    """Key of a frame that already carries the entity's attribute names."""
    columns = (F.col(a) for a in entity.attributes)
    return keys.surrogate(DIMENSION_OF[entity.name], *columns).alias(entity.key)


def missing_key(entity: Entity, types: dict[str, str], keys: Keys):
    """Key of the member all of whose attributes are NULL, of a sale whose owner is unknown."""
    nothing = (F.lit(None).cast(types[a]) for a in entity.attributes)
    return keys.surrogate(DIMENSION_OF[entity.name], *nothing)


def date_key_columns(keys: Keys) -> list:
    return [F.col("sale_date"), keys.lookup("dim_dates", F.col("sale_date")).alias("date_id")]


def from_flat(flat: DataFrame, input_bytes: int = 0, keys: Keys = PLAIN) -> SalesSource:
    """Source over a flat table: everything is computed from its own columns."""
    clean = clean_sales(flat)
    member_keys = [c for e in ENTITIES.values() for c in key_columns(e, keys)]
    measures = [F.col(c).alias(n) for n, c in MEASURES.items() if n != "sale_date"]
    keyed = clean.select(*measures, *member_keys, *date_key_columns(keys)).select(*KEYED_COLUMNS)

    def members(entity: Entity, _keyed: DataFrame) -> DataFrame:
        members = clean.select(*attribute_columns(entity)).distinct()
        return members.select(member_key(entity, keys), "*")

    return SalesSource(flat.select("sale_total_price"), flat, keyed, members, input_bytes, keys)
