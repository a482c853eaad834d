"""Lookup tables and entity dimensions, built from the distinct members."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.keys import PLAIN, Keys
from salesmart.operators.distinct import union_distinct_all
from salesmart.schema import ENTITIES, ENTITY_DIMS, FOREIGN_KEYS, LOOKUPS, PET_ATTRIBUTES

# Reads a table the dimensions are built from: "keyed" or "members_<entity>".
Reader = Callable[[str], DataFrame]


# What tells apart members that share a key: both numbers of their tuple.
NUMBERS = ("first_number", "second_number")


def _keyed(table: str, keys: Keys, attributes: Sequence[str]) -> dict[str, Column]:
    values = [F.col(a) for a in attributes]
    return {"id": keys.surrogate(table, *values), **dict(zip(NUMBERS, keys.numbers(*values)))}


def lookup(table: str, read: Reader, keys: Keys) -> DataFrame:
    """(id, name) of every value some sale mentions."""
    columns: dict[str, list[str]] = {}
    for entity, attribute in LOOKUPS[table]:
        columns.setdefault(entity, []).append(attribute)
    parts = [(read(f"members_{entity}"), names) for entity, names in columns.items()]
    return union_distinct_all(parts).withColumns(_keyed(table, keys, ["name"]))


def dates(read: Reader, keys: Keys) -> DataFrame:
    """(id, date) of every sale, release and expiry day."""
    parts = [
        (read("keyed"), ["sale_date"]),
        (read("members_product"), ["release_date", "expiry_date"]),
    ]
    days = union_distinct_all(parts, "date")
    return days.withColumns(_keyed("dim_dates", keys, ["date"]))


def pets(read: Reader, keys: Keys) -> DataFrame:
    """Distinct pets. A pet is an attribute of its customer, so the customers have them all."""
    members = read("members_customer").select(*PET_ATTRIBUTES).distinct()
    lookups = {
        "type_id": ("dim_pet_types", "pet_type"),
        "breed_id": ("dim_pet_breeds", "pet_breed"),
        "category_id": ("dim_pet_categories", "pet_category"),
    }
    return members.select(
        *(c.alias(n) for n, c in _keyed("dim_pets", keys, [*PET_ATTRIBUTES]).items()),
        F.col("pet_name").alias("name"),
        *(keys.lookup(d, F.col(a)).alias(c) for c, (d, a) in lookups.items()),
    )


def entity_dimension(table: str, read: Reader, keys: Keys) -> DataFrame:
    """Key, plain attributes and foreign keys of one entity; no join is needed."""
    name, lookups = ENTITY_DIMS[table]
    entity = ENTITIES[name]
    as_id = {attribute: column for column, attribute in lookups.items()}
    attributes = [F.col(a) for a in entity.attributes]
    columns = [F.col(entity.key).alias("id")]
    columns += [n.alias(c) for c, n in zip(NUMBERS, keys.numbers(*attributes))]
    for attribute in entity.attributes:
        if attribute in as_id:
            column = as_id[attribute]
            referred = FOREIGN_KEYS[table][column]
            columns.append(keys.lookup(referred, F.col(attribute)).alias(column))
        elif attribute not in PET_ATTRIBUTES:
            columns.append(F.col(attribute))
    if name == "customer":
        pet = keys.surrogate("dim_pets", *(F.col(a) for a in PET_ATTRIBUTES))
        columns.append(pet.alias("pet_id"))
    return read(f"members_{name}").select(*columns)


def numbered_dimension(table: str, read: Reader, keys: Keys = PLAIN) -> DataFrame:
    """The members with the numbers that their keys come from."""
    if table in LOOKUPS:
        return lookup(table, read, keys).select("id", "name", *NUMBERS)
    if table == "dim_dates":
        return dates(read, keys).select("id", "date", *NUMBERS)
    if table == "dim_pets":
        return pets(read, keys).select(
            "id", "type_id", "name", "breed_id", "category_id", *NUMBERS
        )
    return entity_dimension(table, read, keys)


def dimension(table: str, read: Reader, keys: Keys = PLAIN) -> DataFrame:
    return numbered_dimension(table, read, keys).drop(*NUMBERS)
