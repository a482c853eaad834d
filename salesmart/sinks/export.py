"""Marts shaped for document, key-value and graph stores.

These stores are reached by their own Spark connectors (``format(...)``); what
is common to them is the row shape, and that is made here.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schema import MART_ROW_KEYS, MART_SCHEMAS

Reader = Callable[[str], DataFrame]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_key(mart: str) -> Column:
    return F.concat_ws("-", *(F.col(c).cast("string") for c in MART_ROW_KEYS[mart]))


def _as_text(field: T.StructField) -> Column:
    return F.col(field.name).cast("string")


def export_documents(read: Reader) -> DataFrame:
    """One JSON document per mart row; money stays exact as text, NULL fields are left out."""

    def documents(mart: str) -> DataFrame:
        fields = [
            _as_text(f).alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in MART_SCHEMAS[mart]
        ]
        return read(mart).select(
            F.lit(mart).alias("collection"),
            row_key(mart).alias("document_id"),
            F.to_json(F.struct(*fields)).alias("body"),
        )

    return _union([documents(m) for m in MART_SCHEMAS])


def export_kv(read: Reader) -> DataFrame:
    """One hash per mart row: ``mart:row key`` -> field -> text. NULL fields are left out."""

    def entries(mart: str) -> DataFrame:
        pairs = [F.struct(F.lit(f.name), _as_text(f)) for f in MART_SCHEMAS[mart]]
        fields = F.map_from_entries(F.array(*pairs))
        return read(mart).select(
            F.concat(F.lit(f"{mart}:"), row_key(mart)).alias("entry"),
            F.map_filter(fields, lambda _, value: value.isNotNull()).alias("fields"),
        )

    return _union([entries(m) for m in MART_SCHEMAS])


def kv_fields(entries: DataFrame) -> DataFrame:
    """The same, one row per field, for stores that set fields one by one."""
    return entries.select("entry", F.explode("fields").alias("field", "value"))


# Mart -> (node label, column of the row's name, place label -> column).
_GRAPH = {
    "sales_by_product": ("Product", "product_name", {"Category": "category"}),
    "sales_by_customer": ("Customer", "customer_name", {"Country": "country"}),
    "sales_by_store": ("Store", "store_name", {"City": "city", "Country": "country"}),
    "sales_by_supplier": ("Supplier", "supplier_name", {"Country": "country"}),
}
_RELATIONS = {"Category": "IN_CATEGORY", "City": "IN_CITY", "Country": "IN_COUNTRY"}


def _node_id(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"{label}:"), value)


def export_nodes(read: Reader) -> DataFrame:
    """Graph nodes: every mart row, and every category, city and country they refer to."""
    rows, places = [], []
    for mart, (label, name, refers) in _GRAPH.items():
        frame = read(mart)
        rows.append(
            frame.select(
                _node_id(label, row_key(mart)).alias("node_id"),
                F.lit(label).alias("label"),
                F.col(name).alias("name"),
            )
        )
        places += [
            frame.select(F.lit(place).alias("label"), F.col(column).alias("name"))
            for place, column in refers.items()
        ]
    distinct_places = (
        _union(places)
        .where("name is not null")
        .distinct()
        .select(F.concat("label", F.lit(":"), "name").alias("node_id"), "label", "name")
    )
    return _union([*rows, distinct_places])


def export_edges(read: Reader) -> DataFrame:
    """Graph edges from a mart row to its category, city and country, with the row's revenue."""
    edges = []
    for mart, (label, _, refers) in _GRAPH.items():
        revenue = "total_spent" if mart == "sales_by_customer" else "total_revenue"
        for place, column in refers.items():
            edges.append(
                read(mart)
                .where(F.col(column).isNotNull())
                .select(
                    _node_id(label, row_key(mart)).alias("from_id"),
                    F.lit(_RELATIONS[place]).alias("relation"),
                    _node_id(place, F.col(column)).alias("to_id"),
                    F.col(revenue).alias("revenue"),
                )
            )
    return _union(edges)


EXPORTS: dict[str, Callable[[Reader], DataFrame]] = {
    "export_documents": export_documents,
    "export_kv": lambda read: kv_fields(export_kv(read)),
    "export_nodes": export_nodes,
    "export_edges": export_edges,
}
