"""Flat sales from normalised retail tables.

Maps lineitem, orders, customer, part, supplier, nation and region to the 50
flat columns. All joins keep every sale: one whose order, part or supplier is
missing or NULL has NULL attributes and refers to nothing.
For flat rows the few columns of the tables travel through the sale-sized joins,
and the wide texts are shaped after the last of them. For the keyed rows, attributes
are shaped and member keys computed on the table that owns them, once per
customer and not per sale, and only the 8-byte keys travel.
Sides that are broadcast are joined last, and of the others the orders, whose
columns are the most, so that a sale is as narrow as can be where it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.clean import clean_sales
from salesmart.functions.keys import PLAIN, Keys
from salesmart.schema import ENTITIES, FLAT_COLUMNS, Entity
from salesmart.sources.base import (
    KEYED_COLUMNS,
    SalesSource,
    attribute_columns,
    date_key_columns,
    key_columns,
    member_key,
    missing_key,
)
from salesmart.session import is_small, scan_bytes, sized_side

TABLES = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region")

# Row width of a join side: a few keys and flags, or some texts as well.
NARROW, WIDE = 1, 2

# Flat columns by the table that owns them.
CUSTOMER_COLUMNS = {
    "customer_first_name": "split_part(c_name, '#', 1)",
    "customer_last_name": "split_part(c_name, '#', 2)",
    "customer_age": "cast(18 + c_custkey % 60 as bigint)",
    "customer_email": "concat(lower(c_name), '@example.com')",
    "customer_country": "n_name",
    "customer_postal_code": (
        "case when c_custkey % 11 = 0 then null "
        "else concat('P', cast(c_custkey % 900 as string)) end"
    ),
    "customer_pet_type": "concat('Type-', cast(c_custkey % 6 as string))",
    "customer_pet_name": "concat('Pet-', cast(c_custkey % 50 as string))",
    "customer_pet_breed": (
        "case when c_custkey % 13 = 0 then null "
        "else concat('Breed-', cast(c_custkey % 7 as string)) end"
    ),
    "store_name": "concat(c_mktsegment, ' ', n_name)",
    "store_location": "c_mktsegment",
    "store_city": "concat('City-', n_name)",
    "store_state": "r_name",
    "store_country": "r_name",
    "store_phone": "cast(null as string)",
    "store_email": "concat(lower(c_mktsegment), '.', lower(n_name), '@example.com')",
    "pet_category": "c_mktsegment",
}
ORDER_COLUMNS = {
    "seller_first_name": "'Desk'",
    "seller_last_name": "o_orderpriority",
    "seller_email": "concat(lower(o_orderpriority), '.', lower(r_name), '@example.com')",
    "seller_country": "case when o_orderpriority = '4-NOT SPECIFIED' then null else r_name end",
    "seller_postal_code": "cast(null as string)",
    "sale_date": "date_format(o_orderdate, 'MM/dd/yyyy')",
    "sale_customer_id": "o_custkey",
    "sale_seller_id": "cast(substr(o_orderpriority, 1, 1) as bigint)",
}
# What travels of a sale besides its keys, and the flat columns made of it after the joins.
LINE_VALUES = {
    "line": "l_linenumber",
    "quantity": "cast(l_quantity as bigint)",
    "price": "cast(l_extendedprice as decimal(14,2))",
}
LINE_COLUMNS = {
    "id": "l_orderkey * 10 + line",
    "product_quantity": "quantity",
    "sale_product_id": "l_partkey",
    "sale_quantity": "quantity",
    "sale_total_price": "price",
}
PART_COLUMNS = {
    "product_name": "p_name",
    "product_category": "p_type",
    "product_price": "cast(p_retailprice as decimal(12,2))",
    "product_weight": "cast(p_size / 2.0 as float)",
    "product_color": "case when p_partkey % 97 = 0 then null else split_part(p_name, ' ', 1) end",
    "product_size": "cast(p_size as string)",
    "product_brand": "p_brand",
    "product_material": "split_part(p_name, ' ', 2)",
    "product_description": "concat(p_name, ' ', p_brand)",
    "product_rating": "cast((10 + p_partkey % 41) / 10.0 as decimal(2,1))",
    "product_reviews": "p_partkey % 1000",
    "product_release_date": (
        "date_format(date_add(date'1995-01-01', cast(p_partkey % 365 as int)), 'MM/dd/yyyy')"
    ),
    "product_expiry_date": (
        "date_format(date_add(date'1997-01-01', cast(p_partkey % 365 as int)), 'MM/dd/yyyy')"
    ),
}
SUPPLIER_COLUMNS = {
    "supplier_name": "s_name",
    "supplier_contact": "concat('Contact ', s_name)",
    "supplier_email": "concat(lower(s_name), '@example.com')",
    "supplier_phone": "cast(null as string)",
    "supplier_address": "cast(null as string)",
    "supplier_city": "concat('City-', cast(s_suppkey % 10 as string))",
    "supplier_country": "n_name",
}


def _shape(columns: dict[str, str]) -> list:
    return [F.expr(e).alias(c) for c, e in columns.items()]


def retail_source(spark: SparkSession, path: str, keys: Keys = PLAIN) -> SalesSource:
    scans = {t: spark.read.parquet(f"{path}/{t}.parquet") for t in TABLES}
    read = scans.__getitem__

    def side(frame: DataFrame, *tables: str, width: int = NARROW) -> DataFrame:
        return sized_side(frame, [scans[t] for t in tables], width)

    nation = read("nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read("region").select("r_regionkey", "r_name")
    nation_region = nation.join(
        side(region, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )

    # One frame per owning table: its join keys and its flat columns, and what these come from.
    customer_rows = (
        read("customer")
        .join(
            side(nation_region, "nation", "region"),
            F.col("c_nationkey") == F.col("n_nationkey"),
            "left",
        )
        .select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name")
    )
    customers = customer_rows.select("c_custkey", "r_name", *_shape(CUSTOMER_COLUMNS))
    part_rows = read("part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"
    )
    parts = part_rows.select("p_partkey", *_shape(PART_COLUMNS))
    supplier_rows = (
        read("supplier")
        .join(side(nation, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select("s_suppkey", "s_name", F.col("n_name").alias("s_nation"))
    )
    suppliers = supplier_rows.withColumnRenamed("s_nation", "n_name").select(
        "s_suppkey", *_shape(SUPPLIER_COLUMNS)
    )
    orders = read("orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    line_rows = read("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", *_shape(LINE_VALUES)
    )

    def with_customers(customer_columns: DataFrame, width: int) -> DataFrame:
        return orders.join(
            side(customer_columns, "customer", width=width),
            F.col("o_custkey") == F.col("c_custkey"),
            "left",
        )

    def orders_with(customer_columns: DataFrame, width: int) -> DataFrame:
        kept = [c for c in customer_columns.columns if c not in ("c_custkey", "r_name")]
        joined = with_customers(customer_columns, width)
        return joined.select("o_orderkey", *kept, *_shape(ORDER_COLUMNS))

    def sales(orders_side: DataFrame, parts_side: DataFrame, suppliers_side: DataFrame, width: int):
        joins = [
            ("l_partkey", "p_partkey", parts_side, ("part",), width),
            ("l_suppkey", "s_suppkey", suppliers_side, ("supplier",), NARROW),
            ("l_orderkey", "o_orderkey", orders_side, ("orders", "customer"), width),
        ]
        joins.sort(key=lambda j: is_small([scans[t] for t in j[3]], j[4]))
        joined = line_rows
        for foreign, key, frame, tables, wide in joins:
            found = side(frame, *tables, width=wide)
            joined = joined.join(found, F.col(foreign) == F.col(key), "left")
        return joined

    # The seller's first name is the same in all orders, and nothing where there is no order.
    desk = F.when(F.col("o_orderkey").isNotNull(), F.expr(ORDER_COLUMNS["seller_first_name"]))
    supplier_shape = {c: e.replace("n_name", "s_nation") for c, e in SUPPLIER_COLUMNS.items()}
    shaped = LINE_COLUMNS | CUSTOMER_COLUMNS | ORDER_COLUMNS | PART_COLUMNS | supplier_shape
    joined = sales(with_customers(customer_rows, WIDE), part_rows, supplier_rows, WIDE).drop("l_suppkey")

    def shape(rows: DataFrame) -> DataFrame:
        return rows.select(
            *(desk.alias(c) if c == "seller_first_name" else F.expr(shaped[c]).alias(c) for c in FLAT_COLUMNS)
        )

    def keyed_by(frame: DataFrame, keep: list[str], *entities: str) -> DataFrame:
        computed = [c for name in entities for c in key_columns(ENTITIES[name], keys)]
        return frame.select(*keep, *computed)

    customer_keys = keyed_by(customers, ["c_custkey", "r_name"], "customer", "store")
    member_keys = [c for n in ("customer", "store") for c in (ENTITIES[n].key, ENTITIES[n].flag)]
    order_keys = clean_sales(orders_with(customer_keys, NARROW)).select(
        "o_orderkey", *member_keys, *key_columns(ENTITIES["seller"], keys), *date_key_columns(keys)
    )
    part_keys = keyed_by(clean_sales(parts), ["p_partkey", "product_price"], "product")
    supplier_keys = keyed_by(suppliers, ["s_suppkey"], "supplier")
    sellers = orders_with(customers.select("c_custkey", "r_name"), NARROW)
    owners = {
        "customer": customers,
        "seller": sellers,
        "product": clean_sales(parts),
        "store": customers,
        "supplier": suppliers,
    }

    # What a sale of an unknown owner refers to: the member without any attribute.
    unknown = {}
    for name, owner in owners.items():
        entity = ENTITIES[name]
        types = dict(owner.select(*attribute_columns(entity)).dtypes)
        unknown[entity.key] = F.coalesce(F.col(entity.key), missing_key(entity, types, keys))
        unknown[entity.flag] = F.coalesce(F.col(entity.flag), F.lit(False))
    keyed = (
        sales(order_keys, part_keys, supplier_keys, NARROW)
        .withColumns({c: F.expr(e) for c, e in LINE_COLUMNS.items()})
        .withColumnsRenamed({"id": "source_id", "sale_total_price": "total_price"})
        .withColumns(unknown)
        .select(*KEYED_COLUMNS)
    )

    def members(entity: Entity, keyed_rows: DataFrame) -> DataFrame:
        """Members of the owning table that occur in a sale.

        The sales side is reduced to its distinct keys first, which collapses a
        hot key inside each task; the join then meets every key once per side.
        """
        owned = owners[entity.name].select(*attribute_columns(entity)).distinct()
        types = dict(owned.dtypes)
        nothing = F.col(entity.key) == missing_key(entity, types, keys)
        owned = owned.select(member_key(entity, keys), "*").where(~nothing)
        sold = keyed_rows.select(entity.key).distinct()
        # The member without any attribute, if a sale refers to it.
        missing = [F.lit(None).cast(t).alias(a) for a, t in types.items()]
        unknown_member = sold.where(nothing).select(entity.key, *missing)
        return owned.join(sold, entity.key, "left_semi").unionByName(unknown_member)

    raw = read("lineitem").select(
        F.expr(LINE_VALUES["price"]).alias("sale_total_price")
    )
    return SalesSource(
        raw, shape(joined), keyed, members, scan_bytes(*scans.values()), keys, joined, shape
    )

