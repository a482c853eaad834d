"""The six marts.

Each mart first adds up the fact per foreign key, where tasks combine their
own rows before the shuffle, and only then joins the dimension: the join meets
one row per key, so a key that holds a large share of the sales is no hot spot.

The sums per key come from the fact (``MARTS``), or from stored sums of its loads, which
are added up (``MARTS_OF_SUMS``, see ``plans/sums.py``): then no sale is read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.clean import money, ratio
from salesmart.plans.sums import SUMS, merged

Reader = Callable[[str], DataFrame]


def _revenue() -> Column:
    return money(F.sum("total_price"))


def _dated(fact: DataFrame, read: Reader) -> DataFrame:
    """Sales whose day is in the date dimension (at most one row per calendar day)."""
    days = read("dim_dates").select(F.col("id").alias("date_id"))
    return fact.join(days, "date_id", "left_semi")


def _names(read: Reader, table: str, id_name: str, name: str) -> DataFrame:
    return read(table).select(F.col("id").alias(id_name), F.col("name").alias(name))


def _product_sums(read: Reader) -> DataFrame:
    return (
        read("fact_sales")
        .where("product_id is not null")
        .groupBy("product_id")
        .agg(
            _revenue().alias("total_revenue"),
            F.sum("product_quantity").alias("total_quantity"),
            F.count("*").alias("sales"),
        )
    )


def sales_by_product(per_product: DataFrame, read: Reader) -> DataFrame:
    products = read("dim_products").select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        "category_id",
        F.round(F.col("rating").cast("double"), 4).alias("avg_rating"),
        F.col("reviews").alias("review_count"),
    )
    categories = _names(read, "dim_product_categories", "category_id", "category")
    return (
        per_product.join(products, "product_id")
        .join(categories, "category_id")
        .select(
            "product_id",
            "product_name",
            "category",
            "total_revenue",
            "total_quantity",
            "avg_rating",
            "review_count",
            (F.col("review_count") * F.col("sales")).alias("reviews_over_sales"),
        )
    )


def _customer_sums(read: Reader) -> DataFrame:
    return (
        _dated(read("fact_sales").where("customer_id is not null"), read)
        .groupBy("customer_id")
        .agg(_revenue().alias("total_spent"), F.count("total_price").alias("priced"))
    )


def sales_by_customer(per_customer: DataFrame, read: Reader) -> DataFrame:
    customers = read("dim_customers").select(
        F.col("id").alias("customer_id"), "first_name", "last_name", "country_id"
    )
    countries = _names(read, "dim_countries", "country_id", "country")
    return (
        per_customer.join(customers, "customer_id")
        .join(countries, "country_id", "left")
        .select(
            "customer_id",
            # NULL when either part is.
            F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
            "country",
            "total_spent",
            ratio(F.col("total_spent"), F.nullif(F.col("priced"), F.lit(0))).alias(
                "avg_order_value"
            ),
        )
    )


def _day_sums(read: Reader) -> DataFrame:
    return (
        read("fact_sales")
        .where("date_id is not null")
        .groupBy("date_id")
        .agg(_revenue().alias("revenue"), F.count("*").alias("orders"))
    )


def sales_by_time(per_day: DataFrame, read: Reader) -> DataFrame:
    days = read("dim_dates").select(
        F.col("id").alias("date_id"), F.year("date").alias("year"), F.month("date").alias("month")
    )
    return (
        per_day.join(days, "date_id")
        .groupBy("year", "month")
        .agg(
            money(F.sum("revenue")).alias("total_revenue"), F.sum("orders").alias("total_orders")
        )
        .withColumn("avg_order_size", ratio(F.col("total_revenue"), F.col("total_orders")))
    )


def _store_sums(read: Reader) -> DataFrame:
    return (
        _dated(read("fact_sales").where("store_id is not null"), read)
        .groupBy("store_id")
        .agg(_revenue().alias("total_revenue"), F.count("*").alias("orders"))
    )


def sales_by_store(per_store: DataFrame, read: Reader) -> DataFrame:
    stores = read("dim_stores").select(
        F.col("id").alias("store_id"),
        F.col("name").alias("store_name"),
        "location",
        "city_id",
        "country_id",
    )
    return (
        per_store.join(stores, "store_id")
        .join(_names(read, "dim_cities", "city_id", "city"), "city_id", "left")
        .join(_names(read, "dim_countries", "country_id", "country"), "country_id", "left")
        .select(
            "store_id",
            "store_name",
            "location",
            "city",
            "country",
            "total_revenue",
            ratio(F.col("total_revenue"), F.col("orders")).alias("avg_order_value"),
        )
    )


def _supplier_sums(read: Reader) -> DataFrame:
    # The price average weighs every sale. The fact holds the price of its
    # product, so the sales need not be joined to the products for it.
    return (
        read("fact_sales")
        .where("supplier_id is not null")
        .groupBy("supplier_id")
        .agg(
            _revenue().alias("total_revenue"),
            money(F.sum("product_price")).alias("prices"),
            F.count("product_price").alias("priced"),
            F.sum("product_quantity").alias("quantity"),
            F.count("product_quantity").alias("counted"),
        )
    )


def sales_by_supplier(per_supplier: DataFrame, read: Reader) -> DataFrame:
    suppliers = read("dim_suppliers").select(
        F.col("id").alias("supplier_id"), F.col("name").alias("supplier_name"), "country_id"
    )
    countries = _names(read, "dim_countries", "country_id", "country")
    return (
        per_supplier.join(suppliers, "supplier_id")
        .join(countries, "country_id", "left")
        .select(
            "supplier_id",
            "supplier_name",
            "country",
            "total_revenue",
            ratio(F.col("prices"), F.nullif(F.col("priced"), F.lit(0))).alias("avg_price"),
            ratio(money(F.col("quantity")), F.nullif(F.col("counted"), F.lit(0))).alias(
                "avg_quantity"
            ),
        )
    )


def _quality_sums(read: Reader) -> DataFrame:
    return (
        read("fact_sales")
        .where("product_id is not null")
        .groupBy("product_id")
        .agg(F.sum("product_quantity").alias("total_quantity"), F.count("*").alias("sales"))
    )


def product_quality(per_product: DataFrame, read: Reader) -> DataFrame:
    products = read("dim_products").select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        F.round(F.col("rating").cast("double"), 4).alias("rating"),
        F.col("reviews").alias("review_count"),
    )
    return per_product.join(products, "product_id").select(
        "product_id",
        "product_name",
        "rating",
        "review_count",
        (F.col("review_count") * F.col("sales")).alias("reviews_over_sales"),
        "total_quantity",
    )


# Mart -> sums per key from the fact, the mart of such sums, and the same sums as columns of
# the stored ones: foreign key, which keys count, and column -> stored column.
_BUILT = {
    "sales_by_product": (
        _product_sums,
        sales_by_product,
        ("product_id", "sales", {"total_revenue": "revenue", "total_quantity": "quantity", "sales": "sales"}),
    ),
    "sales_by_customer": (
        _customer_sums,
        sales_by_customer,
        ("customer_id", "dated_sales", {"total_spent": "dated_revenue", "priced": "dated_priced"}),
    ),
    "sales_by_time": (
        _day_sums,
        sales_by_time,
        ("date_id", "sales", {"revenue": "revenue", "orders": "sales"}),
    ),
    "sales_by_store": (
        _store_sums,
        sales_by_store,
        ("store_id", "dated_sales", {"total_revenue": "dated_revenue", "orders": "dated_sales"}),
    ),
    "sales_by_supplier": (
        _supplier_sums,
        sales_by_supplier,
        (
            "supplier_id",
            "sales",
            {
                "total_revenue": "revenue",
                "prices": "prices",
                "priced": "price_count",
                "quantity": "quantity",
                "counted": "counted",
            },
        ),
    ),
    "product_quality": (
        _quality_sums,
        product_quality,
        ("product_id", "sales", {"total_quantity": "quantity", "sales": "sales"}),
    ),
}


def _of_fact(name: str, read: Reader) -> DataFrame:
    sums, mart, _ = _BUILT[name]
    return mart(sums(read), read)


def _of_sums(name: str, read: Reader) -> DataFrame:
    _, mart, (key, counts, columns) = _BUILT[name]
    stored = merged(read(SUMS).where(F.col("role") == key)).where(F.col("id").isNotNull())
    per_key = stored.where(F.col(counts) > 0).select(
        F.col("id").alias(key), *(F.col(c).alias(n) for n, c in columns.items())
    )
    return mart(per_key, read)


MARTS: dict[str, Callable[[Reader], DataFrame]] = {n: partial(_of_fact, n) for n in _BUILT}
MARTS_OF_SUMS: dict[str, Callable[[Reader], DataFrame]] = {n: partial(_of_sums, n) for n in _BUILT}
