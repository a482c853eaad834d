"""The questions asked of the marts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.plans.marts import money

Reader = Callable[[str], DataFrame]


def top(frame: DataFrame, by: str, key: str, k: int, ascending: bool = False) -> DataFrame:
    """The k rows with the largest (or smallest) ``by``; ``key`` breaks ties, NULL ranks last."""
    order = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return frame.orderBy(order, F.col(key)).limit(k)


def top_products(read: Reader) -> DataFrame:
    mart = read("sales_by_product").select(
        "product_id", "product_name", "category", "total_quantity", "total_revenue"
    )
    return top(mart, "total_quantity", "product_id", 10)


def revenue_by_category(read: Reader) -> DataFrame:
    return (
        read("sales_by_product")
        .groupBy("category")
        .agg(
            money(F.sum("total_revenue")).alias("total_revenue"),
            F.sum("total_quantity").alias("total_quantity"),
        )
    )


def product_ratings(read: Reader) -> DataFrame:
    return read("dim_products").select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        F.round(F.col("rating").cast("double"), 4).alias("avg_rating"),
        F.col("reviews").alias("review_count"),
    )


def top_customers(read: Reader) -> DataFrame:
    mart = read("sales_by_customer").select(
        "customer_id", "customer_name", "country", "total_spent"
    )
    return top(mart, "total_spent", "customer_id", 10)


def customers_by_country(read: Reader) -> DataFrame:
    return read("sales_by_customer").groupBy("country").agg(F.count("*").alias("customers"))


def customer_avg_check(read: Reader) -> DataFrame:
    return read("sales_by_customer").select("customer_id", "customer_name", "avg_order_value")


def sales_trend(read: Reader) -> DataFrame:
    """Months, years (month is NULL) and the grand total (both are NULL)."""
    return (
        read("sales_by_time")
        .rollup("year", "month")
        .agg(
            money(F.sum("total_revenue")).alias("total_revenue"),
            F.sum("total_orders").alias("total_orders"),
        )
    )


def revenue_period_compare(read: Reader) -> DataFrame:
    """Each month against the month before and the same month a year before.

    Joined on the month number, so a month without sales is missing rather
    than silently replaced by an older one.
    """
    month_number = F.col("year") * 12 + F.col("month")
    months = read("sales_by_time").select(
        "year", "month", "total_revenue", month_number.alias("number")
    )

    def earlier(distance: int, name: str) -> DataFrame:
        return months.select(
            (F.col("number") + distance).alias("number"), F.col("total_revenue").alias(name)
        )

    def change(name: str) -> Column:
        return money(F.col("total_revenue") - F.col(name))

    return (
        months.join(earlier(1, "prev_month_revenue"), "number", "left")
        .join(earlier(12, "prev_year_revenue"), "number", "left")
        .select(
            "year",
            "month",
            "total_revenue",
            "prev_month_revenue",
            change("prev_month_revenue").alias("prev_month_change"),
            "prev_year_revenue",
            change("prev_year_revenue").alias("prev_year_change"),
        )
    )


def avg_order_by_month(read: Reader) -> DataFrame:
    return read("sales_by_time").select("year", "month", "avg_order_size")


def top_stores(read: Reader) -> DataFrame:
    mart = read("sales_by_store").select(
        "store_id", "store_name", "city", "country", "total_revenue"
    )
    return top(mart, "total_revenue", "store_id", 5)


def sales_by_city_country(read: Reader) -> DataFrame:
    return (
        read("sales_by_store")
        .groupBy("country", "city")
        .agg(money(F.sum("total_revenue")).alias("total_revenue"), F.count("*").alias("stores"))
    )


def store_avg_check(read: Reader) -> DataFrame:
    return read("sales_by_store").select("store_id", "store_name", "avg_order_value")


def top_suppliers(read: Reader) -> DataFrame:
    mart = read("sales_by_supplier").select(
        "supplier_id", "supplier_name", "country", "total_revenue"
    )
    return top(mart, "total_revenue", "supplier_id", 5)


def supplier_avg_price(read: Reader) -> DataFrame:
    return read("sales_by_supplier").select("supplier_id", "supplier_name", "avg_price")


def sales_by_supplier_country(read: Reader) -> DataFrame:
    return (
        read("sales_by_supplier")
        .groupBy("country")
        .agg(
            money(F.sum("total_revenue")).alias("total_revenue"), F.count("*").alias("suppliers")
        )
    )


def rating_extremes(read: Reader, k: int = 10) -> DataFrame:
    """The k best and the k worst rated products."""
    rated = read("product_quality").where("rating is not null")
    rated = rated.select("product_id", "product_name", "rating", "review_count")
    highest = top(rated, "rating", "product_id", k).select(F.lit("highest").alias("side"), "*")
    lowest = top(rated, "rating", "product_id", k, ascending=True)
    return highest.unionByName(lowest.select(F.lit("lowest").alias("side"), "*"))


def rating_sales_corr(read: Reader) -> DataFrame:
    """Correlation of rating and sold quantity over the products."""
    return read("product_quality").agg(
        F.count(F.when(F.col("rating").isNotNull(), F.col("total_quantity"))).alias("products"),
        F.round(F.corr("rating", F.col("total_quantity").cast("double")), 6).alias(
            "rating_sales_corr"
        ),
    )


def most_reviewed(read: Reader) -> DataFrame:
    products = read("dim_products").select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        F.col("reviews").alias("review_count"),
    )
    return top(products, "review_count", "product_id", 10)


REPORTS: dict[str, Callable[[Reader], DataFrame]] = {
    "top_products": top_products,
    "revenue_by_category": revenue_by_category,
    "product_ratings": product_ratings,
    "top_customers": top_customers,
    "customers_by_country": customers_by_country,
    "customer_avg_check": customer_avg_check,
    "sales_trend": sales_trend,
    "revenue_period_compare": revenue_period_compare,
    "avg_order_by_month": avg_order_by_month,
    "top_stores": top_stores,
    "sales_by_city_country": sales_by_city_country,
    "store_avg_check": store_avg_check,
    "top_suppliers": top_suppliers,
    "supplier_avg_price": supplier_avg_price,
    "sales_by_supplier_country": sales_by_supplier_country,
    "rating_extremes": rating_extremes,
    "rating_sales_corr": rating_sales_corr,
    "most_reviewed": most_reviewed,
}
