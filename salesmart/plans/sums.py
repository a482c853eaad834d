"""Sums of the fact per foreign key, kept per load, from which marts and checks are made.

All columns are sums or counts, so the sums of several loads add up, and a load that is
added leaves the others' sums alone. One scan of a load's narrow columns gives the sums of
all its foreign keys: every sale counts once for each, added up inside its task before the
shuffle, so that a key of many sales is no hot spot.

``dated`` columns count sales with a day, which some marts are limited to. Sales without a
member are summed under a NULL id, so that per role the sales add up to those of the load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.clean import money
from salesmart.schema import FOREIGN_KEYS

SUMS = "sales_sums"
ROLES = tuple(FOREIGN_KEYS["fact_sales"])
MEASURES = ("total_price", "product_quantity", "product_price")

_COUNTS = ("sales", "priced", "dated_sales", "dated_priced", "counted", "price_count")
_TOTALS = ("revenue", "dated_revenue", "prices")


def _columns() -> dict[str, Column]:
    dated = F.col("dated")
    price, quantity, unit = (F.col(m) for m in MEASURES)
    return {
        "sales": F.count("*"),
        "priced": F.count(price),
        "revenue": money(F.sum(price)),
        "dated_sales": F.count_if(dated),
        "dated_priced": F.count(F.when(dated, price)),
        "dated_revenue": money(F.sum(F.when(dated, price))),
        "quantity": F.sum(quantity),
        "counted": F.count(quantity),
        "prices": money(F.sum(unit)),
        "price_count": F.count(unit),
    }


def sums_of(fact: DataFrame) -> DataFrame:
    """(role, id, sums): one row per foreign key and member that some sale of it refers to."""
    sides = F.array(*(F.struct(F.lit(r).alias("role"), F.col(r).alias("id")) for r in ROLES))
    dated = F.col("date_id").isNotNull().alias("dated")
    each = fact.select(F.explode(sides).alias("side"), dated, *MEASURES)
    columns = [c.alias(n) for n, c in _columns().items()]
    return each.groupBy("side.role", "side.id").agg(*columns)


def merged(sums: DataFrame) -> DataFrame:
    """The sums of several loads as one. A sum of nothing but NULLs stays NULL."""
    plain = [F.sum(c).alias(c) for c in (*_COUNTS, "quantity")]
    totals = [money(F.sum(c)).alias(c) for c in _TOTALS]
    rows = sums.groupBy("role", "id").agg(*plain, *totals)
    return rows.select("role", "id", *_columns())
