"""Typing of the flat text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.schema import DATE_COLUMNS, DATE_FORMAT, MONEY


def parse_date(text: Column) -> Column:
    """Date of a month/day/year text; NULL when it names no calendar day."""
    return F.try_to_date(text, DATE_FORMAT)


def is_bad_date(text: Column) -> Column:
    """True for a text that is there but is no date."""
    return text.isNotNull() & parse_date(text).isNull()


def clean_sales(flat: DataFrame) -> DataFrame:
    """Flat rows (or the part of their columns present) with dates typed."""
    return flat.withColumns(
        {c: parse_date(F.col(c)) for c in DATE_COLUMNS if c in flat.columns}
    )


def money(total: Column) -> Column:
    """A money total in the type that all of them have."""
    return total.cast(MONEY)


def ratio(total: Column, count: Column) -> Column:
    """total / count to 4 digits, divided as decimals so that no half is lost."""
    return (total / count).cast("decimal(28,4)").cast("double")
