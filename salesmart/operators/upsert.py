"""Incremental load of dimensions and of the staging table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unseen_members(members: DataFrame, stored: DataFrame) -> DataFrame:
    """Members the stored dimension does not have yet; append them to it.

    All columns are compared, NULLs as equal: a member whose key is held by
    another one is added, and the check of duplicate keys finds both. Both sides
    hold each member once, so no key is hot.
    """
    known = stored.select(*(F.col(c).alias(f"{c}_stored") for c in members.columns))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_stored")) for c in members.columns]
    return members.join(known, reduce(lambda a, b: a & b, same), "left_anti")


def unseen_keys(members: DataFrame, stored: DataFrame) -> DataFrame:
    """Members whose key the stored dimension does not have.

    For keys that no two members share (see ``plans/collisions.py``): one 8-byte column of
    the stored side is read and compared.
    """
    return members.join(stored.select("id"), "id", "left_anti")


def upsert_dimension(stored: DataFrame, members: DataFrame) -> DataFrame:
    """Stored members plus the unseen ones. Running it twice changes nothing."""
    return stored.unionByName(unseen_members(members, stored))
