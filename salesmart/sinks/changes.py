"""Changes between two versions of an export, for stores that are not to be written anew.

Rows are compared by key and digest, so that of the old side only these are shuffled, and of
the new side whole rows only once more for those that changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Export -> the columns that identify a row of it.
EXPORT_KEYS = {
    "export_documents": ("collection", "document_id"),
    "export_kv": ("entry", "field"),
    "export_nodes": ("node_id",),
    "export_edges": ("from_id", "relation", "to_id"),
}
UPSERT, DELETE = "upsert", "delete"


def _digests(rows: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    others = [c for c in sorted(rows.columns) if c not in key]
    text = F.to_json(F.struct(*others), {"ignoreNullFields": "false"})
    return rows.select(*key, F.unhex(F.sha2(text, 256)).alias(name))


def changes(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """``op`` (upsert, delete) and the row; of a row to delete only its key.

    Keys identify rows on each side and are never NULL.
    """
    both = _digests(old, key, "was").join(_digests(new, key, "is"), [*key], "full")
    op = F.when(F.col("is").isNull(), DELETE).when(~F.col("is").eqNullSafe(F.col("was")), UPSERT)
    marked = both.select(*key, op.alias("op")).where("op is not null")
    return marked.join(new, [*key], "left").select("op", *new.columns)


def applied(old: DataFrame, found: DataFrame, key: Sequence[str]) -> DataFrame:
    """The old rows with the changes made; made twice, they change nothing more."""
    kept = old.join(found.select(*key), [*key], "left_anti")
    return kept.unionByName(found.where(F.col("op") == UPSERT).drop("op"))
