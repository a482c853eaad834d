"""Different members of one key, and the second keys that tell them apart.

Members are few beside sales, and only those that share a key are looked at closer. Where
none do, which is the rule up to some 1e9 members, this costs a count per key of the
dimensions and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from salesmart.functions.keys import MOST_SECOND_KEYS, PLAIN, Keys
from salesmart.operators.dims import NUMBERS
from salesmart.plans.quality import dq_duplicate_keys
from salesmart.plans.warehouse import Warehouse
from salesmart.schema import DIMENSIONS

# Second keys of a lookup change the members that refer to it, which may then meet others.
ROUNDS = 8


def _listed(name: str, rows: DataFrame) -> DataFrame:
    return rows.select(F.lit(name).alias("dimension"), *NUMBERS)


def _collected(parts: list[DataFrame]) -> list[tuple[str, int, int]]:
    if not parts:
        return []
    # One more than can be told apart, which then is an error.
    rows = reduce(DataFrame.unionByName, parts).limit(MOST_SECOND_KEYS + 1).collect()
    return sorted({tuple(r) for r in rows})


def shared_keys(warehouse: Warehouse) -> list[Row]:
    """The dimensions with members that share a key, and how many (see ``dq_duplicate_keys``)."""
    return dq_duplicate_keys(warehouse.table).where("duplicate_keys > 0").collect()


def among_members(warehouse: Warehouse, twice: list[Row] | None = None) -> list[tuple[str, int, int]]:
    """Members whose key another one has; the one of least second number keeps it."""
    parts = []
    for name in (r.dimension for r in (shared_keys(warehouse) if twice is None else twice)):
        members = warehouse.numbered(name)
        shared = members.groupBy("id").agg(F.min(NUMBERS[1]).alias("least"), F.count("*").alias("n"))
        moved = members.join(shared.where("n > 1"), "id").where(F.col(NUMBERS[1]) > F.col("least"))
        parts.append(_listed(name, moved))
    return _collected(parts)


def crowded(warehouse: Warehouse, twice: list[Row] | None = None) -> list[str]:
    """Dimensions to be given second keys as a whole, the most colliding first, so that the
    colliding members of the others can be listed."""
    keys = warehouse.source.keys
    twice = shared_keys(warehouse) if twice is None else twice
    moved = {r.dimension: r.members - r.distinct_keys for r in twice}
    if shared := sorted({*moved} & {*keys.whole}):
        raise ValueError(f"members of {shared} share their second keys too")
    found = []
    while sum(moved.values()) + sum(m[0] not in found for m in keys.second) > MOST_SECOND_KEYS and moved:
        found.append(max(moved, key=moved.get))
        del moved[found[-1]]
    return found


def _others(name: str, members: DataFrame, stored: Callable[[str], DataFrame]) -> DataFrame:
    """Members whose key a stored one of other attributes has."""
    columns = [c for c in members.columns if c not in NUMBERS]
    known = stored(name).select(*(F.col(c).alias(f"{c}__stored") for c in columns))
    both = members.join(known, F.col("id") == F.col("id__stored"))
    other = [~F.col(c).eqNullSafe(F.col(f"{c}__stored")) for c in columns if c != "id"]
    return both.where(reduce(lambda a, b: a | b, other))


def with_stored(
    warehouse: Warehouse, stored: Callable[[str], DataFrame]
) -> list[tuple[str, int, int]]:
    """Members whose key a stored one of other attributes has.

    Whole rows are compared only where keys meet. The members as written are compared first,
    and numbers are computed only for the dimensions where some differ, which is rare.
    """
    differ = [
        _others(d, warehouse.table(d), stored).select(F.lit(d).alias("dimension")) for d in DIMENSIONS
    ]
    found = {r.dimension for r in reduce(DataFrame.unionByName, differ).distinct().collect()}
    return _collected(
        [_listed(d, _others(d, warehouse.numbered(d), stored)) for d in DIMENSIONS if d in found]
    )


def settled(
    make: Callable[[Keys], Warehouse],
    keys: Keys = PLAIN,
    stored: Callable[[str], DataFrame] | None = None,
) -> Warehouse:
    """A warehouse of which no two members have one key, and none that of a stored member.

    ``make`` gives the warehouse with the keys it is told; it is called again with second
    keys for the members that collide. Members that are stored keep the keys they have, so
    that a dimension is given second keys as a whole only where nothing is stored.
    """
    for _ in range(ROUNDS):
        warehouse = make(keys)
        # All dimensions are read here; written one by one, they would leave the cluster idle.
        warehouse.store(DIMENSIONS)
        twice = None
        if stored is None:
            twice = shared_keys(warehouse)
            if whole := crowded(warehouse, twice):
                keys = keys.widened(whole)
                continue
        # Those that are stored come first, so that they keep their keys.
        found = with_stored(warehouse, stored) if stored else []
        found = found or among_members(warehouse, twice)
        if not found:
            return warehouse
        keys = keys.extended(found)
    raise ValueError(f"members still share keys after {ROUNDS} rounds")


def noted(keys: Keys) -> dict[str, object]:
    return {
        "bits": keys.bits,
        "second": [[*pair] for pair in keys.second],
        "whole": [*keys.whole],
    }


def from_note(note: Mapping[str, object] | None) -> Keys:
    if note is None:
        return PLAIN
    second = tuple((name, first, second) for name, first, second in note["second"])
    return Keys(note["bits"], second, tuple(note.get("whole", ())))
