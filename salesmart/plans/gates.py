"""Rules that a version of the tables has to keep, judged before it is committed.

They take what the writes have observed anyway and the sums per foreign key that the marts
are made of, so that no sale is read for them: a reference to no member is a key of the sums
without a member.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.plans.quality import dq_duplicate_keys
from salesmart.plans.sums import SUMS
from salesmart.schema import FOREIGN_KEYS
from salesmart.sinks.snapshots import Attempt


@dataclass(frozen=True)
class Violation:
    rule: str
    where: str
    found: int | Decimal


class BrokenRules(ValueError):
    def __init__(self, violations: list[Violation]) -> None:
        super().__init__("; ".join(f"{v.rule} in {v.where}: {v.found}" for v in violations))
        self.violations = violations


def fact_metrics() -> dict:
    """What is observed while the fact is written."""
    return {
        "rows": F.count(F.lit(1)),
        "revenue": F.sum("total_price"),
        **{f"no_{fk}": F.count_if(F.col(fk).isNull()) for fk in FOREIGN_KEYS["fact_sales"]},
    }


def references(attempt: Attempt) -> DataFrame:
    """(where, dim, id, n): uses of every key by the rows that were added."""
    parts = []
    for table, keys in FOREIGN_KEYS.items():
        if table == "fact_sales":
            sums = attempt.added(SUMS)
            dims = F.create_map(*(F.lit(x) for pair in keys.items() for x in pair))
            where = F.concat(F.lit("fact_sales."), "role").alias("where")
            parts.append(sums.select(where, dims[F.col("role")].alias("dim"), "id", F.col("sales").alias("n")))
            continue
        for fk, dim in keys.items():
            uses = attempt.added(table).groupBy(F.col(fk).alias("id")).agg(F.count("*").alias("n"))
            parts.append(uses.select(F.lit(f"{table}.{fk}").alias("where"), F.lit(dim).alias("dim"), "id", "n"))
    return reduce(DataFrame.unionByName, parts).where(F.col("id").isNotNull())


def orphans(attempt: Attempt) -> DataFrame:
    """(where, n): rows that refer to no member."""
    dims = sorted({dim for keys in FOREIGN_KEYS.values() for dim in keys.values()})
    ids = [attempt.read(d).select(F.lit(d).alias("dim"), "id") for d in dims]
    lost = references(attempt).join(reduce(DataFrame.unionByName, ids), ["dim", "id"], "left_anti")
    return lost.groupBy("where").agg(F.sum("n").alias("n"))


def violations(attempt: Attempt, expected: dict[str, int | Decimal] | None = None) -> list[Violation]:
    """Broken rules. ``expected`` has the rows and revenue that the loads have noted, if they have."""
    asked = (
        orphans(attempt),
        dq_duplicate_keys(attempt.read).where("duplicate_keys > 0"),
        attempt.added(SUMS).groupBy("role").agg(F.sum("sales").alias("n")),
    )
    with ThreadPoolExecutor(len(asked)) as pool:
        lost, twice, roles = pool.map(DataFrame.collect, asked)
    found = [Violation("references to no member", r["where"], r["n"]) for r in lost]
    found += [Violation("keys of several members", r.dimension, r.duplicate_keys) for r in twice]
    seen = attempt.observed["fact_sales"]
    written = {"rows": seen.get("rows") or 0, "revenue": seen.get("revenue") or Decimal(0)}
    for name, wanted in (expected or {}).items():
        if written[name] != wanted:
            found.append(Violation(f"{name} lost", "fact_sales", wanted - written[name]))
    found += [
        Violation("sums do not cover the sales", r.role, written["rows"] - r.n)
        for r in roles
        if r.n != written["rows"]
    ]
    return found


def enforce(attempt: Attempt, expected: dict[str, int | Decimal] | None = None) -> None:
    broken = violations(attempt, expected)
    if broken:
        raise BrokenRules(broken)
