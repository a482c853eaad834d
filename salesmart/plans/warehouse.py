"""Tables of the warehouse and how each is built from the ones before it."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from threading import Lock, RLock

from pyspark.sql import DataFrame, SparkSession

from salesmart.operators.dims import dimension, numbered_dimension
from salesmart.operators.facts import fact_sales
from salesmart.plans.marts import MARTS
from salesmart.schema import DIMENSIONS, ENTITIES
from salesmart.session import shared_folder, size_shuffles
from salesmart.sources.base import SalesSource


CONCURRENT_WRITES = 8

# The raw and flat rows are the input itself; the fact only renames and blanks columns
# of the keyed rows.
NEVER_WRITTEN = ("raw", "flat", "fact_sales")


class Warehouse:
    """Lazy plans over one sales input, each intermediate table written once.

    Order of derivation: flat rows -> keyed rows and members (the only readers
    of the input) -> dimensions and fact -> marts. ``plan`` gives the plan of a
    table; ``table`` writes it below ``root`` on first use and reads it from
    there afterwards, so the input is joined once however many marts and
    reports follow, and a lost executor costs no more than the stage it was in.
    With no ``root`` everything stays one lazy plan.
    """

    def __init__(self, spark: SparkSession, source: SalesSource, root: str | None = None):
        self.spark = spark
        self.source = source
        self.root = root
        self._written: dict[str, DataFrame] = {}
        self._locks: defaultdict[str, RLock] = defaultdict(RLock)
        self._guard = Lock()
        size_shuffles(spark, source.input_bytes)

    def plan(self, name: str) -> DataFrame:
        if name == "raw":
            return self.source.raw
        if name == "flat":
            return self.source.flat
        if name == "keyed":
            return self.source.keyed
        if name.startswith("members_"):
            entity = ENTITIES[name.removeprefix("members_")]
            return self.source.members(entity, self.table("keyed"))
        if name == "fact_sales":
            return fact_sales(self.table("keyed"))
        if name in DIMENSIONS:
            return dimension(name, self.table, self.source.keys)
        if name in MARTS:
            return MARTS[name](self.table)
        raise KeyError(name)

    def numbered(self, name: str) -> DataFrame:
        """A dimension's members with the numbers that their keys come from."""
        return numbered_dimension(name, self.table, self.source.keys)

    def table(self, name: str) -> DataFrame:
        if name in NEVER_WRITTEN:
            return self.plan(name)
        return self.kept(name)

    def kept(self, name: str) -> DataFrame:
        """A table, written on first use also where ``table`` would give its plan: for those
        who read flat rows several times. They are stored as joined, and shaped as they are read."""
        if self.root is None:
            return self.plan(name)
        with self._guard:
            lock = self._locks[name]
        with lock:
            if name not in self._written:
                path = f"{self.root}/{name}"
                narrow = name == "flat" and self.source.joined is not None
                frame = self.source.joined if narrow else self.plan(name)
                frame.write.mode("overwrite").option("compression", "zstd").parquet(path)
                stored = self.spark.read.schema(frame.schema).parquet(path)
                self._written[name] = self.source.shape(stored) if narrow else stored
            return self._written[name]

    def store(self, names: Iterable[str], work: Callable[[str], object] | None = None) -> None:
        """Write tables, several at a time.

        Most are small and would leave the cluster idle one by one. What they
        share is written first, so no two wait for each other.
        """
        if self.root:
            self.table("keyed")
        with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
            if self.root:
                list(pool.map(self.table, (f"members_{e}" for e in ENTITIES)))
            list(pool.map(work or self.table, names))


_OPEN: dict[tuple[str, str], Warehouse] = {}


def shared_warehouse(spark: SparkSession, source_name: str, make_source) -> Warehouse:
    """The warehouse of this application over a named input.

    Its tables live in a folder of their own below the shared folder, so no
    other run sees them and none is read from an earlier run.
    """
    key = (spark.sparkContext.applicationId, source_name)
    if key not in _OPEN:
        folder = shared_folder(spark)
        root = folder and f"{folder}/salesmart-{key[0]}-{uuid.uuid4().hex[:8]}"
        _OPEN[key] = Warehouse(spark, make_source(spark, source_name), root)
    return _OPEN[key]
