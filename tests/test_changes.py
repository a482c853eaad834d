"""What differs between two versions of a table: digests, and changes of exports."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from salesmart.plans.digests import (
    bucket_digests,
    differences,
    differing_buckets,
    differing_columns,
    dq_digest,
)
from salesmart.sinks.changes import EXPORT_KEYS, applied, changes
from salesmart.sinks.export import EXPORTS


def sales(n):
    return [{"id": i, "customer_age": 20 + i % 7, "store_name": f"s{i % 3}", "product_name": f"p{i % 5}"} for i in range(n)]


def test_two_swapped_references_are_found(warehouse, tmp_path):
    w = warehouse(*sales(60), root=str(tmp_path / "w"))
    fact = w.plan("fact_sales")
    ids = {r.source_id: r.customer_id for r in fact.collect()}
    swap = F.when(F.col("source_id") == 3, ids[8]).when(F.col("source_id") == 8, ids[3])
    wrong = fact.withColumn("customer_id", F.coalesce(swap, "customer_id"))
    total = F.sum(F.col("customer_id").cast("decimal(38,0)"))
    assert rows(wrong.agg(F.count("*"), total)) == rows(fact.agg(F.count("*"), total))
    found = differences(fact, wrong, "source_id")
    assert {(r.side, r.source_id, r.customer_id) for r in found.collect()} == {
        ("wanted", 3, ids[3]), ("wanted", 8, ids[8]), ("stored", 3, ids[8]), ("stored", 8, ids[3])
    }
    assert rows(differing_columns(found, "source_id")) == [(3, ["customer_id"]), (8, ["customer_id"])]
    bad = differing_buckets(bucket_digests(fact, "source_id"), bucket_digests(wrong, "source_id"))
    assert bad.count() <= 2
    assert differences(fact, fact.repartition(7), "source_id").isEmpty()

    def stored(name):
        return wrong if name == "fact_sales" else w.table(name)

    report = {r.table_name: r for r in dq_digest(w.table, stored).collect()}
    assert len(report) == 18
    assert [t for t, r in report.items() if r.differing_rows] == ["fact_sales"]
    assert (report["fact_sales"].first_key, report["fact_sales"].last_key) == (3, 8)


@pytest.mark.parametrize("buckets", [1, 4096])
def test_missing_repeated_and_empty_rows(spark, buckets):
    def table(*found):
        return spark.createDataFrame(found, "id bigint, a string, b string")

    one = table((1, "x", None), (2, None, "x"), (3, "", None), (4, "p", "q"), (None, "n", "n"))
    two = table((1, "x", None), (2, "x", None), (3, None, ""), (4, "p", "q"), (4, "p", "q"), (5, "new", ""), (None, "n", "n"))
    found = differences(one, two, "id", buckets)
    assert {(r.side, r.times, r.id) for r in found.collect()} == {
        ("wanted", 1, 2), ("stored", 1, 2), ("wanted", 1, 3), ("stored", 1, 3), ("stored", 1, 4), ("stored", 1, 5)
    }
    named = {r.id: r.columns for r in differing_columns(found, "id").collect()}
    assert named == {2: ["a", "b"], 3: ["a", "b"], 4: None, 5: None}
    empty = one.limit(0)
    assert differences(empty, empty, "id", buckets).isEmpty()
    assert differences(one, empty, "id", buckets).count() == 5


@pytest.mark.parametrize("name", EXPORTS)
def test_changes_lead_from_one_export_to_the_next(warehouse, tmp_path, name):
    old = warehouse(*sales(20), root=str(tmp_path / "old"))
    more = [{"id": 50, "product_name": "new", "store_city": None}, {"id": 51, "store_name": "s0"}]
    new = warehouse(*sales(20)[4:], *more, root=str(tmp_path / "new"))
    before, after = (EXPORTS[name](w.table) for w in (old, new))
    key = EXPORT_KEYS[name]
    found = changes(before, after, key)
    once = applied(before, found, key)
    assert rows(once) == rows(after.select(*once.columns))
    assert rows(applied(once, found, key)) == rows(once)
    ops = {r.op for r in found.select("op").distinct().collect()}
    assert "upsert" in ops and found.count() < before.count() + after.count()
    assert changes(after, after, key).isEmpty()
    assert {r.op for r in changes(before, before.limit(0), key).collect()} == {"delete"}


def test_the_plan_of_export_changes_builds_no_mart_again(spark, tmp_path, monkeypatch):
    from decimal import Decimal

    import __spark_entry__ as entry
    from pyspark.sql import types as T

    from salesmart.schema import MART_SCHEMAS

    def mart(name, version):
        values = {T.StringType: "a", T.DoubleType: 1.0, T.DecimalType: Decimal(version)}
        row = tuple(values.get(type(f.dataType), 1) for f in MART_SCHEMAS[name])
        return spark.createDataFrame([row], MART_SCHEMAS[name]).distinct()

    monkeypatch.setattr(entry, "_lake", lambda spark, sf_dir: "lake")
    monkeypatch.setattr(entry, "_stored", lambda spark, sf_dir, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(entry, "reader", lambda spark, folder, version: version)
    marts = {m: lambda version, m=m: mart(m, version) for m in MART_SCHEMAS}
    monkeypatch.setattr(entry, "MARTS_OF_SUMS", marts)
    found = entry._export_changes(spark, "")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Aggregate" not in plan
    assert {r.value for r in found.where("field like 'total_%'").collect()} == {"1", "3.00"}
