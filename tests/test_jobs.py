"""The three jobs end to end, from CSV files to marts: versions, next files, rules."""

import re
import shutil
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_load import write

from salesmart.jobs import marts, normalise
from salesmart.jobs.normalise import add_files, refresh_files
from salesmart.plans.gates import BrokenRules
from salesmart.plans.marts import MARTS, MARTS_OF_SUMS
from salesmart.plans.sums import MEASURES, ROLES, SUMS, merged, sums_of
from salesmart.plans.warehouse import Warehouse
from salesmart.schema import DIMENSIONS, MART_SCHEMAS, WAREHOUSE_TABLES
from salesmart.sinks import snapshots
from salesmart.sinks.snapshots import Attempt, reader, snapshot
from salesmart.sinks.tables import load_csv


@pytest.fixture
def lake(spark, tmp_path):
    """Folders of a lake, and shorthands for its jobs."""

    class Lake:
        inbox, staging = tmp_path / "in", str(tmp_path / "staging")
        tables, marts = str(tmp_path / "tables"), str(tmp_path / "marts")
        runs = 0

        def work(self):
            self.runs += 1
            return str(tmp_path / f"work{self.runs}")

        def load(self, name, *changes):
            write(self.inbox / name, *changes)
            return load_csv(spark, str(self.inbox), self.staging)

        def refresh(self):
            return refresh_files(spark, self.staging, self.tables, self.work())

        def add(self):
            return add_files(spark, self.staging, self.tables, self.work())

        def stored(self):
            read = reader(spark, self.tables)
            return {t: rows(read(t)) for t in WAREHOUSE_TABLES}

        def rebuilt(self):
            """All tables and marts from all that is staged, without any of this."""
            whole = Warehouse(spark, normalise.staged_source(spark, self.staging), self.work())
            return {t: whole.plan(t) for t in (*WAREHOUSE_TABLES, *MARTS)}

    Lake.inbox.mkdir()
    return Lake()


def same(frame, other):
    columns = other.columns
    return rows(frame.select(*columns)) == rows(other)


def test_files_to_marts_and_again(spark, lake):
    lake.load("a.csv", {}, {"id": 2, "customer_age": 40}, {"id": 3, "product_color": ""})
    seen = []
    for _ in range(2):
        lake.refresh()
        assert marts.store_files(spark, lake.tables, lake.marts)
        # Nothing has changed since, so nothing is written.
        assert marts.store_files(spark, lake.tables, lake.marts) is None
        read, rebuilt = reader(spark, lake.marts), lake.rebuilt()
        for mart in MART_SCHEMAS:
            assert same(read(mart), rebuilt[mart].select(*MART_SCHEMAS[mart].fieldNames()))
        seen.append(lake.stored() | {m: rows(read(m)) for m in MART_SCHEMAS})
    assert seen[0] == seen[1]
    assert len(seen[0]["fact_sales"]) == 3
    assert len(seen[0]["dim_customers"]) == 2


NEXT = [{"product_brand": "Other"}, {"id": 2, "customer_country": "Oman", "sale_date": "01/02/2022"}]


def test_next_files_are_added_once(spark, lake):
    lake.load("a.csv", {}, {"id": 2, "customer_age": 40})
    with pytest.raises(ValueError, match="refresh it first"):
        lake.add()
    lake.refresh()
    before = lake.stored()
    assert lake.add() is None and lake.stored() == before
    # Another file with the same ids, one known customer and one new.
    lake.load("b.csv", *NEXT)
    assert lake.add().version == 2
    after = lake.stored()
    assert len(after["fact_sales"]) == 4
    assert len(after["dim_customers"]) == 3 and len(after["dim_products"]) == 2
    assert lake.add() is None
    rebuilt = lake.rebuilt()
    for name in WAREHOUSE_TABLES:
        assert same(reader(spark, lake.tables)(name), rebuilt[name]), name


def test_a_stopped_run_leaves_the_old_version(spark, lake, monkeypatch):
    """Stopped before each of its tables and before its commit, and then run again."""
    lake.load("a.csv", {}, {"id": 2, "customer_age": 40})
    lake.refresh()
    before, write_ = lake.stored(), Attempt._write
    lake.load("b.csv", *NEXT)
    tables = [*DIMENSIONS, "fact_sales", SUMS]

    class Stopped(RuntimeError):
        pass

    for job in (lake.add, lake.refresh):
        for last in (tables if job == lake.add else tables[-1:])[::-9]:

            def write(self, name, frame, how):
                if name == last:
                    raise Stopped(name)
                return write_(self, name, frame, how)

            monkeypatch.setattr(Attempt, "_write", write)
            with pytest.raises(Stopped):
                job()
            assert lake.stored() == before
        monkeypatch.setattr(Attempt, "_write", write_)

        def commit(self):
            raise Stopped

        with monkeypatch.context() as patch:
            patch.setattr(Attempt, "commit", commit)
            with pytest.raises(Stopped):
                job()
        assert lake.stored() == before
    read = reader(spark, lake.tables)
    lake.add()
    # A reader keeps to the version it began with.
    assert {t: rows(read(t)) for t in WAREHOUSE_TABLES} == before
    rebuilt = lake.rebuilt()
    for name in WAREHOUSE_TABLES:
        assert same(reader(spark, lake.tables)(name), rebuilt[name]), name
    # What the stopped runs wrote, and no part of the last two versions, is cleared away.
    removed = snapshots.remove_old(spark, lake.tables)
    assert removed and lake.stored().keys() == before.keys()
    assert snapshots.remove_old(spark, lake.tables) == []


def test_marts_after_add_read_only_the_new_sales(spark, lake, monkeypatch):
    lake.load("a.csv", {}, {"id": 2, "customer_age": 40}, {"id": 3, "sale_date": None}, {"id": 4, "product_name": None})
    lake.refresh()
    lake.load("b.csv", *NEXT, {"id": 9, "sale_total_price": None, "supplier_name": "New"})
    read_by = []
    original = Attempt._write

    def write(self, name, frame, how):
        plan = frame._jdf.queryExecution().optimizedPlan()
        read_by.extend((name, f) for f in frame.inputFiles())
        assert plan is not None
        return original(self, name, frame, how)

    monkeypatch.setattr(Attempt, "_write", write)
    added = lake.add()
    facts = {f for _, f in read_by if "/fact_sales/" in f}
    (part,) = [p for p in added.tables["fact_sales"].parts if p.startswith("fact_sales/version=000002")]
    assert facts and all(part in f for f in facts)
    read_by.clear()
    marts.store_files(spark, lake.tables, lake.marts)
    assert read_by and not any("/fact_sales/" in f for _, f in read_by)
    read, rebuilt = reader(spark, lake.marts), lake.rebuilt()
    for mart in MARTS:
        assert same(read(mart), rebuilt[mart].select(*MART_SCHEMAS[mart].fieldNames())), mart


def test_many_loads_are_merged(spark, lake, monkeypatch):
    monkeypatch.setattr(snapshots, "MOST_PARTS", 2)
    lake.load("0.csv", {"id": 0})
    lake.refresh()
    for i in range(1, 4):
        lake.load(f"{i}.csv", {"id": i, "customer_age": 30 + i % 2}, {"id": 10 + i, "product_quantity": None})
        lake.add()
    tables = snapshot(spark, lake.tables).tables
    assert len(tables[SUMS].parts) <= 2 and len(tables["dim_products"].parts) <= 2
    assert len(tables["fact_sales"].parts) == 4
    marts.store_files(spark, lake.tables, lake.marts)
    read, rebuilt = reader(spark, lake.marts), lake.rebuilt()
    for mart in MARTS:
        assert same(read(mart), rebuilt[mart].select(*MART_SCHEMAS[mart].fieldNames())), mart


def test_broken_rules_stop_the_commit(spark, lake, monkeypatch):
    lake.load("a.csv", {}, {"id": 2, "customer_age": 40})
    lake.refresh()
    before = lake.stored()
    lake.load("b.csv", *NEXT)
    real = normalise.fact_rows

    def orphan(keyed):
        return real(keyed).withColumn("store_id", F.when(F.col("source_id") == 2, 5).otherwise(F.col("store_id")))

    def lost(keyed):
        return real(keyed).where("source_id <> 2")

    scanned = []
    count = Attempt.added

    def added(self, name):
        scanned.append(name)
        return count(self, name)

    monkeypatch.setattr(Attempt, "added", added)
    for damage, rule, where, jobs in (
        (orphan, "references to no member", "fact_sales.store_id", (lake.add, lake.refresh)),
        (lost, "rows lost", "fact_sales", (lake.add,)),
    ):
        for job in jobs:
            monkeypatch.setattr(normalise, "fact_rows", damage)
            scanned.clear()
            with pytest.raises(BrokenRules) as broken:
                job()
            assert (rule, where) in {(v.rule, v.where) for v in broken.value.violations}
            # The sales were read for their sums and for no rule.
            assert scanned.count("fact_sales") == 1
            assert lake.stored() == before
    monkeypatch.setattr(normalise, "fact_rows", real)

    def twice(self, name, frame, how):
        doubled = frame.unionAll(frame) if name == "dim_stores" else frame
        return original(self, name, doubled, how)

    original = Attempt._write
    monkeypatch.setattr(Attempt, "_write", twice)
    with pytest.raises(BrokenRules, match="keys of several members in dim_stores: 1"):
        lake.refresh()
    assert lake.stored() == before


def test_sums_add_up(spark, warehouse):
    sales = [
        {"id": i, "sale_total_price": None if i % 5 == 0 else Decimal(i), "sale_date": None if i % 7 == 0 else "01/02/2020",
         "product_name": f"p{i % 3}" if i % 4 else None, "product_quantity": i if i % 3 else None}
        for i in range(40)
    ]
    w = warehouse(*sales)
    fact = w.plan("fact_sales")
    parts = [sums_of(fact.where(F.col("source_id") % 3 == i)) for i in range(3)]
    both = merged(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert rows(both) == rows(sums_of(fact))
    assert both.groupBy("role").agg(F.sum("sales").alias("n")).where("n <> 40").isEmpty()
    stored = both

    def read(name):
        return stored if name == SUMS else w.table(name)

    for mart in MARTS:
        assert rows(MARTS_OF_SUMS[mart](read)) == rows(MARTS[mart](w.table)), mart
    plan = sums_of(fact)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 1
    assert len(ROLES) == 6 and len(MEASURES) == 3


def test_two_writers_of_one_version(spark, tmp_path):
    folder = str(tmp_path / "t")
    frame = spark.range(3)
    one, two = Attempt(spark, folder), Attempt(spark, folder)
    one.replace("t", frame)
    two.replace("t", frame.union(frame))
    assert one.commit().version == 1
    with pytest.raises(snapshots.Conflict):
        two.commit()
    assert reader(spark, folder)("t").count() == 3
    with pytest.raises(KeyError):
        reader(spark, folder)("other")
    # A commit file that was never renamed is no version.
    shutil.copy(tmp_path / "t" / "_snapshots" / "v000001.json", tmp_path / "t" / "_snapshots" / ".v000002.json-x")
    assert snapshots.versions(spark, folder) == [1]
    assert reader(spark, str(tmp_path / "none"), None) and snapshot(spark, str(tmp_path / "none")).version == 0


def natural(read):
    """Every sale with the names its keys lead to, and the marts without their keys."""
    names = {
        "customer_id": ("dim_customers", ["first_name", "age", "email"]),
        "product_id": ("dim_products", ["name", "price", "weight"]),
        "store_id": ("dim_stores", ["name", "location"]),
        "supplier_id": ("dim_suppliers", ["name", "email"]),
        "seller_id": ("dim_sellers", ["first_name", "email"]),
        "date_id": ("dim_dates", ["date"]),
    }
    sales = read("fact_sales")
    for key, (table, columns) in names.items():
        named = read(table).select(F.col("id").alias(key), *(F.col(c).alias(f"{key}_{c}") for c in columns))
        sales = sales.join(named, key, "left")
    cities = read("dim_cities").select(F.col("id").alias("city_id"), F.col("name").alias("city"))
    stores = read("dim_stores").join(cities, "city_id", "left").select("name", "location", "city")
    return {"sales": rows(sales.drop(*names, "sale_year")), "stores": rows(stores)}


@pytest.mark.parametrize("bits", [5])
def test_members_that_share_a_key_are_told_apart(spark, lake, monkeypatch, bits):
    """With keys of a few bits nearly all members collide, in the first load and with stored ones."""
    from salesmart.functions.keys import Keys
    from salesmart.plans import collisions

    def sales(first):
        return [
            {"id": i, "customer_email": f"c{i % 17}@example.com", "customer_country": f"Land {i % 9}",
             "product_name": f"p{i % 23}", "product_brand": f"b{i % 5}", "store_name": f"s{i % 7}",
             "store_city": f"Town {i % 11}", "supplier_name": f"u{i % 13}", "sale_date": f"01/{1 + i % 28:02d}/2021"}
            for i in range(first, first + 40)
        ]

    def run(short):
        lake.tables, lake.marts = (f"{lake.staging}-{short}-{x}" for x in "tm")
        with monkeypatch.context() as patch:
            if short:
                patch.setattr(normalise, "settled", lambda make, keys=None, stored=None: collisions.settled(
                    make, keys if keys and keys.second else Keys(bits), stored))
            lake.refresh()
            first = lake.stored()
            lake.load(f"b{short}.csv", *sales(30))
            added = lake.add()
        marts.store_files(spark, lake.tables, lake.marts)
        read = reader(spark, lake.tables)
        # What was stored keeps its keys.
        for table in DIMENSIONS:
            assert set(first[table]) <= set(rows(read(table)))
        found = natural(read)
        for mart in MARTS:
            named = reader(spark, lake.marts)(mart)
            found[mart] = rows(named.drop(*(c for c in named.columns if c.endswith("_id"))))
        return found, added

    lake.load("a.csv", *sales(0))
    plain, _ = run(0)
    shutil.rmtree(lake.staging)
    (lake.inbox / "b0.csv").unlink()
    lake.load("a.csv", *sales(0))
    short, added = run(bits)
    assert short == plain
    keys = added.notes["keys"]
    assert keys["bits"] == bits and len(keys["second"]) > (30 if bits == 5 else 0)
    source = lake.rebuilt
    joins = [
        normalise.staged_source(spark, lake.staging, None, collisions.from_note(keys)).keyed,
        normalise.staged_source(spark, lake.staging).keyed,
    ]
    assert source and not any("Join" in j._jdf.queryExecution().executedPlan().toString() for j in joins)


def test_dense_ids_stay(spark, lake):
    from salesmart.sinks.registry import IDS, dense_reader

    lake.load("a.csv", *({"id": i, "product_name": f"p{i}"} for i in range(5)))
    refresh_files(spark, lake.staging, lake.tables, lake.work(), ids=True)
    seen = []

    def ids():
        found = reader(spark, lake.tables)(IDS).where("dimension = 'dim_products'").collect()
        numbers = {r.id: r.dense_id for r in found}
        assert sorted(numbers.values()) == list(range(1, len(found) + 1))
        for before in seen:
            assert before.items() <= numbers.items()
        seen.append(numbers)
        return numbers

    assert len(ids()) == 5
    for i in (1, 2):
        lake.load(f"b{i}.csv", *({"id": 10 * i + j, "product_name": f"p{j + 3 * i}"} for j in range(5)))
        lake.add()
        assert len(ids()) == 5 + 3 * i
    again = seen[-1]
    lake.refresh()
    assert ids() == again
    read, dense = reader(spark, lake.tables), dense_reader(reader(spark, lake.tables))
    assert sorted(r.id for r in dense("dim_products").collect()) == list(range(1, 12))
    by_name = {r.id: r.name for r in dense("dim_products").collect()}
    by_key = {r.id: r.name for r in read("dim_products").collect()}
    named = sorted((r.source_id, by_name[r.product_id]) for r in dense("fact_sales").collect())
    assert named == sorted((r.source_id, by_key[r.product_id]) for r in read("fact_sales").collect())


def test_sales_are_written_while_the_dimensions_are(spark, flat, tmp_path, monkeypatch):
    import threading

    from salesmart.plans.warehouse import Warehouse
    from salesmart.sinks.snapshots import Attempt
    from salesmart.sources.base import from_flat

    sales = flat({"id": 1}, {"id": 2})
    met = threading.Barrier(2, timeout=60)
    write_sales, replace = normalise.write_sales, Attempt.replace

    def sales_meet(*args):
        met.wait()
        write_sales(*args)

    def one_meets(self, name, *args, **kwargs):
        if name == "dim_customers":
            met.wait()
        replace(self, name, *args, **kwargs)

    monkeypatch.setattr(normalise, "write_sales", sales_meet)
    monkeypatch.setattr(Attempt, "replace", one_meets)
    rounds = iter(range(9))
    make = lambda keys: Warehouse(spark, from_flat(sales, keys=keys), f"{tmp_path}/w{next(rounds)}")
    assert normalise.store_files(make, f"{tmp_path}/t").version == 1
    assert reader(spark, f"{tmp_path}/t")("fact_sales").count() == 2
