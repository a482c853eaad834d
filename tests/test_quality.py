import threading
from decimal import Decimal

from salesmart.plans import quality


def table(frame, *keys):
    return {tuple(r[k] for k in keys): r for r in frame.collect()}


def test_clean_warehouse_has_unique_keys_and_no_orphans(warehouse):
    w = warehouse({}, {"customer_age": 31}, {"product_color": None})
    keys = table(quality.dq_duplicate_keys(w.table), "dimension")
    assert len(keys) == 17
    assert all(r.duplicate_keys == 0 and r.members == r.distinct_keys for r in keys.values())
    fks = table(quality.dq_orphans(w.table), "table_name", "foreign_key")
    assert len(fks) == 22 + 1
    assert all(r.orphan_keys == 0 for r in fks.values())
    assert fks[("dim_products", "color_id")].null_keys == 1
    assert fks[("fact_sales", "customer_id")].row_count == 3


def test_duplicate_key_is_found(warehouse):
    w = warehouse({}, {"customer_age": 31})

    def read(name):
        frame = w.table(name)
        return frame.unionByName(frame.limit(1)) if name == "dim_customers" else frame

    found = table(quality.dq_duplicate_keys(read), "dimension")
    assert found[("dim_customers",)].duplicate_keys == 1
    assert found[("dim_customers",)].members == 3


def test_orphans_are_found(warehouse):
    w = warehouse({}, {"supplier_email": None}, {"customer_age": 31})

    def read(name):
        frame = w.table(name)
        return frame.where("age = 30") if name == "dim_customers" else frame

    found = table(quality.dq_orphans(read), "table_name", "foreign_key")
    assert found[("fact_sales", "customer_id")].orphan_keys == 1
    assert found[("fact_sales", "supplier_id")].null_keys == 1


def test_fanout_counts_what_a_name_join_would_give(warehouse):
    w = warehouse({}, {}, {"product_price": Decimal("1.00")}, {"product_name": "other"})
    got = table(quality.dq_fanout(w.table), "entity")[("product",)]
    assert got.natural_keys == 2
    assert got.ambiguous_keys == 1
    assert got.max_members == 2
    assert got.sale_rows == 4
    assert got.joined_rows == 3 * 2 + 1


def test_reconcile_explains_every_missing_sale(warehouse):
    w = warehouse(
        {},
        {"sale_date": None},
        {"customer_email": None},
        {"product_name": None},
        {"product_category": None},
        {"supplier_email": None, "sale_total_price": Decimal("3.00")},
    )
    got = table(quality.dq_reconcile(w.table), "layer")
    assert set(got) == {
        ("source",),
        ("fact_sales",),
        ("sales_by_product",),
        ("sales_by_customer",),
        ("sales_by_time",),
        ("sales_by_store",),
        ("sales_by_supplier",),
    }
    assert all(r.gap == 0 for r in got.values())
    assert got[("source",)].row_count == got[("fact_sales",)].row_count == 6
    assert got[("sales_by_product",)].excluded_revenue == Decimal("40.00")
    assert got[("sales_by_supplier",)].excluded_revenue == Decimal("3.00")


def test_reconcile_shows_a_lost_sale(warehouse):
    w = warehouse({}, {"product_name": "other"})

    def read(name):
        frame = w.table(name)
        return frame.where("product_name = 'bowl'") if name == "sales_by_product" else frame

    got = table(quality.dq_reconcile(read), "layer")
    assert got[("sales_by_product",)].gap == Decimal("20.00")


def test_overflow_is_counted_not_raised(warehouse):
    w = warehouse({}, {"sale_total_price": Decimal("100000000.00")})
    got = table(quality.dq_overflow(w.table), "table_name", "column_name")
    assert got[("fact_sales", "total_price")].overflowing == 1
    assert got[("fact_sales", "total_price")].non_null == 2
    assert got[("dim_products", "price")].overflowing == 0
    assert got[("sales_by_time", "total_revenue")].overflowing == 1


def test_overflow_asks_for_its_tables_at_once(warehouse):
    w = warehouse({}, {})
    # Each waits for all others: one after another, the first would wait in vain.
    met = threading.Barrier(7, timeout=30)

    def read(name):
        met.wait()
        return w.table(name)

    got = table(quality.dq_overflow(read), "table_name", "column_name")
    assert got[("fact_sales", "total_price")].non_null == 2
