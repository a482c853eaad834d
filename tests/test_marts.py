from decimal import Decimal

import pytest
from conftest import rows

from salesmart.plans.reports import REPORTS, top


def one(frame):
    (row,) = frame.collect()
    return row.asDict()


def test_product_mart_keeps_own_and_multiplied_reviews(warehouse):
    mart = one(warehouse({}, {"sale_total_price": Decimal("5.50")}).plan("sales_by_product"))
    assert mart["total_revenue"] == Decimal("25.50")
    assert mart["total_quantity"] == 10
    assert mart["review_count"] == 100
    assert mart["reviews_over_sales"] == 200
    assert mart["avg_rating"] == 4.5


def test_product_without_category_leaves_only_the_product_mart(warehouse):
    w = warehouse({}, {"product_category": None})
    assert w.plan("sales_by_product").count() == 1
    assert w.plan("product_quality").count() == 2


def test_sale_without_date_leaves_the_dated_marts(warehouse):
    w = warehouse({}, {"sale_date": None, "sale_total_price": Decimal("7.00")})
    assert one(w.plan("sales_by_customer"))["total_spent"] == Decimal("20.00")
    assert one(w.plan("sales_by_time"))["total_revenue"] == Decimal("20.00")
    assert one(w.plan("sales_by_store"))["total_revenue"] == Decimal("20.00")
    assert one(w.plan("sales_by_product"))["total_revenue"] == Decimal("27.00")
    assert one(w.plan("sales_by_supplier"))["total_revenue"] == Decimal("27.00")
    assert one(w.plan("product_quality"))["total_quantity"] == 10


@pytest.mark.parametrize("part", ["customer_first_name", "customer_last_name"])
def test_customer_name_is_null_when_a_part_is(warehouse, part):
    mart = one(warehouse({part: None}).plan("sales_by_customer"))
    assert mart["customer_name"] is None
    assert mart["total_spent"] == Decimal("20.00")


def test_customer_average_skips_sales_without_price(warehouse):
    w = warehouse({}, {"sale_total_price": None}, {"sale_total_price": Decimal("1.00")})
    assert one(w.plan("sales_by_customer"))["avg_order_value"] == 10.5
    assert one(w.plan("sales_by_time"))["avg_order_size"] == 7.0
    only_null = warehouse({"sale_total_price": None})
    assert one(only_null.plan("sales_by_customer"))["avg_order_value"] is None


def test_unknown_country_is_kept_as_null(warehouse):
    w = warehouse({"customer_country": None, "store_country": None, "supplier_country": None})
    for mart in ("sales_by_customer", "sales_by_store", "sales_by_supplier"):
        assert one(w.plan(mart))["country"] is None


def test_store_mart_has_city_and_location(warehouse):
    mart = one(warehouse({}).plan("sales_by_store"))
    assert (mart["city"], mart["location"], mart["country"]) == ("Rome", "Mall", "Italy")


def test_supplier_price_weighs_every_sale(warehouse):
    w = warehouse({}, {}, {"product_price": Decimal("40.00"), "product_quantity": 1})
    mart = one(w.plan("sales_by_supplier"))
    assert mart["avg_price"] == 20.0
    assert mart["avg_quantity"] == 3.6667


def test_totals_beyond_ten_digits(warehouse):
    big = {"sale_total_price": Decimal("999999999999.99")}
    mart = one(warehouse(big, big, big).plan("sales_by_time"))
    assert mart["total_revenue"] == Decimal("2999999999999.97")


def test_averages_round_half_up_exactly(warehouse):
    # 0.01 / 8 = 0.00125 -> 0.0013, which binary division may miss.
    prices = [{"sale_total_price": Decimal("0.01")}] + [{"sale_total_price": Decimal("0")}] * 7
    assert one(warehouse(*prices).plan("sales_by_time"))["avg_order_size"] == 0.0013


def months(*pairs):
    return [{"sale_date": d, "sale_total_price": Decimal(p)} for d, p in pairs]


def test_period_comparison_does_not_bridge_gaps(warehouse):
    w = warehouse(*months(("01/05/2020", "10"), ("03/05/2020", "30"), ("01/07/2021", "15")))
    got = {
        (r.year, r.month): (r.prev_month_revenue, r.prev_year_revenue, r.prev_year_change)
        for r in REPORTS["revenue_period_compare"](w.table).collect()
    }
    assert got == {
        (2020, 1): (None, None, None),
        (2020, 3): (None, None, None),
        (2021, 1): (None, Decimal("10.00"), Decimal("5.00")),
    }


def test_period_comparison_crosses_the_year(warehouse):
    w = warehouse(*months(("12/31/2020", "10"), ("01/01/2021", "4")))
    got = {(r.year, r.month): r for r in REPORTS["revenue_period_compare"](w.table).collect()}
    assert got[(2021, 1)].prev_month_change == Decimal("-6.00")


def test_trend_has_months_years_and_total(warehouse):
    w = warehouse(*months(("01/05/2020", "10"), ("03/05/2020", "30"), ("01/07/2021", "15")))
    got = {(r.year, r.month): r.total_revenue for r in REPORTS["sales_trend"](w.table).collect()}
    assert got[(None, None)] == Decimal("55.00")
    assert got[(2020, None)] == Decimal("40.00")
    assert len(got) == 6


def test_top_breaks_ties_by_key_and_ranks_null_last(spark):
    frame = spark.createDataFrame([(3, 5), (1, 5), (2, 5), (4, None)], "k int, v int")
    assert [r.k for r in top(frame, "v", "k", 2).collect()] == [1, 2]
    assert [r.k for r in top(frame, "v", "k", 9, ascending=True).collect()] == [1, 2, 3, 4]


def test_top_products_by_quantity(warehouse):
    sales = [{"product_name": f"p{i:02}", "product_quantity": i} for i in range(15)]
    best = REPORTS["top_products"](warehouse(*sales).table).collect()
    assert [r.total_quantity for r in best] == list(range(14, 4, -1))


def test_customers_without_country_are_counted(warehouse):
    w = warehouse({}, {"customer_country": None}, {"customer_age": 1, "customer_country": None})
    got = REPORTS["customers_by_country"](w.table)
    assert rows(got) == sorted([("Chad", 1), (None, 2)], key=repr)


def test_rating_extremes_have_both_ends(warehouse):
    sales = [{"product_name": f"p{i:02}", "product_rating": i / 4} for i in range(4, 20)]
    got = REPORTS["rating_extremes"](warehouse(*sales, {"product_rating": None}).table).collect()
    assert sorted(r.rating for r in got if r.side == "highest") == [i / 4 for i in range(10, 20)]
    assert sorted(r.rating for r in got if r.side == "lowest") == [i / 4 for i in range(4, 14)]


def test_rating_sales_correlation(warehouse):
    sales = [
        {"product_name": f"p{i}", "product_rating": float(i), "product_quantity": 10 - 2 * i}
        for i in range(1, 5)
    ]
    got = one(REPORTS["rating_sales_corr"](warehouse(*sales).table))
    assert got == {"products": 4, "rating_sales_corr": -1.0}
