from __future__ import annotations

import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from salesmart.schema import FLAT_COLUMNS, FLAT_SCHEMA  # noqa: E402
from salesmart.session import build_session  # noqa: E402

TESTDATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "2g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


BASE = {
    "id": 1,
    "customer_first_name": "Ann",
    "customer_last_name": "Lee",
    "customer_age": 30,
    "customer_email": "ann@example.com",
    "customer_country": "Chad",
    "customer_postal_code": "P1",
    "customer_pet_type": "cat",
    "customer_pet_name": "Tom",
    "customer_pet_breed": "Manx",
    "seller_first_name": "Sid",
    "seller_last_name": "Ray",
    "seller_email": "sid@example.com",
    "seller_country": "Peru",
    "seller_postal_code": None,
    "product_name": "bowl",
    "product_category": "Food",
    "product_price": Decimal("10.00"),
    "product_quantity": 5,
    "sale_date": "05/04/2021",
    "sale_customer_id": 1,
    "sale_seller_id": 1,
    "sale_product_id": 1,
    "sale_quantity": 2,
    "sale_total_price": Decimal("20.00"),
    "store_name": "Shop",
    "store_location": "Mall",
    "store_city": "Rome",
    "store_state": None,
    "store_country": "Italy",
    "store_phone": None,
    "store_email": "shop@example.com",
    "pet_category": "Cats",
    "product_weight": 1.5,
    "product_color": "red",
    "product_size": "L",
    "product_brand": "Acme",
    "product_material": "steel",
    "product_description": "a bowl",
    "product_rating": 4.5,
    "product_reviews": 100,
    "product_release_date": "01/01/2020",
    "product_expiry_date": "01/01/2030",
    "supplier_name": "Sup",
    "supplier_contact": "Sue",
    "supplier_email": "sup@example.com",
    "supplier_phone": None,
    "supplier_address": None,
    "supplier_city": "Lima",
    "supplier_country": "Peru",
}


def flat_rows(*changes: dict) -> list[dict]:
    assert tuple(BASE) == FLAT_COLUMNS
    return [{**BASE, **c} for c in changes]


@pytest.fixture
def flat(spark):
    def make(*changes: dict):
        rows = [tuple(r.values()) for r in flat_rows(*changes)]
        return spark.createDataFrame(rows, FLAT_SCHEMA)

    return make


@pytest.fixture
def warehouse(spark, flat):
    from salesmart.plans.warehouse import Warehouse
    from salesmart.sources.base import from_flat

    def make(*changes: dict, root: str | None = None):
        return Warehouse(spark, from_flat(flat(*changes)), root)

    return make


@pytest.fixture(scope="session")
def testdata():
    if not TESTDATA.exists():
        pytest.skip("no test data")
    return str(TESTDATA)


def rows(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=repr)
