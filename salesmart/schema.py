"""Column lists, types and sort orders of every table the warehouse holds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Type of every money total. It is what Spark gives for a sum of decimal(14,2);
# 18 digits overflow at about 4e11 sales of average price.
MONEY = "decimal(24,2)"

# Fixed value: width the narrow stores declare for money; `dq_overflow` checks it.
NARROW_MONEY = "decimal(10,2)"

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "decimal(12,2)": T.DecimalType(12, 2),
    "decimal(14,2)": T.DecimalType(14, 2),
    "money": T.DecimalType(24, 2),
}


def _struct(fields: str) -> T.StructType:
    """Schema from lines of ``name type``; unlike a DDL string it needs no session."""
    pairs = (line.split() for line in fields.strip().splitlines())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Names, order and types of the 50 flat columns.
FLAT_FIELDS = """
    id bigint
    customer_first_name string
    customer_last_name string
    customer_age bigint
    customer_email string
    customer_country string
    customer_postal_code string
    customer_pet_type string
    customer_pet_name string
    customer_pet_breed string
    seller_first_name string
    seller_last_name string
    seller_email string
    seller_country string
    seller_postal_code string
    product_name string
    product_category string
    product_price decimal(12,2)
    product_quantity bigint
    sale_date string
    sale_customer_id bigint
    sale_seller_id bigint
    sale_product_id bigint
    sale_quantity bigint
    sale_total_price decimal(14,2)
    store_name string
    store_location string
    store_city string
    store_state string
    store_country string
    store_phone string
    store_email string
    pet_category string
    product_weight float
    product_color string
    product_size string
    product_brand string
    product_material string
    product_description string
    product_rating float
    product_reviews bigint
    product_release_date string
    product_expiry_date string
    supplier_name string
    supplier_contact string
    supplier_email string
    supplier_phone string
    supplier_address string
    supplier_city string
    supplier_country string
"""

FLAT_SCHEMA = _struct(FLAT_FIELDS)
FLAT_COLUMNS = tuple(FLAT_SCHEMA.fieldNames())

# Fixed value: the date text of the flat files. One-letter fields accept both
# `05/04/2021` and `5/4/2021`.
DATE_FORMAT = "M/d/yyyy"
DATE_COLUMNS = ("sale_date", "product_release_date", "product_expiry_date")


@dataclass(frozen=True)
class Entity:
    """A group of flat columns that describes one business object.

    ``attributes`` maps attribute -> flat column; together they are the natural
    key. ``anchor`` is the attribute without which a sale has no such object.
    """

    name: str
    attributes: dict[str, str]
    anchor: str

    @property
    def key(self) -> str:
        return f"{self.name}_key"

    @property
    def flag(self) -> str:
        return f"has_{self.name}"

    @property
    def foreign_key(self) -> str:
        return f"{self.name}_id"


PET_ATTRIBUTES = {
    "pet_type": "customer_pet_type",
    "pet_name": "customer_pet_name",
    "pet_breed": "customer_pet_breed",
    "pet_category": "pet_category",
}

ENTITIES = {
    e.name: e
    for e in (
        Entity(
            "customer",
            {
                "first_name": "customer_first_name",
                "last_name": "customer_last_name",
                "age": "customer_age",
                "email": "customer_email",
                "country": "customer_country",
                "postal_code": "customer_postal_code",
                **PET_ATTRIBUTES,
            },
            anchor="email",
        ),
        Entity(
            "seller",
            {
                "first_name": "seller_first_name",
                "last_name": "seller_last_name",
                "email": "seller_email",
                "country": "seller_country",
                "postal_code": "seller_postal_code",
            },
            anchor="email",
        ),
        Entity(
            "product",
            {
                "name": "product_name",
                "category": "product_category",
                "price": "product_price",
                "weight": "product_weight",
                "color": "product_color",
                "size": "product_size",
                "brand": "product_brand",
                "material": "product_material",
                "description": "product_description",
                "rating": "product_rating",
                "reviews": "product_reviews",
                "release_date": "product_release_date",
                "expiry_date": "product_expiry_date",
            },
            anchor="name",
        ),
        Entity(
            "store",
            {
                "name": "store_name",
                "location": "store_location",
                "city": "store_city",
                "state": "store_state",
                "country": "store_country",
                "phone": "store_phone",
                "email": "store_email",
            },
            anchor="email",
        ),
        Entity(
            "supplier",
            {
                "name": "supplier_name",
                "contact": "supplier_contact",
                "email": "supplier_email",
                "phone": "supplier_phone",
                "address": "supplier_address",
                "city": "supplier_city",
                "country": "supplier_country",
            },
            anchor="email",
        ),
    )
}

# Lookup table -> the entity attributes whose distinct values it lists.
LOOKUPS = {
    "dim_countries": (
        ("customer", "country"),
        ("seller", "country"),
        ("store", "country"),
        ("supplier", "country"),
    ),
    "dim_cities": (("store", "city"), ("supplier", "city")),
    "dim_pet_types": (("customer", "pet_type"),),
    "dim_pet_breeds": (("customer", "pet_breed"),),
    "dim_pet_categories": (("customer", "pet_category"),),
    "dim_product_categories": (("product", "category"),),
    "dim_product_colors": (("product", "color"),),
    "dim_product_sizes": (("product", "size"),),
    "dim_product_brands": (("product", "brand"),),
    "dim_product_materials": (("product", "material"),),
}

# Entity dimension -> its entity and the attributes stored as lookup ids.
ENTITY_DIMS = {
    "dim_customers": ("customer", {"country_id": "country"}),
    "dim_sellers": ("seller", {"country_id": "country"}),
    "dim_products": (
        "product",
        {
            "category_id": "category",
            "color_id": "color",
            "size_id": "size",
            "brand_id": "brand",
            "material_id": "material",
            "release_date_id": "release_date",
            "expiry_date_id": "expiry_date",
        },
    ),
    "dim_stores": ("store", {"city_id": "city", "country_id": "country"}),
    "dim_suppliers": ("supplier", {"city_id": "city", "country_id": "country"}),
}

# Entity -> its dimension.
DIMENSION_OF = {entity: table for table, (entity, _) in ENTITY_DIMS.items()}

# Foreign key -> referenced table, per referencing table.
FOREIGN_KEYS = {
    "fact_sales": {
        "customer_id": "dim_customers",
        "seller_id": "dim_sellers",
        "product_id": "dim_products",
        "date_id": "dim_dates",
        "store_id": "dim_stores",
        "supplier_id": "dim_suppliers",
    },
    "dim_pets": {
        "type_id": "dim_pet_types",
        "breed_id": "dim_pet_breeds",
        "category_id": "dim_pet_categories",
    },
    "dim_customers": {"country_id": "dim_countries", "pet_id": "dim_pets"},
    "dim_sellers": {"country_id": "dim_countries"},
    "dim_products": {
        "category_id": "dim_product_categories",
        "color_id": "dim_product_colors",
        "size_id": "dim_product_sizes",
        "brand_id": "dim_product_brands",
        "material_id": "dim_product_materials",
        "release_date_id": "dim_dates",
        "expiry_date_id": "dim_dates",
    },
    "dim_stores": {"city_id": "dim_cities", "country_id": "dim_countries"},
    "dim_suppliers": {"city_id": "dim_cities", "country_id": "dim_countries"},
}

DIMENSIONS = (
    "dim_countries",
    "dim_cities",
    "dim_dates",
    "dim_product_categories",
    "dim_product_colors",
    "dim_product_sizes",
    "dim_product_brands",
    "dim_product_materials",
    "dim_pet_types",
    "dim_pet_breeds",
    "dim_pet_categories",
    "dim_pets",
    "dim_customers",
    "dim_sellers",
    "dim_products",
    "dim_stores",
    "dim_suppliers",
)
WAREHOUSE_TABLES = (*DIMENSIONS, "fact_sales")

# Mart -> the order its rows are stored in.
MART_SORT_KEYS = {
    "sales_by_product": ("category", "product_id"),
    "sales_by_customer": ("country", "customer_id"),
    "sales_by_time": ("year", "month"),
    "sales_by_store": ("country", "city", "store_id"),
    "sales_by_supplier": ("country", "supplier_id"),
    "product_quality": ("rating", "product_id"),
}

# Mart -> the columns that identify a row.
MART_ROW_KEYS = {
    "sales_by_product": ("product_id",),
    "sales_by_customer": ("customer_id",),
    "sales_by_time": ("year", "month"),
    "sales_by_store": ("store_id",),
    "sales_by_supplier": ("supplier_id",),
    "product_quality": ("product_id",),
}

# Fixed values (names): mart -> schema of the stored table.
MART_SCHEMAS = {
    "sales_by_product": _struct(
        """
        product_id bigint
        product_name string
        category string
        total_revenue money
        total_quantity bigint
        avg_rating double
        review_count bigint
        reviews_over_sales bigint
        """
    ),
    "sales_by_customer": _struct(
        """
        customer_id bigint
        customer_name string
        country string
        total_spent money
        avg_order_value double
        """
    ),
    "sales_by_time": _struct(
        """
        year int
        month int
        total_revenue money
        total_orders bigint
        avg_order_size double
        """
    ),
    "sales_by_store": _struct(
        """
        store_id bigint
        store_name string
        location string
        city string
        country string
        total_revenue money
        avg_order_value double
        """
    ),
    "sales_by_supplier": _struct(
        """
        supplier_id bigint
        supplier_name string
        country string
        total_revenue money
        avg_price double
        avg_quantity double
        """
    ),
    "product_quality": _struct(
        """
        product_id bigint
        product_name string
        rating double
        review_count bigint
        reviews_over_sales bigint
        total_quantity bigint
        """
    ),
}
