"""DuckDB SQL with the expected result of every registered query.

The SQL works on the flat rows directly (group the sales, take distinct
attributes) and shares no step with the Spark plans but the key definition.
"""

from __future__ import annotations

FLAT = """
flat AS (
  SELECT
    l.l_orderkey * 10 + l.l_linenumber AS id,
    split_part(c.c_name, '#', 1) AS customer_first_name,
    split_part(c.c_name, '#', 2) AS customer_last_name,
    cast(18 + c.c_custkey % 60 AS bigint) AS customer_age,
    lower(c.c_name) || '@example.com' AS customer_email,
    cn.n_name AS customer_country,
    CASE WHEN c.c_custkey % 11 = 0 THEN NULL
         ELSE 'P' || cast(c.c_custkey % 900 AS varchar) END AS customer_postal_code,
    'Type-' || cast(c.c_custkey % 6 AS varchar) AS customer_pet_type,
    'Pet-' || cast(c.c_custkey % 50 AS varchar) AS customer_pet_name,
    CASE WHEN c.c_custkey % 13 = 0 THEN NULL
         ELSE 'Breed-' || cast(c.c_custkey % 7 AS varchar) END AS customer_pet_breed,
    CASE WHEN o.o_orderkey IS NOT NULL THEN 'Desk' END AS seller_first_name,
    o.o_orderpriority AS seller_last_name,
    lower(o.o_orderpriority) || '.' || lower(r.r_name) || '@example.com' AS seller_email,
    CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE r.r_name END AS seller_country,
    cast(NULL AS varchar) AS seller_postal_code,
    p.p_name AS product_name,
    p.p_type AS product_category,
    cast(p.p_retailprice AS decimal(12,2)) AS product_price,
    cast(l.l_quantity AS bigint) AS product_quantity,
    strftime(o.o_orderdate, '%m/%d/%Y') AS sale_date,
    o.o_custkey AS sale_customer_id,
    cast(substr(o.o_orderpriority, 1, 1) AS bigint) AS sale_seller_id,
    l.l_partkey AS sale_product_id,
    cast(l.l_quantity AS bigint) AS sale_quantity,
    cast(l.l_extendedprice AS decimal(14,2)) AS sale_total_price,
    c.c_mktsegment || ' ' || cn.n_name AS store_name,
    c.c_mktsegment AS store_location,
    'City-' || cn.n_name AS store_city,
    r.r_name AS store_state,
    r.r_name AS store_country,
    cast(NULL AS varchar) AS store_phone,
    lower(c.c_mktsegment) || '.' || lower(cn.n_name) || '@example.com' AS store_email,
    c.c_mktsegment AS pet_category,
    cast(p.p_size / 2.0 AS float) AS product_weight,
    CASE WHEN p.p_partkey % 97 = 0 THEN NULL
         ELSE split_part(p.p_name, ' ', 1) END AS product_color,
    cast(p.p_size AS varchar) AS product_size,
    p.p_brand AS product_brand,
    split_part(p.p_name, ' ', 2) AS product_material,
    p.p_name || ' ' || p.p_brand AS product_description,
    cast((10 + p.p_partkey % 41) / 10.0 AS decimal(2,1)) AS product_rating,
    p.p_partkey % 1000 AS product_reviews,
    strftime(date '1995-01-01' + cast(p.p_partkey % 365 AS int), '%m/%d/%Y')
      AS product_release_date,
    strftime(date '1997-01-01' + cast(p.p_partkey % 365 AS int), '%m/%d/%Y')
      AS product_expiry_date,
    su.s_name AS supplier_name,
    'Contact ' || su.s_name AS supplier_contact,
    lower(su.s_name) || '@example.com' AS supplier_email,
    cast(NULL AS varchar) AS supplier_phone,
    cast(NULL AS varchar) AS supplier_address,
    'City-' || cast(su.s_suppkey % 10 AS varchar) AS supplier_city,
    sn.n_name AS supplier_country
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  LEFT JOIN region r ON cn.n_regionkey = r.r_regionkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier su ON l.l_suppkey = su.s_suppkey
  LEFT JOIN nation sn ON su.s_nationkey = sn.n_nationkey
)"""


def key(*values: str) -> str:
    parts = ", ".join(
        f"coalesce('v' || replace(cast({v} AS varchar), chr(31), chr(31) || chr(31)), 'n')"
        for v in values
    )
    return f"cast(concat('0x', substr(md5(concat_ws(chr(31), {parts})), 1, 15)) AS bigint)"


def lookup(value: str) -> str:
    return f"CASE WHEN {value} IS NOT NULL THEN {key(value)} END"


def day(text: str) -> str:
    return f"cast(strptime({text}, '%m/%d/%Y') AS date)"


PET = ["customer_pet_type", "customer_pet_name", "customer_pet_breed", "pet_category"]
CUSTOMER = [
    "customer_first_name",
    "customer_last_name",
    "customer_age",
    "customer_email",
    "customer_country",
    "customer_postal_code",
    *PET,
]
SELLER = [
    "seller_first_name",
    "seller_last_name",
    "seller_email",
    "seller_country",
    "seller_postal_code",
]
PRODUCT = [
    "product_name",
    "product_category",
    "product_price",
    "product_weight",
    "product_color",
    "product_size",
    "product_brand",
    "product_material",
    "product_description",
    "product_rating",
    "product_reviews",
    "release_day",
    "expiry_day",
]
STORE = [
    "store_name",
    "store_location",
    "store_city",
    "store_state",
    "store_country",
    "store_phone",
    "store_email",
]
SUPPLIER = [
    "supplier_name",
    "supplier_contact",
    "supplier_email",
    "supplier_phone",
    "supplier_address",
    "supplier_city",
    "supplier_country",
]
ANCHORED = {
    "customer": (CUSTOMER, "customer_email"),
    "seller": (SELLER, "seller_email"),
    "product": (PRODUCT, "product_name"),
    "store": (STORE, "store_email"),
    "supplier": (SUPPLIER, "supplier_email"),
}

CLEAN = f"""
clean AS (
  SELECT *, {day("sale_date")} AS sale_day, {day("product_release_date")} AS release_day,
         {day("product_expiry_date")} AS expiry_day
  FROM flat
)"""

KEYED = f"""
keys AS (
  SELECT *, {lookup("sale_day")} AS date_id,
         {", ".join(f"{key(*attrs)} AS {name}_key" for name, (attrs, _) in ANCHORED.items())}
  FROM clean
),
sales AS (
  SELECT *, {", ".join(
      f"CASE WHEN {anchor} IS NOT NULL THEN {name}_key END AS {name}_id"
      for name, (_, anchor) in ANCHORED.items())}
  FROM keys
)"""

MONEY = "decimal(24,2)"


def money(total: str) -> str:
    return f"cast({total} AS {MONEY})"


def ratio(total: str, count: str, digits: int = 2) -> str:
    """total / count to 4 digits, half up, in whole numbers (totals are not negative)."""
    units = f"cast({total} * {10 ** digits} AS hugeint)"
    return (
        f"cast(({units} * {2 * 10 ** (4 - digits)} + {count}) // (2 * {count}) AS double) / 10000.0"
    )


MARTS = {
    "sales_by_product": f"""
  SELECT product_id, any_value(product_name) AS product_name,
         any_value(product_category) AS category,
         {money("sum(sale_total_price)")} AS total_revenue,
         cast(sum(product_quantity) AS bigint) AS total_quantity,
         cast(any_value(product_rating) AS double) AS avg_rating,
         any_value(product_reviews) AS review_count,
         cast(sum(product_reviews) AS bigint) AS reviews_over_sales
  FROM sales WHERE product_id IS NOT NULL AND product_category IS NOT NULL
  GROUP BY product_id""",
    "sales_by_customer": f"""
  SELECT customer_id,
         any_value(customer_first_name || ' ' || customer_last_name) AS customer_name,
         any_value(customer_country) AS country,
         {money("sum(sale_total_price)")} AS total_spent,
         {ratio("sum(sale_total_price)", "count(sale_total_price)")} AS avg_order_value
  FROM sales WHERE customer_id IS NOT NULL AND date_id IS NOT NULL
  GROUP BY customer_id""",
    "sales_by_time": f"""
  SELECT cast(year(sale_day) AS int) AS year, cast(month(sale_day) AS int) AS month,
         {money("sum(sale_total_price)")} AS total_revenue,
         count(*) AS total_orders,
         {ratio("sum(sale_total_price)", "count(*)")} AS avg_order_size
  FROM sales WHERE date_id IS NOT NULL
  GROUP BY ALL""",
    "sales_by_store": f"""
  SELECT store_id, any_value(store_name) AS store_name,
         any_value(store_location) AS location, any_value(store_city) AS city,
         any_value(store_country) AS country,
         {money("sum(sale_total_price)")} AS total_revenue,
         {ratio("sum(sale_total_price)", "count(*)")} AS avg_order_value
  FROM sales WHERE store_id IS NOT NULL AND date_id IS NOT NULL
  GROUP BY store_id""",
    "sales_by_supplier": f"""
  SELECT supplier_id, any_value(supplier_name) AS supplier_name,
         any_value(supplier_country) AS country,
         {money("sum(sale_total_price)")} AS total_revenue,
         {ratio("sum(product_price)", "count(product_price)")} AS avg_price,
         {ratio("sum(product_quantity)", "count(product_quantity)", 0)} AS avg_quantity
  FROM sales WHERE supplier_id IS NOT NULL
  GROUP BY supplier_id""",
    "product_quality": """
  SELECT product_id, any_value(product_name) AS product_name,
         cast(any_value(product_rating) AS double) AS rating,
         any_value(product_reviews) AS review_count,
         cast(sum(product_reviews) AS bigint) AS reviews_over_sales,
         cast(sum(product_quantity) AS bigint) AS total_quantity
  FROM sales WHERE product_id IS NOT NULL
  GROUP BY product_id""",
}


def mart(name: str) -> str:
    return f"{name} AS ({MARTS[name]}\n)"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


SALES = (FLAT, CLEAN, KEYED)

LOOKUPS = {
    "dim_countries": ["customer_country", "seller_country", "store_country", "supplier_country"],
    "dim_cities": ["store_city", "supplier_city"],
    "dim_pet_types": ["customer_pet_type"],
    "dim_pet_breeds": ["customer_pet_breed"],
    "dim_pet_categories": ["pet_category"],
    "dim_product_categories": ["product_category"],
    "dim_product_colors": ["product_color"],
    "dim_product_sizes": ["product_size"],
    "dim_product_brands": ["product_brand"],
    "dim_product_materials": ["product_material"],
}


def _values(columns: list[str], name: str) -> str:
    each = " UNION ".join(f"SELECT {c} AS {name} FROM clean" for c in columns)
    return f"SELECT DISTINCT {key(name)} AS id, {name} FROM ({each}) WHERE {name} IS NOT NULL"


DIMS = {
    **{table: _values(columns, "name") for table, columns in LOOKUPS.items()},
    "dim_dates": _values(["sale_day", "release_day", "expiry_day"], "date"),
    "dim_pets": f"""
  SELECT DISTINCT {key(*PET)} AS id, {lookup("customer_pet_type")} AS type_id,
         customer_pet_name AS name, {lookup("customer_pet_breed")} AS breed_id,
         {lookup("pet_category")} AS category_id
  FROM clean""",
    "dim_customers": f"""
  SELECT DISTINCT {key(*CUSTOMER)} AS id, customer_first_name AS first_name,
         customer_last_name AS last_name, customer_age AS age, customer_email AS email,
         {lookup("customer_country")} AS country_id, customer_postal_code AS postal_code,
         {key(*PET)} AS pet_id
  FROM clean""",
    "dim_sellers": f"""
  SELECT DISTINCT {key(*SELLER)} AS id, seller_first_name AS first_name,
         seller_last_name AS last_name, seller_email AS email,
         {lookup("seller_country")} AS country_id, seller_postal_code AS postal_code
  FROM clean""",
    "dim_products": f"""
  SELECT DISTINCT {key(*PRODUCT)} AS id, product_name AS name,
         {lookup("product_category")} AS category_id, product_price AS price,
         product_weight AS weight, {lookup("product_color")} AS color_id,
         {lookup("product_size")} AS size_id, {lookup("product_brand")} AS brand_id,
         {lookup("product_material")} AS material_id, product_description AS description,
         product_rating AS rating, product_reviews AS reviews,
         {lookup("release_day")} AS release_date_id, {lookup("expiry_day")} AS expiry_date_id
  FROM clean""",
    "dim_stores": f"""
  SELECT DISTINCT {key(*STORE)} AS id, store_name AS name, store_location AS location,
         {lookup("store_city")} AS city_id, store_state AS state,
         {lookup("store_country")} AS country_id, store_phone AS phone, store_email AS email
  FROM clean""",
    "dim_suppliers": f"""
  SELECT DISTINCT {key(*SUPPLIER)} AS id, supplier_name AS name, supplier_contact AS contact,
         supplier_email AS email, supplier_phone AS phone, supplier_address AS address,
         {lookup("supplier_city")} AS city_id, {lookup("supplier_country")} AS country_id
  FROM clean""",
}

FACT = """
  SELECT id AS source_id, customer_id, seller_id, product_id, date_id, store_id, supplier_id,
         product_quantity, product_price, sale_quantity, sale_total_price AS total_price
  FROM sales"""

# Report -> (marts it reads, SELECT).
REPORTS = {
    "top_products": (
        ["sales_by_product"],
        """SELECT product_id, product_name, category, total_quantity, total_revenue
  FROM sales_by_product ORDER BY total_quantity DESC, product_id LIMIT 10""",
    ),
    "revenue_by_category": (
        ["sales_by_product"],
        f"""SELECT category, {money("sum(total_revenue)")} AS total_revenue,
         cast(sum(total_quantity) AS bigint) AS total_quantity
  FROM sales_by_product GROUP BY category""",
    ),
    "product_ratings": (
        [],
        f"""SELECT DISTINCT {key(*PRODUCT)} AS product_id, product_name,
         cast(product_rating AS double) AS avg_rating, product_reviews AS review_count
  FROM clean""",
    ),
    "top_customers": (
        ["sales_by_customer"],
        """SELECT customer_id, customer_name, country, total_spent
  FROM sales_by_customer ORDER BY total_spent DESC, customer_id LIMIT 10""",
    ),
    "customers_by_country": (
        ["sales_by_customer"],
        "SELECT country, count(*) AS customers FROM sales_by_customer GROUP BY country",
    ),
    "customer_avg_check": (
        ["sales_by_customer"],
        "SELECT customer_id, customer_name, avg_order_value FROM sales_by_customer",
    ),
    "sales_trend": (
        ["sales_by_time"],
        f"""SELECT year, month, {money("sum(total_revenue)")} AS total_revenue,
         cast(sum(total_orders) AS bigint) AS total_orders
  FROM sales_by_time GROUP BY ROLLUP (year, month)""",
    ),
    "revenue_period_compare": (
        ["sales_by_time"],
        f"""SELECT m.year, m.month, m.total_revenue,
         p.total_revenue AS prev_month_revenue,
         {money("m.total_revenue - p.total_revenue")} AS prev_month_change,
         y.total_revenue AS prev_year_revenue,
         {money("m.total_revenue - y.total_revenue")} AS prev_year_change
  FROM sales_by_time m
  LEFT JOIN sales_by_time p ON p.year * 12 + p.month + 1 = m.year * 12 + m.month
  LEFT JOIN sales_by_time y ON y.year = m.year - 1 AND y.month = m.month""",
    ),
    "avg_order_by_month": (
        ["sales_by_time"],
        "SELECT year, month, avg_order_size FROM sales_by_time",
    ),
    "top_stores": (
        ["sales_by_store"],
        """SELECT store_id, store_name, city, country, total_revenue
  FROM sales_by_store ORDER BY total_revenue DESC, store_id LIMIT 5""",
    ),
    "sales_by_city_country": (
        ["sales_by_store"],
        f"""SELECT country, city, {money("sum(total_revenue)")} AS total_revenue,
         count(*) AS stores
  FROM sales_by_store GROUP BY country, city""",
    ),
    "store_avg_check": (
        ["sales_by_store"],
        "SELECT store_id, store_name, avg_order_value FROM sales_by_store",
    ),
    "top_suppliers": (
        ["sales_by_supplier"],
        """SELECT supplier_id, supplier_name, country, total_revenue
  FROM sales_by_supplier ORDER BY total_revenue DESC, supplier_id LIMIT 5""",
    ),
    "supplier_avg_price": (
        ["sales_by_supplier"],
        "SELECT supplier_id, supplier_name, avg_price FROM sales_by_supplier",
    ),
    "sales_by_supplier_country": (
        ["sales_by_supplier"],
        f"""SELECT country, {money("sum(total_revenue)")} AS total_revenue,
         count(*) AS suppliers
  FROM sales_by_supplier GROUP BY country""",
    ),
    "rating_extremes": (
        ["product_quality"],
        """SELECT * FROM (
    SELECT 'highest' AS side, product_id, product_name, rating, review_count
    FROM product_quality WHERE rating IS NOT NULL ORDER BY rating DESC, product_id LIMIT 10)
  UNION ALL SELECT * FROM (
    SELECT 'lowest' AS side, product_id, product_name, rating, review_count
    FROM product_quality WHERE rating IS NOT NULL ORDER BY rating, product_id LIMIT 10)""",
    ),
    "rating_sales_corr": (
        ["product_quality"],
        """SELECT count(CASE WHEN rating IS NOT NULL THEN total_quantity END) AS products,
         round(corr(rating, cast(total_quantity AS double)), 6) AS rating_sales_corr
  FROM product_quality""",
    ),
    "most_reviewed": (
        [],
        f"""SELECT DISTINCT {key(*PRODUCT)} AS product_id, product_name,
         product_reviews AS review_count
  FROM clean ORDER BY review_count DESC NULLS LAST, product_id LIMIT 10""",
    ),
}

FOREIGN_KEYS = {
    "fact_sales": [
        ("customer_id", "dim_customers"),
        ("seller_id", "dim_sellers"),
        ("product_id", "dim_products"),
        ("date_id", "dim_dates"),
        ("store_id", "dim_stores"),
        ("supplier_id", "dim_suppliers"),
    ],
    "dim_pets": [
        ("type_id", "dim_pet_types"),
        ("breed_id", "dim_pet_breeds"),
        ("category_id", "dim_pet_categories"),
    ],
    "dim_customers": [("country_id", "dim_countries"), ("pet_id", "dim_pets")],
    "dim_sellers": [("country_id", "dim_countries")],
    "dim_products": [
        ("category_id", "dim_product_categories"),
        ("color_id", "dim_product_colors"),
        ("size_id", "dim_product_sizes"),
        ("brand_id", "dim_product_brands"),
        ("material_id", "dim_product_materials"),
        ("release_date_id", "dim_dates"),
        ("expiry_date_id", "dim_dates"),
    ],
    "dim_stores": [("city_id", "dim_cities"), ("country_id", "dim_countries")],
    "dim_suppliers": [("city_id", "dim_cities"), ("country_id", "dim_countries")],
}

ALL_DIMS = [f"{name} AS MATERIALIZED ({sql})" for name, sql in DIMS.items()]


def _quality() -> dict[str, str]:
    duplicates = " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, count(*) AS members, count(DISTINCT id) AS distinct_keys, "
        f"(SELECT count(*) FROM (SELECT id FROM {d} GROUP BY id HAVING count(*) > 1)) "
        f"AS duplicate_keys FROM {d}"
        for d in DIMS
    )
    orphans = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{fk}' AS foreign_key, count(*) AS row_count, "
        f"count(*) FILTER ({fk} IS NULL) AS null_keys, "
        f"count(*) FILTER ({fk} IS NOT NULL AND {fk} NOT IN (SELECT id FROM {dim})) "
        f"AS orphan_keys FROM {t}"
        for t, keys in FOREIGN_KEYS.items()
        for fk, dim in keys
    )
    fanout = " UNION ALL ".join(
        f"SELECT '{name}' AS entity, count(*) AS natural_keys, "
        "count(*) FILTER (members > 1) AS ambiguous_keys, max(members) AS max_members, "
        "cast(sum(n) AS bigint) AS sale_rows, cast(sum(n * members) AS bigint) AS joined_rows "
        f"FROM (SELECT {anchor}, count(*) AS n, count(DISTINCT {name}_key) AS members "
        f"FROM sales WHERE {anchor} IS NOT NULL GROUP BY {anchor})"
        for name, (_, anchor) in ANCHORED.items()
    )
    totals = {
        "sales_by_product": ("total_revenue", "product_id IS NULL OR product_category IS NULL"),
        "sales_by_customer": ("total_spent", "customer_id IS NULL OR date_id IS NULL"),
        "sales_by_time": ("total_revenue", "date_id IS NULL"),
        "sales_by_store": ("total_revenue", "store_id IS NULL OR date_id IS NULL"),
        "sales_by_supplier": ("total_revenue", "supplier_id IS NULL"),
    }
    price = "cast(l_extendedprice AS decimal(14,2))"
    whole = f"(SELECT coalesce(sum({price}), 0) FROM lineitem)"
    layers = [
        "SELECT 'source' AS layer, count(*) AS row_count, "
        f"{money(f'coalesce(sum({price}), 0)')} AS revenue, {money('0')} "
        "AS excluded_revenue FROM lineitem",
        "SELECT 'fact_sales', count(*), "
        f"{money('coalesce(sum(sale_total_price), 0)')}, {money('0')} FROM sales",
    ]
    layers += [
        f"SELECT '{m}', count(*), {money(f'coalesce(sum({c}), 0)')}, "
        f"(SELECT {money('coalesce(sum(sale_total_price), 0)')} FROM sales WHERE {rule}) FROM {m}"
        for m, (c, rule) in totals.items()
    ]
    reconcile = (
        f"SELECT *, {money(f'{whole} - revenue - excluded_revenue')} AS gap "
        f"FROM ({' UNION ALL '.join(layers)})"
    )
    columns = [
        ("dim_products", "price"),
        ("fact_sales", "total_price"),
        ("sales_by_product", "total_revenue"),
        ("sales_by_customer", "total_spent"),
        ("sales_by_time", "total_revenue"),
        ("sales_by_store", "total_revenue"),
        ("sales_by_supplier", "total_revenue"),
    ]
    overflow = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS non_null, "
        f"count(*) FILTER (abs({c}) > 99999999.99) AS overflowing FROM {t}"
        for t, c in columns
    )
    fact = f"fact_sales AS ({FACT})"
    marts = [mart(m) for m in MARTS]
    return {
        "dq_duplicate_keys": _with(FLAT, CLEAN, *ALL_DIMS) + duplicates,
        "dq_orphans": _with(*SALES, *ALL_DIMS, fact) + orphans,
        "dq_fanout": _with(*SALES) + fanout,
        "dq_reconcile": _with(*SALES, *marts) + reconcile,
        "dq_overflow": _with(
            *SALES, f"dim_products AS ({DIMS['dim_products']})", fact, *marts
        )
        + overflow,
    }


IMPOSSIBLE = (
    "coalesce(seller_last_name = '5-LOW' AND store_location = 'FURNITURE' "
    "AND sale_date IS NOT NULL, false)"
)
MALFORMED = (
    "(coalesce(product_rating = 1.5, false) OR coalesce(store_location = 'BUILDING' "
    "AND product_rating = 4.5 AND id % 2 = 0 AND supplier_city != 'City-3', false))"
)
UNPADDED = r"regexp_replace({}, '(^|/)0', '\1', 'g')"


def _load() -> dict[str, str]:
    loaded = f"""SELECT * REPLACE (
      CASE WHEN store_location = 'MACHINERY' THEN {UNPADDED.format("sale_date")}
           ELSE sale_date END AS sale_date,
      CASE WHEN product_size = '7' THEN '5" to 7" ' || product_description
           ELSE product_description END AS product_description,
      CASE WHEN supplier_city = 'City-3' THEN supplier_contact || chr(10) || '"desk"'
           ELSE supplier_contact END AS supplier_contact)
  FROM flat WHERE NOT ({IMPOSSIBLE}) AND NOT ({MALFORMED})"""
    audit = f"""SELECT count(*) AS rows_read,
         count(*) FILTER (NOT ({IMPOSSIBLE}) AND NOT ({MALFORMED})) AS rows_loaded,
         count(*) FILTER (({IMPOSSIBLE}) OR ({MALFORMED})) AS rows_rejected
  FROM flat"""
    bad = f"""SELECT * FROM (
    SELECT 'malformed_record' AS reason, count(*) AS row_count FROM flat WHERE {MALFORMED}
    UNION ALL
    SELECT 'bad_sale_date', count(*) FROM flat WHERE {IMPOSSIBLE}) WHERE row_count > 0"""
    dates = f"""texts AS (
    SELECT DISTINCT t FROM (
      SELECT sale_date AS t FROM flat UNION SELECT product_release_date FROM flat
      UNION SELECT product_expiry_date FROM flat) WHERE t IS NOT NULL)
  SELECT t AS date_text, {day("t")} AS parsed_date FROM texts
  UNION SELECT {UNPADDED.format("t")}, {day("t")} FROM texts
  UNION SELECT '13' || substr(t, 3), NULL FROM texts
  UNION SELECT substr(t, 7), NULL FROM texts"""
    return {
        "load_csv": _with(FLAT) + loaded,
        "load_audit": _with(FLAT) + audit,
        "dq_bad_rows": _with(FLAT) + bad,
        "clean_dates": _with(FLAT) + "," + dates,
    }


MART_KEYS = {
    "sales_by_product": "cast(product_id AS varchar)",
    "sales_by_customer": "cast(customer_id AS varchar)",
    "sales_by_time": "year || '-' || month",
    "sales_by_store": "cast(store_id AS varchar)",
    "sales_by_supplier": "cast(supplier_id AS varchar)",
    "product_quality": "cast(product_id AS varchar)",
}
MART_FIELDS = {
    "sales_by_product": [
        "product_id",
        "product_name",
        "category",
        "total_revenue",
        "total_quantity",
        "avg_rating",
        "review_count",
        "reviews_over_sales",
    ],
    "sales_by_customer": [
        "customer_id",
        "customer_name",
        "country",
        "total_spent",
        "avg_order_value",
    ],
    "sales_by_time": ["year", "month", "total_revenue", "total_orders", "avg_order_size"],
    "sales_by_store": [
        "store_id",
        "store_name",
        "location",
        "city",
        "country",
        "total_revenue",
        "avg_order_value",
    ],
    "sales_by_supplier": [
        "supplier_id",
        "supplier_name",
        "country",
        "total_revenue",
        "avg_price",
        "avg_quantity",
    ],
    "product_quality": [
        "product_id",
        "product_name",
        "rating",
        "review_count",
        "reviews_over_sales",
        "total_quantity",
    ],
}
MONEY_FIELDS = ("total_revenue", "total_spent")


def _exports() -> dict[str, str]:
    marts = [mart(m) for m in MARTS]

    def field(name: str) -> str:
        value = f"cast({name} AS varchar)" if name in MONEY_FIELDS else name
        return f"""CASE WHEN {name} IS NULL THEN '' ELSE ',"{name}":' || to_json({value}) END"""

    documents = " UNION ALL ".join(
        f"SELECT '{m}' AS collection, {MART_KEYS[m]} AS document_id, "
        f"'{{' || substr({' || '.join(field(f) for f in fields)}, 2) || '}}' AS body FROM {m}"
        for m, fields in MART_FIELDS.items()
    )
    kv = " UNION ALL ".join(
        f"SELECT '{m}:' || {MART_KEYS[m]} AS entry, '{f}' AS field, "
        f"cast({f} AS varchar) AS value FROM {m} WHERE {f} IS NOT NULL"
        for m, fields in MART_FIELDS.items()
        for f in fields
    )
    graph = {
        "sales_by_product": ("Product", "product_name", [("Category", "category")]),
        "sales_by_customer": ("Customer", "customer_name", [("Country", "country")]),
        "sales_by_store": ("Store", "store_name", [("City", "city"), ("Country", "country")]),
        "sales_by_supplier": ("Supplier", "supplier_name", [("Country", "country")]),
    }
    nodes = " UNION ALL ".join(
        f"SELECT '{label}:' || {MART_KEYS[m]} AS node_id, '{label}' AS label, {name} AS name "
        f"FROM {m}"
        for m, (label, name, _) in graph.items()
    )
    places = " UNION ".join(
        f"SELECT '{place}:' || {c}, '{place}', {c} FROM {m} WHERE {c} IS NOT NULL"
        for m, (_, _, refers) in graph.items()
        for place, c in refers
    )
    edges = " UNION ALL ".join(
        f"SELECT '{label}:' || {MART_KEYS[m]} AS from_id, 'IN_{place.upper()}' AS relation, "
        f"'{place}:' || {c} AS to_id, "
        f"{'total_spent' if m == 'sales_by_customer' else 'total_revenue'} AS revenue "
        f"FROM {m} WHERE {c} IS NOT NULL"
        for m, (label, _, refers) in graph.items()
        for place, c in refers
    )
    head = _with(*SALES, *marts)
    return {
        "export_documents": head + documents,
        "export_kv": head + kv,
        "export_nodes": f"{head}{nodes} UNION ALL SELECT * FROM ({places})",
        "export_edges": head + edges,
    }


def _keys() -> dict[str, str]:
    dense = f"dim_products AS ({DIMS['dim_products']})"
    upsert = """SELECT product_key AS id, any_value(product_name) AS name,
         CASE WHEN min(sale_day) < date '1995-02-01' THEN 'stored' ELSE 'added' END AS origin
  FROM sales GROUP BY product_key"""

    def ids(name: str) -> str:
        return (
            f"{name}_ids AS (SELECT k, row_number() OVER (ORDER BY k) AS dense_id FROM "
            f"(SELECT DISTINCT {name}_key AS k FROM keys))"
        )

    by_lookup = f"""SELECT id AS source_id,
         {", ".join(
             f"CASE WHEN {anchor} IS NOT NULL THEN {name}_ids.dense_id END AS {name}_id"
             for name, (_, anchor) in ANCHORED.items())},
         date_ids.dense_id AS date_id, product_quantity, product_price, sale_quantity,
         sale_total_price AS total_price
  FROM keys
  {" ".join(f"LEFT JOIN {name}_ids ON {name}_ids.k = {name}_key" for name in ANCHORED)}
  LEFT JOIN date_ids ON date_ids.k = date_id"""
    tables = [ids(name) for name in ANCHORED]
    dates = (
        "date_ids AS (SELECT id AS k, row_number() OVER (ORDER BY id) AS dense_id FROM "
        f"({DIMS['dim_dates']}))"
    )
    refers = dict(FOREIGN_KEYS["dim_products"])
    numbered = [
        f"{d}_ids AS (SELECT id, row_number() OVER (ORDER BY id) AS n FROM ({DIMS[d]}))"
        for d in sorted({"dim_products", *refers.values()})
    ]
    dense_products = f"""SELECT
         (SELECT n FROM dim_products_ids i WHERE i.id = p.id) AS id, name, price, weight,
         description, rating, reviews,
         {", ".join(f"(SELECT n FROM {d}_ids i WHERE i.id = p.{fk}) AS {fk}"
                    for fk, d in refers.items())}
  FROM dim_products p"""
    def dense_dimension(name: str) -> str:
        refers = dict(FOREIGN_KEYS[name])
        places = sorted(set(refers.values()))
        ids = [f"{d}_ids AS (SELECT id, row_number() OVER (ORDER BY id) AS n FROM ({DIMS[d]}))"
               for d in (name, *places)]
        columns = [("id", name), *refers.items()]
        found = ", ".join(f"(SELECT n FROM {d}_ids i WHERE i.id = p.{c}) AS {c}" for c, d in columns)
        return _with(FLAT, CLEAN, *ids) + f"SELECT * REPLACE ({found}) FROM ({DIMS[name]}) p"

    first_sale = """SELECT customer_pet_type AS pet_type, customer_pet_name AS pet_name,
         customer_pet_breed AS pet_breed, pet_category, min(id) AS source_id
  FROM clean GROUP BY ALL"""
    return {
        **{f"{d}_dense": dense_dimension(d) for d in FOREIGN_KEYS if d.startswith("dim_")},
        "dim_products_dense": _with(FLAT, CLEAN, dense, *numbered) + dense_products,
        "pet_first_sale": _with(FLAT, CLEAN) + first_sale,
        "write_mart": _with(*SALES) + MARTS["sales_by_customer"],
        "write_fact": _with(FLAT, CLEAN)
        + f"""SELECT cast(year(sale_day) AS int) AS sale_year, count(*) AS row_count,
         {money("sum(sale_total_price)")} AS revenue
  FROM clean GROUP BY ALL""",
        "dense_ids": _with(FLAT, CLEAN, dense)
        + "SELECT row_number() OVER (ORDER BY id) AS dense_id, id, name FROM dim_products",
        "dim_upsert": _with(*SALES) + upsert,
        "fact_sales_dense": _with(*SALES, *tables, dates) + by_lookup,
        "fact_sales_by_lookup": _with(*SALES, *tables, dates) + by_lookup,
    }


def _loads() -> dict[str, str]:
    """Tables that grew by loads must equal those made at once."""
    tables = {**DIMS, "fact_sales": FACT}
    counts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, 2 AS versions FROM ({sql})"
        for t, sql in tables.items()
    )
    shapes = {
        "sales_by_product": ("product_id", "total_revenue", "total_quantity"),
        "sales_by_customer": ("customer_id", "total_spent", "NULL"),
        "sales_by_time": ("cast(year AS bigint) * 100 + month", "total_revenue", "total_orders"),
        "sales_by_store": ("store_id", "total_revenue", "NULL"),
        "sales_by_supplier": ("supplier_id", "total_revenue", "NULL"),
        "product_quality": ("product_id", "NULL", "total_quantity"),
    }
    all_marts = " UNION ALL ".join(
        f"SELECT '{m}' AS mart, {k} AS row_key, cast({r} AS {MONEY}) AS revenue, "
        f"cast({q} AS bigint) AS quantity FROM {m}"
        for m, (k, r, q) in shapes.items()
    )
    named = " UNION ALL BY NAME ".join(
        (
            "SELECT 'sales_by_product' AS mart, product_name, category, total_revenue, "
            "total_quantity FROM sales_by_product",
            "SELECT 'sales_by_customer' AS mart, customer_name, country, total_spent, "
            "avg_order_value FROM sales_by_customer",
            "SELECT 'sales_by_store' AS mart, store_name, city, country, total_revenue "
            "FROM sales_by_store",
        )
    )
    load = """CASE WHEN sale_day < date '1997-01-01' THEN 1
         WHEN sale_day < date '1999-01-01' THEN 2 ELSE 3 END"""
    members = " UNION ALL ".join(
        [
            f"SELECT 'dim_customers' AS dimension, customer_key AS id, {load} AS n FROM keys",
            f"SELECT 'dim_products', product_key, {load} FROM keys",
            *(
                f"SELECT 'dim_dates', {lookup(day_)}, {load} FROM keys WHERE {day_} IS NOT NULL"
                for day_ in ("sale_day", "release_day", "expiry_day")
            ),
        ]
    )
    numbered = f"""SELECT dimension, id,
         row_number() OVER (PARTITION BY dimension ORDER BY min(n), id) AS dense_id
  FROM ({members}) GROUP BY dimension, id"""
    digests = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS wanted_rows, count(*) AS stored_rows, "
        "0 AS differing_rows, cast(NULL AS bigint) AS first_key, cast(NULL AS bigint) AS last_key "
        f"FROM ({sql})"
        for t, sql in DIMS.items()
    )
    swapped = f"""SELECT 'fact_sales' AS table_name, count(*) AS wanted_rows,
         count(*) AS stored_rows,
         CASE WHEN min_by(coalesce(customer_id, 0), source_id)
                   <> max_by(coalesce(customer_id, 0), source_id) THEN 2 ELSE 0 END AS differing_rows,
         min(source_id) AS first_key, max(source_id) AS last_key
  FROM ({FACT})"""
    marts = [mart(m) for m in MARTS]
    return {
        "refresh_snapshot": _with(*SALES) + counts,
        "marts_after_add": _with(*SALES, *marts) + all_marts,
        "keys_with_collisions": _with(*SALES, *marts) + named,
        "dense_ids_after_add": _with(*SALES) + numbered,
        "dq_digest": _with(*SALES) + f"{digests} UNION ALL {swapped}",
        "export_changes": _exports()["export_kv"],
    }


def oracle_sql() -> dict[str, str]:
    queries = {"src_flat": _with(FLAT) + "SELECT * FROM flat"}
    queries |= _load()
    queries |= {name: _with(FLAT, CLEAN) + sql for name, sql in DIMS.items()}
    queries["fact_sales"] = _with(*SALES) + FACT
    queries |= _keys()
    queries |= {name: _with(*SALES) + sql for name, sql in MARTS.items()}
    for name, (marts, sql) in REPORTS.items():
        queries[name] = _with(*SALES, *(mart(m) for m in marts)) + sql
    queries |= _quality()
    queries |= _exports()
    queries |= _loads()
    return queries
