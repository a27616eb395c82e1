"""Independent DuckDB SQL for every registered key.

The oracle follows the original pipeline's route: it materialises the fact at its
item x payment grain with plain joins and aggregates it with COUNT(DISTINCT),
window ``row_number``/``dense_rank`` for positional keys and category codes,
and the same mapping from driver tables to sources (FIXTURES.md §3). The Spark
side computes the same answers by different plans (pre-aggregated rollups,
distributed keys), so agreement is a real check.

Engine differences handled here: DuckDB divides decimals into DOUBLE, so money
averages are computed in integer millionths; NULL ordering is spelled out; casts of
doubles to integers truncate explicitly.
"""

from __future__ import annotations

from .sources.schemas import SOURCES

RUN_DATE = "2024-10-26"

# Source mapping (FIXTURES.md §3); parses in DuckDB and Spark SQL.
SOURCE_CTES = r"""
place AS (
  SELECT n_nationkey, n_nationkey * 1000 + 500 AS zip, lower(n_name) AS city, lower(substring(r_name, 1, 2)) AS state
  FROM nation JOIN region ON n_regionkey = r_regionkey),
s_translation AS (
  SELECT DISTINCT lower(p_type) AS product_category_name, 'cat_' || lower(p_type) AS product_category_name_english
  FROM part WHERE p_type <> 'PROMO'),
s_geolocation AS (
  SELECT zip AS geolocation_zip_code_prefix, CAST(c_custkey % 90 AS double) AS geolocation_lat, CAST(-(c_custkey % 180) AS double) AS geolocation_lng,
         city || CASE WHEN c_custkey % 2 = 0 THEN '' ELSE ' d''oeste-sul' END AS geolocation_city, state AS geolocation_state, c_custkey AS src_pos
  FROM customer JOIN place ON c_nationkey = n_nationkey),
s_sellers AS (
  SELECT CAST(s_suppkey AS string) AS seller_id, zip AS seller_zip_code_prefix, city AS seller_city, state AS seller_state
  FROM supplier JOIN place ON s_nationkey = n_nationkey),
s_customers AS (
  SELECT CAST(c_custkey AS string) AS customer_id, c_name AS customer_unique_id, zip AS customer_zip_code_prefix, city AS customer_city, state AS customer_state
  FROM customer JOIN place ON c_nationkey = n_nationkey),
s_products AS (
  SELECT CAST(p_partkey AS string) AS product_id, lower(p_type) AS product_category_name, CAST(length(p_name) AS int) AS product_name_length,
         CAST(length(p_name) * 10 AS double) AS product_description_length, p_size % 5 AS product_photos_qty,
         CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size * 100 END AS product_weight_g,
         CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_size AS double) END AS product_length_cm,
         CASE WHEN p_size % 4 = 0 THEN NULL ELSE CAST(p_size + 1 AS double) END AS product_height_cm,
         CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size + 2 AS double) END AS product_width_cm
  FROM part),
s_orders AS (
  SELECT CAST(o_orderkey AS string) AS order_id, CAST(o_custkey AS string) AS customer_id, o_orderstatus AS order_status,
         CAST(o_orderdate AS date) AS order_purchase_timestamp, CAST(o_orderdate AS date) + 1 AS order_approved_at,
         CAST(o_orderdate AS date) + 3 AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS date) + CAST(o_orderkey % 20 + 4 AS int) END AS order_delivered_customer_date,
         CAST(o_orderdate AS date) + 25 AS order_estimated_delivery_date
  FROM orders),
s_order_items AS (
  SELECT CAST(l_orderkey AS string) AS order_id, l_linenumber AS order_item_id, CAST(l_partkey AS string) AS product_id, CAST(l_suppkey AS string) AS seller_id,
         CAST(l_shipdate AS date) AS shipping_limit_date, l_extendedprice AS price, l_quantity AS freight_value
  FROM lineitem),
s_payments AS (
  SELECT CAST(l_orderkey AS string) AS order_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag) AS int) AS payment_sequential,
         CASE WHEN l_returnflag = 'N' THEN 'boleto' WHEN l_returnflag = 'R' THEN 'VOUCHER' WHEN l_orderkey % 2 = 0 THEN 'Credit_Card' ELSE 'credit_card' END AS payment_type,
         CASE WHEN count(*) = 1 THEN NULL ELSE CAST(count(*) AS double) END AS payment_installments,
         CAST(sum(CAST(l_extendedprice AS decimal(18,2))) AS double) AS payment_value
  FROM lineitem GROUP BY l_orderkey, l_returnflag),
s_order_reviews AS (
  SELECT 'r' || CAST(d.doc_id AS string) AS review_id, CAST(d.doc_id AS string) AS order_id, CAST(coalesce(quality * 4 + 1, 3) AS int) AS review_score,
         lang AS review_comment_title, text AS review_comment_message, date '1998-01-01' + CAST(d.doc_id % 365 AS int) AS review_creation_date,
         date '1998-01-01' + CAST(d.doc_id % 365 + 2 AS int) AS review_answer_timestamp
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def title(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(list_transform("
            f"regexp_extract_all({x}, '(\\p{{L}}+|\\P{{L}}+)', 1), "
            f"lambda t: upper(substring(t, 1, 1)) || lower(substring(t, 2))), '') END")


def zfill(x: str) -> str:
    s = f"CAST({x} AS VARCHAR)"
    return f"CASE WHEN length({s}) >= 5 THEN {s} ELSE lpad({s}, 5, '0') END"


def numeric_order(x: str) -> str:
    return f"TRY_CAST({x} AS BIGINT) NULLS LAST, {x} NULLS LAST"


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,6))"


def avg_cents(total: str, n: str) -> str:
    """round(total/n, 2) half away from zero, exactly, as DECIMAL(18,2)."""
    cents = f"CAST(({total}) * 1000000 AS HUGEINT)"
    cnt = f"NULLIF(CAST({n} AS HUGEINT), 0) * 10000"
    q = f"((2 * abs({cents}) + {cnt}) // (2 * {cnt}))"
    return f"CAST(CAST(sign({cents}) * {q} AS DECIMAL(38,0)) * 0.01 AS DECIMAL(18,2))"


def day_diff(a: str, b: str) -> str:
    return f"date_diff('second', CAST({a} AS TIMESTAMP), CAST({b} AS TIMESTAMP)) / 86400"


WAREHOUSE_CTES = f"""
o_dim_customers AS (
  SELECT customer_id, CAST(customer_unique_id AS VARCHAR) AS customer_unique_id,
         {zfill('customer_zip_code_prefix')} AS customer_zip_code_prefix,
         {title('customer_city')} AS customer_city, upper(customer_state) AS customer_state,
         row_number() OVER (ORDER BY {numeric_order('customer_id')}) AS customer_key,
         DATE '{RUN_DATE}' AS effective_date, DATE '{RUN_DATE}' + 3650 AS end_date, true AS is_current
  FROM s_customers),
o_dim_products AS (
  SELECT p.product_id, p.product_category_name, p.product_name_length, p.product_description_length,
         p.product_photos_qty, coalesce(p.product_weight_g, 0) AS product_weight_g,
         coalesce(p.product_length_cm, 0) AS product_length_cm, coalesce(p.product_height_cm, 0) AS product_height_cm,
         coalesce(p.product_width_cm, 0) AS product_width_cm,
         coalesce(t.product_category_name_english, 'Unknown') AS product_category_name_english,
         row_number() OVER (ORDER BY {numeric_order('p.product_id')}) AS product_key,
         DATE '{RUN_DATE}' AS last_updated
  FROM s_products p LEFT JOIN s_translation t ON p.product_category_name = t.product_category_name),
o_dim_sellers AS (
  SELECT seller_id, {zfill('seller_zip_code_prefix')} AS seller_zip_code_prefix,
         {title('seller_city')} AS seller_city, upper(seller_state) AS seller_state,
         row_number() OVER (ORDER BY {numeric_order('seller_id')}) AS seller_key,
         DATE '{RUN_DATE}' AS last_updated
  FROM s_sellers),
o_geo_keyed AS (
  SELECT {zfill('geolocation_zip_code_prefix')} AS geolocation_zip_code_prefix, geolocation_lat, geolocation_lng,
         {title('geolocation_city')} AS geolocation_city, upper(geolocation_state) AS geolocation_state,
         row_number() OVER (ORDER BY src_pos) AS geolocation_key
  FROM s_geolocation),
o_dim_geolocation AS (
  SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city, geolocation_state, geolocation_key
  FROM (SELECT *, row_number() OVER (PARTITION BY geolocation_zip_code_prefix ORDER BY geolocation_key) AS rn FROM o_geo_keyed)
  WHERE rn = 1),
o_pay_keyed AS (
  SELECT order_id, payment_sequential, lower(payment_type) AS payment_type,
         CAST(trunc(coalesce(CASE WHEN isnan(payment_installments) THEN NULL ELSE payment_installments END, 1)) AS INTEGER)
           AS payment_installments,
         payment_value,
         row_number() OVER (ORDER BY {numeric_order('order_id')}, payment_sequential NULLS LAST) AS payment_key
  FROM s_payments),
o_dim_payments AS (
  SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value, payment_key
  FROM (SELECT *, row_number() OVER (PARTITION BY payment_type, payment_installments ORDER BY payment_key) AS rn FROM o_pay_keyed)
  WHERE rn = 1),
o_fact_orders AS (
  SELECT o.order_id, o.customer_id AS customer_key, i.product_id AS product_key, i.seller_id AS seller_key,
         c.customer_zip_code_prefix AS geolocation_key,
         CAST(CASE WHEN p.payment_type IS NULL THEN 0 ELSE dense_rank() OVER (ORDER BY p.payment_type NULLS LAST) END AS INTEGER) AS payment_key,
         CAST(o.order_purchase_timestamp AS DATE) AS order_date_key, lower(o.order_status) AS order_status,
         i.price, i.freight_value, i.price + i.freight_value AS total_amount, p.payment_value,
         {day_diff('o.order_purchase_timestamp', 'o.order_delivered_customer_date')} AS delivery_time,
         {day_diff('o.order_purchase_timestamp', 'o.order_estimated_delivery_date')} AS estimated_delivery_time
  FROM s_orders o
  LEFT JOIN s_customers c ON o.customer_id = c.customer_id
  LEFT JOIN s_order_items i ON o.order_id = i.order_id
  LEFT JOIN s_payments p ON o.order_id = p.order_id),
o_fact_order_items AS (
  SELECT o.order_id, i.order_item_id, o.customer_id AS customer_key, i.product_id AS product_key, i.seller_id AS seller_key,
         c.customer_zip_code_prefix AS geolocation_key,
         CAST(o.order_purchase_timestamp AS DATE) AS order_date_key, lower(o.order_status) AS order_status,
         i.price, i.freight_value, i.price + i.freight_value AS total_amount,
         {day_diff('o.order_purchase_timestamp', 'o.order_delivered_customer_date')} AS delivery_time,
         {day_diff('o.order_purchase_timestamp', 'o.order_estimated_delivery_date')} AS estimated_delivery_time
  FROM s_orders o
  LEFT JOIN s_customers c ON o.customer_id = c.customer_id
  LEFT JOIN s_order_items i ON o.order_id = i.order_id),
o_dim_dates AS (
  SELECT CAST(d AS DATE) AS date_key, CAST(dayofmonth(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, monthname(d) AS month_name,
         isodow(d) IN (6, 7) AS is_weekend
  FROM (SELECT unnest(generate_series(CAST(make_date(year(min(order_purchase_timestamp)), 1, 1) AS TIMESTAMP),
                                      CAST(make_date(year(max(order_purchase_timestamp)), 12, 31) AS TIMESTAMP),
                                      INTERVAL 1 DAY)) AS d
        FROM s_orders)),
o_mart_sales_daily AS (
  SELECT CAST(order_date_key AS DATE) AS order_date, COUNT(DISTINCT order_id) AS order_count,
         CAST(SUM({money('total_amount')}) AS DECIMAL(18,2)) AS total_revenue,
         {avg_cents(f"SUM({money('total_amount')})", 'COUNT(DISTINCT order_id)')} AS average_order_value
  FROM o_fact_orders GROUP BY order_date_key),
o_mart_product_performance AS (
  SELECT substring(CAST(f.product_key AS VARCHAR), 1, 64) AS product_id, p.product_category_name,
         p.product_category_name_english, COUNT(DISTINCT f.order_id) AS order_count, COUNT(*) AS total_quantity,
         CAST(SUM({money('f.total_amount')}) AS DECIMAL(18,2)) AS total_revenue,
         {avg_cents(f"SUM({money('f.price')})", 'COUNT(f.price)')} AS avg_item_price
  FROM o_fact_orders f JOIN o_dim_products p ON f.product_key = p.product_id
  GROUP BY f.product_key, p.product_category_name, p.product_category_name_english),
o_mart_city_revenue AS (
  SELECT g.geolocation_city, g.geolocation_state, COUNT(DISTINCT f.order_id) AS order_count,
         CAST(SUM({money('f.total_amount')}) AS DECIMAL(18,2)) AS total_revenue
  FROM o_fact_orders f JOIN o_dim_geolocation g
    ON CAST(f.geolocation_key AS VARCHAR) = CAST(g.geolocation_zip_code_prefix AS VARCHAR)
  GROUP BY g.geolocation_city, g.geolocation_state)"""


def with_ctes(body: str, extra: str | None = None) -> str:
    more = f",\n{extra}" if extra else ""
    return f"WITH {SOURCE_CTES},{WAREHOUSE_CTES}{EXTRA_CTES}{more}\n{body}"


FACT_COLS = ("order_id, customer_key, product_key, seller_key, geolocation_key, payment_key, order_date_key, "
             "order_status, price, freight_value, total_amount, payment_value, delivery_time, estimated_delivery_time")


SOURCE_CTE = {
    "product_category_name_translation": "s_translation", "geolocation": "s_geolocation", "sellers": "s_sellers",
    "customers": "s_customers", "products": "s_products", "orders": "s_orders", "order_items": "s_order_items",
    "payments": "s_payments", "order_reviews": "s_order_reviews",
}
STAGING_ORDER = list(SOURCE_CTE)
FOREIGN_KEYS = [
    ("products", "product_category_name", "product_category_name_translation", "product_category_name"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
]
PRIMARY_KEYS = [
    ("product_category_name_translation", "s_translation", ["product_category_name"]),
    ("sellers", "s_sellers", ["seller_id"]),
    ("customers", "s_customers", ["customer_id"]),
    ("products", "s_products", ["product_id"]),
    ("orders", "s_orders", ["order_id"]),
    ("mart_sales_daily", "o_mart_sales_daily", ["order_date"]),
    ("mart_product_performance", "o_mart_product_performance", ["product_id"]),
    ("mart_city_revenue", "o_mart_city_revenue", ["geolocation_city", "geolocation_state"]),
]
# Declared varchar(n) limits, per table (source DDL and mart DDL).
LENGTH_LIMITS = [
    ("product_category_name_translation", "s_translation",
     [("product_category_name", 64), ("product_category_name_english", 64)]),
    ("geolocation", "s_geolocation", [("geolocation_city", 64), ("geolocation_state", 64)]),
    ("sellers", "s_sellers", [("seller_id", 64), ("seller_city", 64), ("seller_state", 64)]),
    ("customers", "s_customers",
     [("customer_id", 64), ("customer_unique_id", 32), ("customer_city", 64), ("customer_state", 64)]),
    ("products", "s_products", [("product_id", 64), ("product_category_name", 64)]),
    ("orders", "s_orders", [("order_id", 64), ("customer_id", 64), ("order_status", 32)]),
    ("order_items", "s_order_items", [("order_id", 64), ("product_id", 64), ("seller_id", 64)]),
    ("payments", "s_payments", [("order_id", 64), ("payment_type", 32)]),
    ("order_reviews", "s_order_reviews", [("review_id", 64), ("order_id", 64)]),
    ("mart_product_performance", "o_mart_product_performance",
     [("product_id", 64), ("product_category_name", 64), ("product_category_name_english", 64)]),
    ("mart_city_revenue", "o_mart_city_revenue", [("geolocation_city", 64), ("geolocation_state", 64)]),
]
MANIFEST = (
    [("staging", f"stg_{t}", SOURCE_CTE[t]) for t in STAGING_ORDER]
    + [("warehouse", t, f"o_{t}") for t in ["dim_customers", "dim_products", "dim_sellers", "dim_geolocation"]]
    + [("warehouse", "dim_dates", "o_default_calendar"), ("warehouse", "dim_payments", "o_dim_payments"),
       ("warehouse", "fact_orders", "o_fact_orders")]
    + [("mart", m, f"o_{m}") for m in ["mart_sales_daily", "mart_product_performance", "mart_city_revenue"]]
)
EXTRA_CTES = """,
o_default_calendar AS (SELECT * FROM generate_series(DATE '2016-01-01', DATE '2025-12-31', INTERVAL 1 DAY))"""


def _sales_daily(fact: str) -> str:
    total = f"SUM({money('total_amount')})"
    return (f"SELECT CAST(order_date_key AS DATE) AS order_date, COUNT(DISTINCT order_id) AS order_count, "
            f"CAST({total} AS DECIMAL(18,2)) AS total_revenue, "
            f"{avg_cents(total, 'COUNT(DISTINCT order_id)')} AS average_order_value "
            f"FROM {fact} GROUP BY order_date_key")


def _city(join_on: str) -> str:
    return (f"SELECT g.geolocation_city, g.geolocation_state, COUNT(DISTINCT f.order_id) AS order_count, "
            f"CAST(SUM({money('f.total_amount')}) AS DECIMAL(18,2)) AS total_revenue "
            f"FROM o_fact_orders f JOIN o_dim_geolocation g ON {join_on} "
            f"GROUP BY g.geolocation_city, g.geolocation_state")


def _revenue_by_city(join_on: str) -> str:
    return (f"SELECT g.geolocation_city, CAST(SUM({money('f.total_amount')}) AS DECIMAL(38,2)) AS total_revenue "
            f"FROM o_fact_orders f JOIN o_dim_geolocation g ON {join_on} GROUP BY g.geolocation_city")


def _counts(present: bool) -> str:
    parts = []
    for layer, name, cte in MANIFEST:
        tail = "true AS present, COUNT(*) AS row_count" if present else "COUNT(*) AS row_count, COUNT(*) > 0 AS non_empty"
        parts.append(f"SELECT '{layer}' AS layer, '{name}' AS table_name, {tail} FROM {cte}")
    return "\nUNION ALL ".join(parts)


def _order_counts() -> str:
    day, product = "o_fact_orders", "o_fact_orders f JOIN o_dim_products p ON f.product_key = p.product_id"
    place = "o_fact_orders f JOIN o_dim_geolocation g ON CAST(f.geolocation_key AS VARCHAR) = CAST(g.geolocation_zip_code_prefix AS VARCHAR)"
    levels = [
        ("date", "day", "CAST(order_date_key AS VARCHAR)", day, "order_date_key"),
        ("date", "month", "strftime(order_date_key, '%Y-%m')", day, "strftime(order_date_key, '%Y-%m')"),
        ("date", "all", "'all'", day, None),
        ("product", "product", "f.product_key", product, "f.product_key"),
        ("product", "category", "product_category_name_english", product, "product_category_name_english"),
        ("product", "all", "'all'", product, None),
        ("place", "city", "concat_ws(', ', geolocation_city, geolocation_state)", place, "geolocation_city, geolocation_state"),
        ("place", "state", "geolocation_state", place, "geolocation_state"),
        ("place", "all", "'all'", place, None)]
    return "\nUNION ALL ".join(
        f"SELECT '{d}' AS dimension, '{n}' AS level, {name} AS group_name, COUNT(DISTINCT order_id) AS order_count FROM {rows}"
        + (f" GROUP BY {by}" if by else "") for d, n, name, rows, by in levels)


def _lookups() -> str:
    def top(c: str) -> str:
        return (f"(SELECT {c} FROM (SELECT {c}, COUNT(*) AS n FROM o_fact_orders WHERE {c} IS NOT NULL GROUP BY {c}) "
                f"ORDER BY n DESC, {c} LIMIT 1)")

    def measured(name: str, value: str, condition: str) -> str:
        return (f"SELECT '{name}' AS lookup, {value} AS value, COUNT(*) AS n_rows, COUNT(DISTINCT order_id) AS n_orders, "
                f"CAST(SUM({money('total_amount')}) AS DECIMAL(38,2)) AS revenue FROM o_fact_orders WHERE {condition}")

    day, product = top("order_date_key"), top("product_key")
    return "\nUNION ALL ".join(
        [measured(c, f"CAST({top(c)} AS VARCHAR)", f"{c} = {top(c)}") for c in ("order_date_key", "product_key", "customer_key")]
        + [measured("product_key, order_date_key", f"CAST({product} AS VARCHAR) || ', ' || CAST({day} AS VARCHAR)",
                    f"product_key = {product} AND order_date_key BETWEEN {day} - 180 AND {day} + 180")])


def _foreign_keys() -> str:
    parts = []
    for ct, cc, pt, pc in FOREIGN_KEYS:
        parts.append(
            f"SELECT '{ct}' AS child_table, '{cc}' AS child_column, '{pt}' AS parent_table, '{pc}' AS parent_column, "
            f"COUNT(c.{cc}) AS child_rows, COUNT(c.{cc}) FILTER (WHERE p.k IS NULL) AS dangling_rows, "
            f"COUNT(c.{cc}) FILTER (WHERE p.k IS NULL) = 0 AS ok "
            f"FROM {SOURCE_CTE[ct]} c LEFT JOIN (SELECT DISTINCT {pc} AS k FROM {SOURCE_CTE[pt]}) p ON c.{cc} = p.k")
    return "\nUNION ALL ".join(parts)


def _primary_keys() -> str:
    parts = []
    for name, cte, keys in PRIMARY_KEYS:
        null = " OR ".join(f"{k} IS NULL" for k in keys)
        inner = f"SELECT ({null}) AS k_null, COUNT(*) AS n FROM {cte} GROUP BY {', '.join(keys)}"
        parts.append(
            f"SELECT '{name}' AS table_name, '{','.join(keys)}' AS key_columns, "
            f"CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_rows, "
            f"CAST(COALESCE(SUM(n) FILTER (WHERE k_null), 0) AS BIGINT) AS n_null_keys, "
            f"COUNT(*) FILTER (WHERE NOT k_null AND n > 1) AS n_duplicate_keys, "
            f"COALESCE(SUM(n) FILTER (WHERE k_null), 0) = 0 AND COUNT(*) FILTER (WHERE NOT k_null AND n > 1) = 0 AS ok "
            f"FROM ({inner})")
    return "\nUNION ALL ".join(parts)


def _lengths() -> str:
    parts = []
    for name, cte, cols in LENGTH_LIMITS:
        for c, n in cols:
            parts.append(
                f"SELECT '{name}' AS table_name, '{c}' AS column_name, CAST(max(length({c})) AS INTEGER) AS max_length, "
                f"{n} AS length_limit, COALESCE(max(length({c})) <= {n}, true) AS within_limit FROM {cte}")
    return "\nUNION ALL ".join(parts)


def _loaded() -> str:
    parts = []
    for t in STAGING_ORDER:
        for f in SOURCES[t].schema.fields:
            text = f.dataType.simpleString() == "string"
            size = f"CAST(SUM(length({f.name})) AS BIGINT)" if text else "CAST(NULL AS BIGINT)"
            parts.append(f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, COUNT(*) AS n_rows, "
                         f"COUNT({f.name}) AS n_values, {size} AS n_chars FROM {SOURCE_CTE[t]}")
    return "\nUNION ALL ".join(parts)


def _queries() -> dict[str, str]:
    q: dict[str, str] = {}
    for t in STAGING_ORDER:
        q[f"stg_{t}"] = f"SELECT * FROM {SOURCE_CTE[t]}"
    for d in ["dim_customers", "dim_products", "dim_sellers", "dim_geolocation", "dim_payments", "dim_dates"]:
        q[d] = f"SELECT * FROM o_{d}"
    q["fact_orders"] = f"SELECT {FACT_COLS} FROM o_fact_orders"
    q["fact_lookups"] = _lookups()
    q["mart_sales_daily"] = "SELECT * FROM o_mart_sales_daily"
    q["mart_product_performance"] = "SELECT * FROM o_mart_product_performance"
    q["mart_city_revenue"] = "SELECT * FROM o_mart_city_revenue"
    q["report_revenue_by_month"] = (
        f"SELECT d.month, CAST(SUM({money('f.total_amount')}) AS DECIMAL(38,2)) AS total_revenue "
        f"FROM o_fact_orders f JOIN o_dim_dates d ON f.order_date_key = d.date_key GROUP BY d.month")
    q["report_orders_by_status"] = (
        "SELECT order_status, COUNT(order_id) AS order_count FROM o_fact_orders GROUP BY order_status")
    q["report_units_by_category"] = (
        "SELECT p.product_category_name, COUNT(f.order_id) AS total_sold "
        "FROM o_fact_orders f JOIN o_dim_products p ON f.product_key = p.product_id GROUP BY p.product_category_name")
    q["report_revenue_by_city"] = _revenue_by_city("f.geolocation_key = g.geolocation_key")
    q["report_sales_daily"] = "SELECT order_date, order_count, total_revenue, average_order_value FROM o_mart_sales_daily"
    q["report_top20_products"] = (
        "SELECT product_id, product_category_name_english, total_quantity, total_revenue "
        "FROM o_mart_product_performance ORDER BY total_revenue DESC NULLS FIRST, product_id LIMIT 20")
    q["report_top20_cities"] = (
        "SELECT geolocation_city, geolocation_state, order_count, total_revenue FROM o_mart_city_revenue "
        "ORDER BY total_revenue DESC NULLS FIRST, geolocation_city, geolocation_state LIMIT 20")
    q["report_total_revenue_all_days"] = (
        "SELECT CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS total_revenue_all_days FROM o_mart_sales_daily")
    q["report_total_orders_all_days"] = (
        "SELECT CAST(SUM(order_count) AS BIGINT) AS total_orders_all_days FROM o_mart_sales_daily")
    q["report_order_counts"] = _order_counts()
    moved = ("FROM customer JOIN place ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'")
    q["upsert_by_key"] = (
        "SELECT * FROM s_customers c WHERE NOT EXISTS (SELECT 1 FROM o_latest l WHERE l.customer_id = c.customer_id) "
        "UNION ALL SELECT * FROM o_latest", f"""o_batch AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id, zip AS customer_zip_code_prefix,
         city || '-1' AS customer_city, state AS customer_state, 1 AS seq {moved}
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), c_name, zip + 1, city || '-2', state, 2 {moved}
  UNION ALL
  SELECT 's' || CAST(s_suppkey AS VARCHAR), s_name, zip, city, state, 1
  FROM supplier JOIN place ON s_nationkey = n_nationkey),
o_latest AS (
  SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY seq DESC) AS rn FROM o_batch) WHERE rn = 1)""")
    q["delete_by_keys"] = (
        "SELECT * FROM s_orders o WHERE NOT EXISTS (SELECT 1 FROM orders d "
        "WHERE d.o_orderpriority = '5-LOW' AND CAST(d.o_orderkey AS VARCHAR) = o.order_id)")
    q["append_rows"] = (
        "SELECT * FROM s_sellers UNION ALL SELECT 'c' || customer_id AS seller_id, "
        "customer_zip_code_prefix AS seller_zip_code_prefix, customer_city AS seller_city, "
        "customer_state AS seller_state FROM s_customers")
    q["truncate_table"] = ("SELECT 'before' AS stage, COUNT(*) AS n_rows FROM s_orders "
                           "UNION ALL SELECT 'after', CAST(0 AS BIGINT)")
    q["dump_table"] = ("SELECT 'staging.stg_order_reviews' AS table_name, 'staging__stg_order_reviews.txt' AS file_name, "
                       "COUNT(*) AS rows_written FROM s_order_reviews")
    q["reload_dump"] = "SELECT * FROM s_order_reviews"
    q["load_csv"] = "SELECT * FROM s_order_reviews"
    q["load_csv_tables"] = _loaded()
    q["get_records"] = "SELECT order_status, COUNT(*) AS order_count FROM s_orders GROUP BY order_status"
    q["dq_row_counts"] = _counts(present=False)
    q["dq_tables"] = _counts(present=True)
    q["dq_foreign_keys"] = _foreign_keys()
    q["dq_primary_keys"] = _primary_keys()
    q["dq_lengths"] = _lengths()
    q["dq_loads"] = (
        """SELECT load, 'orders.order_id' AS check_name, CAST(SUM(n) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_null_keys,
       COUNT(*) FILTER (WHERE n > 1) AS n_duplicate_keys, COUNT(*) FILTER (WHERE first_load < load) AS n_known_keys, CAST(0 AS BIGINT) AS n_dangling
FROM (SELECT load, order_id, COUNT(*) AS n, MIN(MIN(load)) OVER (PARTITION BY order_id) AS first_load FROM o_arrivals GROUP BY load, order_id)
GROUP BY load
UNION ALL
SELECT i.load, 'order_items.order_id', COUNT(i.order_id), 0, 0, 0, COUNT(i.order_id) FILTER (WHERE a.first_load IS NULL OR a.first_load > i.load)
FROM (SELECT order_id, CAST(year(shipping_limit_date) // 2 AS INTEGER) AS load FROM s_order_items) i
LEFT JOIN (SELECT order_id, MIN(load) AS first_load FROM o_arrivals GROUP BY order_id) a ON i.order_id = a.order_id
GROUP BY i.load""", """o_arrivals AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(year(o_orderdate) // 2 + CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS INTEGER) AS load FROM orders
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), CAST(year(o_orderdate) // 2 + 1 AS INTEGER) FROM orders WHERE o_orderpriority = '1-URGENT')""")
    q["category_code"] = (
        "SELECT order_id, payment_sequential, payment_type, CAST(CASE WHEN payment_type IS NULL THEN 0 "
        "ELSE dense_rank() OVER (ORDER BY payment_type NULLS LAST) END AS INTEGER) AS payment_code FROM s_payments")
    q["dense_key"] = (
        f"SELECT *, row_number() OVER (ORDER BY {numeric_order('order_id')}, order_item_id NULLS LAST, "
        f"{numeric_order('product_id')}, {numeric_order('seller_id')}, shipping_limit_date NULLS LAST, "
        f"price NULLS LAST, freight_value NULLS LAST) AS item_key FROM s_order_items")
    q["stable_key"] = (
        "SELECT payment_type, COUNT(*) AS n_rows, MIN(position) AS first_position, MAX(position) AS last_position, "
        "CAST(SUM(position) AS DECIMAL(38,0)) AS position_sum FROM (SELECT payment_type, "
        "row_number() OVER (ORDER BY payment_type NULLS LAST) AS position FROM s_payments) GROUP BY payment_type")
    q["keep_first"] = (
        "SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value FROM "
        "(SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY payment_sequential) AS rn FROM s_payments) "
        "WHERE rn = 1")
    q["title_case_city"] = (
        f"SELECT city, {title('city')} AS city_title FROM (SELECT geolocation_city AS city FROM s_geolocation "
        f"UNION SELECT customer_city FROM s_customers UNION SELECT seller_city FROM s_sellers)")
    q["mart_city_revenue_padded"] = _city(f"{zfill('f.geolocation_key')} = g.geolocation_zip_code_prefix")
    q["report_revenue_by_city_zip"] = _revenue_by_city(f"{zfill('f.geolocation_key')} = g.geolocation_zip_code_prefix")
    q["fact_order_items"] = "SELECT * FROM o_fact_order_items"
    q["mart_sales_daily_item_grain"] = _sales_daily("o_fact_order_items")
    q["incremental_sales_daily"] = "SELECT * FROM o_mart_sales_daily"
    q["fact_orders_surrogate_keys"] = f"""SELECT o.order_id, dc.customer_key, dp.product_key, ds.seller_key,
       dg.geolocation_key, dy.payment_key, CAST(o.order_purchase_timestamp AS DATE) AS order_date_key,
       lower(o.order_status) AS order_status, i.price, i.freight_value, i.price + i.freight_value AS total_amount,
       p.payment_value,
       {day_diff('o.order_purchase_timestamp', 'o.order_delivered_customer_date')} AS delivery_time,
       {day_diff('o.order_purchase_timestamp', 'o.order_estimated_delivery_date')} AS estimated_delivery_time
FROM s_orders o
LEFT JOIN s_customers c ON o.customer_id = c.customer_id
LEFT JOIN o_dim_customers dc ON o.customer_id = dc.customer_id
LEFT JOIN o_dim_geolocation dg ON {zfill('c.customer_zip_code_prefix')} = dg.geolocation_zip_code_prefix
LEFT JOIN s_order_items i ON o.order_id = i.order_id
LEFT JOIN o_dim_products dp ON i.product_id = dp.product_id
LEFT JOIN o_dim_sellers ds ON i.seller_id = ds.seller_id
LEFT JOIN s_payments p ON o.order_id = p.order_id
LEFT JOIN o_dim_payments dy ON lower(p.payment_type) = dy.payment_type
  AND CAST(trunc(coalesce(CASE WHEN isnan(p.payment_installments) THEN NULL ELSE p.payment_installments END, 1))
           AS INTEGER) = dy.payment_installments"""
    return q


def oracle_sql() -> dict[str, str]:
    out = {}
    for k, v in _queries().items():
        body, extra = (v if isinstance(v, tuple) else (v, None))
        out[k] = with_ctes(body, extra)
    return out
