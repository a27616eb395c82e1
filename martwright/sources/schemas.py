"""Declared source tables, their keys and limits, and the typed mart tables.

Spark does not enforce primary keys, foreign keys or varchar lengths; they are
kept here as metadata and checked by ``martwright.operators.quality``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S, I, L, D, DT, B = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                     T.DateType(), T.BooleanType())
MONEY = T.DecimalType(18, 2)


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    # (column, parent table, parent column)
    foreign_keys: tuple[tuple[str, str, str], ...] = ()
    # declared varchar(n) limits
    lengths: dict[str, int] = field(default_factory=dict)


SOURCES: dict[str, TableSpec] = {t.name: t for t in [
    TableSpec("product_category_name_translation",
              _schema(("product_category_name", S), ("product_category_name_english", S)),
              primary_key=("product_category_name",),
              lengths={"product_category_name": 64, "product_category_name_english": 64}),
    TableSpec("geolocation",
              _schema(("geolocation_zip_code_prefix", I), ("geolocation_lat", D), ("geolocation_lng", D),
                      ("geolocation_city", S), ("geolocation_state", S)),
              lengths={"geolocation_city": 64, "geolocation_state": 64}),
    TableSpec("sellers",
              _schema(("seller_id", S), ("seller_zip_code_prefix", I), ("seller_city", S), ("seller_state", S)),
              primary_key=("seller_id",),
              lengths={"seller_id": 64, "seller_city": 64, "seller_state": 64}),
    TableSpec("customers",
              _schema(("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", I),
                      ("customer_city", S), ("customer_state", S)),
              primary_key=("customer_id",),
              lengths={"customer_id": 64, "customer_unique_id": 32, "customer_city": 64, "customer_state": 64}),
    TableSpec("products",
              _schema(("product_id", S), ("product_category_name", S), ("product_name_length", I),
                      ("product_description_length", D), ("product_photos_qty", I), ("product_weight_g", I),
                      ("product_length_cm", D), ("product_height_cm", D), ("product_width_cm", D)),
              primary_key=("product_id",),
              foreign_keys=(("product_category_name", "product_category_name_translation",
                             "product_category_name"),),
              lengths={"product_id": 64, "product_category_name": 64}),
    TableSpec("orders",
              _schema(("order_id", S), ("customer_id", S), ("order_status", S), ("order_purchase_timestamp", DT),
                      ("order_approved_at", DT), ("order_delivered_carrier_date", DT),
                      ("order_delivered_customer_date", DT), ("order_estimated_delivery_date", DT)),
              primary_key=("order_id",),
              foreign_keys=(("customer_id", "customers", "customer_id"),),
              lengths={"order_id": 64, "customer_id": 64, "order_status": 32}),
    TableSpec("order_items",
              _schema(("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
                      ("shipping_limit_date", DT), ("price", D), ("freight_value", D)),
              foreign_keys=(("product_id", "products", "product_id"), ("order_id", "orders", "order_id"),
                            ("seller_id", "sellers", "seller_id")),
              lengths={"order_id": 64, "product_id": 64, "seller_id": 64}),
    TableSpec("payments",
              _schema(("order_id", S), ("payment_sequential", I), ("payment_type", S),
                      ("payment_installments", D), ("payment_value", D)),
              foreign_keys=(("order_id", "orders", "order_id"),),
              lengths={"order_id": 64, "payment_type": 32}),
    TableSpec("order_reviews",
              _schema(("review_id", S), ("order_id", S), ("review_score", I), ("review_comment_title", S),
                      ("review_comment_message", S), ("review_creation_date", DT),
                      ("review_answer_timestamp", DT)),
              foreign_keys=(("order_id", "orders", "order_id"),),
              lengths={"review_id": 64, "order_id": 64}),
]}

# Staging copies are loaded in this order (translation first, reviews last).
STAGING_ORDER = ["product_category_name_translation", "geolocation", "sellers", "customers", "products",
                 "orders", "order_items", "payments", "order_reviews"]

# Ingest position column carried by sources whose row order matters
# (positional keys, keep-first de-duplication).
SRC_POS = "src_pos"

FACT_COLUMNS = ["order_id", "customer_key", "product_key", "seller_key", "geolocation_key", "payment_key",
                "order_date_key", "order_status", "price", "freight_value", "total_amount", "payment_value",
                "delivery_time", "estimated_delivery_time"]

MART_SCHEMAS: dict[str, T.StructType] = {
    "mart_sales_daily": _schema(("order_date", DT), ("order_count", L), ("total_revenue", MONEY),
                                ("average_order_value", MONEY)),
    "mart_product_performance": _schema(("product_id", S), ("product_category_name", S),
                                        ("product_category_name_english", S), ("order_count", L),
                                        ("total_quantity", L), ("total_revenue", MONEY), ("avg_item_price", MONEY)),
    "mart_city_revenue": _schema(("geolocation_city", S), ("geolocation_state", S), ("order_count", L),
                                 ("total_revenue", MONEY)),
}
MART_KEYS = {
    "mart_sales_daily": ("order_date",),
    "mart_product_performance": ("product_id",),
    "mart_city_revenue": ("geolocation_city", "geolocation_state"),
}
MART_LENGTHS = {
    "mart_product_performance": {"product_id": 64, "product_category_name": 64,
                                 "product_category_name_english": 64},
    "mart_city_revenue": {"geolocation_city": 64, "geolocation_state": 64},
}

# Expected table set after one run (layer -> tables).
MANIFEST = {
    "staging": [f"stg_{t}" for t in STAGING_ORDER],
    "warehouse": ["dim_customers", "dim_products", "dim_sellers", "dim_geolocation", "dim_dates",
                  "dim_payments", "fact_orders"],
    "mart": list(MART_SCHEMAS),
}
