"""Driver test tables -> the nine e-commerce source tables.

The mapping is the one written down in FIXTURES.md §3 (the oracle runs the same
mapping as SQL). It is expressed here with the DataFrame API so that Spark
prunes columns and pushes filters into the parquet scans of the driver tables.
Every frame reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .schemas import SRC_POS

Tables = Callable[[str], DataFrame]


def driver_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Return a loader ``name -> DataFrame`` over ``{sf_dir}/{name}.parquet``."""
    root = sf_dir.rstrip("/")

    def load(name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{name}.parquet")

    return load


def _place(t: Tables) -> DataFrame:
    # nation/region are the fixed 25/5-row TPC-H dimensions: a proven size bound.
    n, r = t("nation"), t("region")
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
            .select("n_nationkey",
                    (F.col("n_nationkey") * 1000 + 500).alias("zip"),
                    F.lower("n_name").alias("city"),
                    F.lower(F.substring("r_name", 1, 2)).alias("state")))


def translation(t: Tables) -> DataFrame:
    p = t("part")
    return (p.where(F.col("p_type") != "PROMO")
            .select(F.lower("p_type").alias("product_category_name"))
            .distinct()
            .select("product_category_name",
                    F.concat(F.lit("cat_"), F.col("product_category_name")).alias("product_category_name_english")))


def geolocation(t: Tables) -> DataFrame:
    c = t("customer")
    odd = F.col("c_custkey") % 2 != 0
    return (c.join(F.broadcast(_place(t)), c.c_nationkey == F.col("n_nationkey"))
            .select(F.col("zip").alias("geolocation_zip_code_prefix"),
                    (F.col("c_custkey") % 90).cast("double").alias("geolocation_lat"),
                    (-(F.col("c_custkey") % 180)).cast("double").alias("geolocation_lng"),
                    F.concat(F.col("city"), F.when(odd, F.lit(" d'oeste-sul")).otherwise(F.lit("")))
                    .alias("geolocation_city"),
                    F.col("state").alias("geolocation_state"),
                    F.col("c_custkey").alias(SRC_POS)))


def sellers(t: Tables) -> DataFrame:
    s = t("supplier")
    return (s.join(F.broadcast(_place(t)), s.s_nationkey == F.col("n_nationkey"))
            .select(F.col("s_suppkey").cast("string").alias("seller_id"),
                    F.col("zip").alias("seller_zip_code_prefix"),
                    F.col("city").alias("seller_city"),
                    F.col("state").alias("seller_state")))


def customers(t: Tables) -> DataFrame:
    c = t("customer")
    return (c.join(F.broadcast(_place(t)), c.c_nationkey == F.col("n_nationkey"))
            .select(F.col("c_custkey").cast("string").alias("customer_id"),
                    F.col("c_name").alias("customer_unique_id"),
                    F.col("zip").alias("customer_zip_code_prefix"),
                    F.col("city").alias("customer_city"),
                    F.col("state").alias("customer_state")))


def products(t: Tables) -> DataFrame:
    p = t("part")
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.lower("p_type").alias("product_category_name"),
        F.length("p_name").cast("int").alias("product_name_length"),
        (F.length("p_name") * 10).cast("double").alias("product_description_length"),
        (size % 5).alias("product_photos_qty"),
        F.when(size % 7 == 0, F.lit(None)).otherwise(size * 100).alias("product_weight_g"),
        F.when(size % 5 == 0, F.lit(None)).otherwise(size.cast("double")).alias("product_length_cm"),
        F.when(size % 4 == 0, F.lit(None)).otherwise((size + 1).cast("double")).alias("product_height_cm"),
        F.when(size % 3 == 0, F.lit(None)).otherwise((size + 2).cast("double")).alias("product_width_cm"))


def orders(t: Tables) -> DataFrame:
    o = t("orders")
    day = F.col("o_orderdate").cast("date")
    delivered = F.when(F.col("o_orderstatus") == "F",
                       F.date_add(day, (F.col("o_orderkey") % 20 + 4).cast("int")))
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        day.alias("order_purchase_timestamp"),
        F.date_add(day, 1).alias("order_approved_at"),
        F.date_add(day, 3).alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        F.date_add(day, 25).alias("order_estimated_delivery_date"))


def order_items(t: Tables) -> DataFrame:
    li = t("lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").cast("date").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"))


def payments(t: Tables) -> DataFrame:
    li = t("lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice")
    per_flag = li.groupBy("l_orderkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("_v"))
    seq = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_returnflag"))
    flag = F.col("l_returnflag")
    ptype = (F.when(flag == "N", "boleto").when(flag == "R", "VOUCHER")
             .when(F.col("l_orderkey") % 2 == 0, "Credit_Card").otherwise("credit_card"))
    return per_flag.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        seq.cast("int").alias("payment_sequential"),
        ptype.alias("payment_type"),
        F.when(F.col("_n") == 1, F.lit(None)).otherwise(F.col("_n").cast("double")).alias("payment_installments"),
        F.col("_v").cast("double").alias("payment_value"))


def order_reviews(t: Tables) -> DataFrame:
    d, lab = t("documents"), t("labels")
    base = F.lit("1998-01-01").cast("date")
    return (d.join(lab, "doc_id", "left")
            .select(F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("review_id"),
                    F.col("doc_id").cast("string").alias("order_id"),
                    F.coalesce(F.col("quality") * 4 + 1, F.lit(3)).cast("int").alias("review_score"),
                    F.col("lang").alias("review_comment_title"),
                    F.col("text").alias("review_comment_message"),
                    F.date_add(base, (F.col("doc_id") % 365).cast("int")).alias("review_creation_date"),
                    F.date_add(base, (F.col("doc_id") % 365 + 2).cast("int")).alias("review_answer_timestamp")))


BUILDERS = {
    "product_category_name_translation": translation,
    "geolocation": geolocation,
    "sellers": sellers,
    "customers": customers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
    "order_reviews": order_reviews,
}


class Sources:
    """Lazily built source frames for one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._t = driver_tables(spark, sf_dir)
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = BUILDERS[name](self._t)
        return self._cache[name]

    def driver(self, name: str) -> DataFrame:
        return self._t(name)

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in BUILDERS}


def load_sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(spark, sf_dir)
