"""The three marts (as written) and their corrected variants.

Each ``COUNT(DISTINCT order_id)`` is planned as two groupings: first by
(group, order_id), which the order-partitioned input already satisfies (no
shuffle), then by the group after partial aggregation. Money is summed at six
decimals and rounded once, to the declared mart types; averages are rounded
half away from zero in integer millionths.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import avg_money, money, to_varchar, zfill
from ..sources.schemas import MART_SCHEMAS, MONEY
from . import dims, facts

Src = Mapping[str, DataFrame]


def conform(df: DataFrame, mart: str) -> DataFrame:
    """Cast to the mart's declared schema (names, order, types)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MART_SCHEMAS[mart].fields])


def _sales_daily(rollup: DataFrame) -> DataFrame:
    per_order = rollup.groupBy("order_date_key", "order_id").agg(F.sum("revenue").alias("revenue"))
    daily = per_order.groupBy("order_date_key").agg(F.count(F.lit(1)).alias("order_count"),
                                                     F.sum("revenue").alias("total"))
    return daily.select(F.col("order_date_key").cast("date").alias("order_date"), "order_count",
                        F.col("total").cast(MONEY).alias("total_revenue"),
                        avg_money(F.col("total"), F.col("order_count")).alias("average_order_value"))


def mart_sales_daily(src: Src) -> DataFrame:
    return conform(_sales_daily(facts.order_rollup(src, with_zip=False)), "mart_sales_daily")


def mart_sales_daily_item_grain(src: Src) -> DataFrame:
    """Corrected: revenue at item grain (no payment fan-out)."""
    return conform(_sales_daily(facts.order_rollup(src, with_fanout=False, with_zip=False)), "mart_sales_daily")


def _product_totals(items: DataFrame) -> DataFrame:
    """Per product: distinct orders, fact rows, revenue, price sum/count."""
    w = F.col("fanout")
    per_pair = items.where(F.col("product_key").isNotNull()).groupBy("product_key", "order_id").agg(
        F.sum(w).alias("rows"),
        F.sum(money("total_amount") * w).alias("revenue"),
        F.sum(money("price") * w).alias("price_sum"),
        F.sum(F.when(F.col("price").isNotNull(), w)).alias("price_n"))
    return per_pair.groupBy("product_key").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("rows").alias("total_quantity"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("price_sum").alias("price_sum"),
        F.sum("price_n").alias("price_n"))


def mart_product_performance(src: Src, dim_products: DataFrame | None = None) -> DataFrame:
    return _product_performance(facts.item_grain(src),
                                dim_products if dim_products is not None else dims.product_attributes(src))


def _product_performance(items: DataFrame, p: DataFrame) -> DataFrame:
    p = p.select("product_id", "product_category_name", "product_category_name_english")
    totals = _product_totals(items)
    j = totals.join(p, totals["product_key"] == p["product_id"])
    out = j.select(to_varchar(totals["product_key"], 64).alias("product_id"),
                   "product_category_name", "product_category_name_english", "order_count", "total_quantity",
                   F.col("total_revenue").cast(MONEY).alias("total_revenue"),
                   avg_money(F.col("price_sum"), F.col("price_n")).alias("avg_item_price"))
    return conform(out, "mart_product_performance")


def _city_revenue(rollup: DataFrame, geo: DataFrame, zip_text: F.Column) -> DataFrame:
    g = geo.select("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state")
    j = rollup.join(g, zip_text == g["geolocation_zip_code_prefix"])
    per_order = j.groupBy("geolocation_city", "geolocation_state", "order_id").agg(
        F.sum("revenue").alias("revenue"))
    out = per_order.groupBy("geolocation_city", "geolocation_state").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("revenue").alias("total_revenue"))
    return conform(out, "mart_city_revenue")


def mart_city_revenue(src: Src, dim_geolocation: DataFrame | None = None) -> DataFrame:
    """As written: the fact's raw zip (text) against the padded dim zip, so
    zips below 10000 find no city."""
    geo = dim_geolocation if dim_geolocation is not None else dims.geolocation_first_rows(src)
    return _city_revenue(facts.order_rollup(src), geo, F.col("geolocation_key").cast("string"))


def mart_city_revenue_padded(src: Src, dim_geolocation: DataFrame | None = None) -> DataFrame:
    """Corrected: both sides zero-padded to five characters."""
    geo = dim_geolocation if dim_geolocation is not None else dims.geolocation_first_rows(src)
    return _city_revenue(facts.order_rollup(src), geo, zfill(F.col("geolocation_key")))


# --- the same marts from written tables (what the refresh publishes) ---------

def mart_sales_daily_from_rollup(rollup: DataFrame) -> DataFrame:
    return conform(_sales_daily(rollup), "mart_sales_daily")


def mart_sales_daily_from_fact(fact: DataFrame) -> DataFrame:
    return mart_sales_daily_from_rollup(facts.rollup_of(fact))


def mart_product_performance_from_fact(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    return _product_performance(fact.withColumn("fanout", F.lit(1).cast("long")), dim_products)


def mart_city_revenue_from_rollup(rollup: DataFrame, dim_geolocation: DataFrame) -> DataFrame:
    return _city_revenue(rollup, dim_geolocation, F.col("geolocation_key").cast("string"))
