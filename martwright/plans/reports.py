"""BI reports over the fact and the marts.

Fact-level reports aggregate the compact fact frames (see ``facts``) first and
join dimensions at the reduced grain: a day, a product or a zip, never a fact
row. Revenue sums of the double ``total_amount`` are exact decimals (a double
sum would depend on the order rows arrive in).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import zfill
from . import dims, facts

Src = Mapping[str, DataFrame]
TOTAL = "decimal(38,2)"
TOP_K = 20


def report_revenue_by_month(src: Src, dim_dates: DataFrame | None = None) -> DataFrame:
    cal = dim_dates if dim_dates is not None else dims.dim_dates_covering(src["orders"], "order_purchase_timestamp")
    return revenue_by_month(facts.order_rollup(src, with_zip=False), cal)


def revenue_by_month(rollup: DataFrame, cal: DataFrame) -> DataFrame:
    per_day = rollup.groupBy("order_date_key").agg(F.sum("revenue").alias("revenue"))
    j = per_day.join(cal.select("date_key", "month"), per_day["order_date_key"] == cal["date_key"])
    return (j.groupBy("month").agg(F.sum("revenue").cast(TOTAL).alias("total_revenue"))
            .orderBy(F.col("month").asc_nulls_last()))


def report_orders_by_status(src: Src) -> DataFrame:
    return orders_by_status(facts.order_rollup(src, with_zip=False))


def orders_by_status(rollup: DataFrame) -> DataFrame:
    return (rollup.groupBy("order_status")
            .agg(F.sum("fact_rows").cast("long").alias("order_count"))
            .orderBy(F.col("order_count").desc_nulls_first(), "order_status"))


def report_units_by_category(src: Src, dim_products: DataFrame | None = None) -> DataFrame:
    return units_by_category(facts.item_grain(src),
                             dim_products if dim_products is not None else dims.product_attributes(src))


def units_by_category(items: DataFrame, p: DataFrame) -> DataFrame:
    per_product = (items.where(F.col("product_key").isNotNull())
                   .groupBy("product_key").agg(F.sum("fanout").alias("units")))
    j = per_product.join(p.select("product_id", "product_category_name"),
                         per_product["product_key"] == p["product_id"])
    return (j.groupBy("product_category_name").agg(F.sum("units").cast("long").alias("total_sold"))
            .orderBy(F.col("total_sold").desc_nulls_first(), "product_category_name"))


def revenue_by_city(rollup: DataFrame, geo: DataFrame, on_zip: bool) -> DataFrame:
    per_zip = rollup.groupBy("geolocation_key").agg(F.sum("revenue").alias("revenue"))
    if on_zip:
        g = geo.select("geolocation_zip_code_prefix", "geolocation_city")
        cond = zfill(per_zip["geolocation_key"]) == g["geolocation_zip_code_prefix"]
    else:
        g = geo.select("geolocation_city", F.col("geolocation_key").alias("g_key"))
        cond = per_zip["geolocation_key"] == g["g_key"]
    return (per_zip.join(g, cond).groupBy("geolocation_city")
            .agg(F.sum("revenue").cast(TOTAL).alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc_nulls_first(), "geolocation_city"))


def report_revenue_by_city(src: Src, dim_geolocation: DataFrame | None = None) -> DataFrame:
    """As written: the fact's zip compared with the dimension's row number."""
    geo = dim_geolocation if dim_geolocation is not None else dims.dim_geolocation(src)
    return revenue_by_city(facts.order_rollup(src), geo, on_zip=False)


def report_revenue_by_city_zip(src: Src, dim_geolocation: DataFrame | None = None) -> DataFrame:
    """Corrected: joined on the zero-padded zip."""
    geo = dim_geolocation if dim_geolocation is not None else dims.geolocation_first_rows(src)
    return revenue_by_city(facts.order_rollup(src), geo, on_zip=True)


# --- mart reports --------------------------------------------------------------

def report_sales_daily(mart_sales_daily: DataFrame) -> DataFrame:
    return mart_sales_daily.select("order_date", "order_count", "total_revenue", "average_order_value") \
        .orderBy(F.col("order_date").asc_nulls_last())


def report_top20_products(mart_product_performance: DataFrame) -> DataFrame:
    return (mart_product_performance
            .select("product_id", "product_category_name_english", "total_quantity", "total_revenue")
            .orderBy(F.col("total_revenue").desc_nulls_first(), F.col("product_id").asc_nulls_last())
            .limit(TOP_K))


def report_top20_cities(mart_city_revenue: DataFrame) -> DataFrame:
    return (mart_city_revenue
            .select("geolocation_city", "geolocation_state", "order_count", "total_revenue")
            .orderBy(F.col("total_revenue").desc_nulls_first(), F.col("geolocation_city").asc_nulls_last(),
                     F.col("geolocation_state").asc_nulls_last())
            .limit(TOP_K))


def report_total_revenue_all_days(mart_sales_daily: DataFrame) -> DataFrame:
    return mart_sales_daily.agg(F.sum("total_revenue").cast(TOTAL).alias("total_revenue_all_days"))


def report_total_orders_all_days(mart_sales_daily: DataFrame) -> DataFrame:
    return mart_sales_daily.agg(F.sum("order_count").cast("long").alias("total_orders_all_days"))

