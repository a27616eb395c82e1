"""Six dimension builders (staging frames -> conformed dimensions).

``src`` is any mapping ``source name -> DataFrame`` (fixture frames, staged
parquet tables or a JDBC read). ``run_date`` replaces the wall clock so a
rebuild is repeatable.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import fill_int, is_weekend, run_date_lit, title_case, zfill
from ..operators.keys import dense_key, keep_first, keep_first_with_position, numeric_id_order
from ..sources.schemas import SRC_POS

Src = Mapping[str, DataFrame]

# Fixed values (must equal the original pipeline's): default calendar range,
# validity horizon of a dimension row in days, label for an untranslated
# category, measurement columns filled with zero, day/month name patterns.
DEFAULT_CALENDAR = ("2016-01-01", "2025-12-31")
SCD_HORIZON_DAYS = 3650
UNKNOWN_CATEGORY = "Unknown"
ZERO_FILLED = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
DAY_NAME, MONTH_NAME = "EEEE", "MMMM"


def _place_columns(df: DataFrame, zip_col: str, city_col: str, state_col: str) -> list:
    out = []
    for c in df.columns:
        if c == zip_col:
            out.append(zfill(c).alias(c))
        elif c == city_col:
            out.append(title_case(c).alias(c))
        elif c == state_col:
            out.append(F.upper(c).alias(c))
        else:
            out.append(F.col(c))
    return out


def dim_customers(src: Src, run_date: _dt.date | str | None = None) -> DataFrame:
    c = src["customers"]
    c = c.withColumn("customer_unique_id", F.col("customer_unique_id").cast("string"))
    cols = _place_columns(c, "customer_zip_code_prefix", "customer_city", "customer_state")
    out = dense_key(c.select(*cols), numeric_id_order("customer_id"), "customer_key")
    today = run_date_lit(run_date)
    return out.withColumns({
        "effective_date": today,
        "end_date": F.date_add(today, SCD_HORIZON_DAYS),
        "is_current": F.lit(True),
    })


def product_attributes(src: Src) -> DataFrame:
    """Products with the English category name and filled measurements (the
    dimension without its positional key)."""
    p = src["products"]
    tr = src["product_category_name_translation"]
    joined = p.join(tr, p["product_category_name"] == tr["product_category_name"], "left")
    cols = [F.coalesce(p[c], F.lit(0).cast(p.schema[c].dataType)).alias(c) if c in ZERO_FILLED else p[c]
            for c in p.columns]
    cols.append(F.coalesce(tr["product_category_name_english"], F.lit(UNKNOWN_CATEGORY))
                .alias("product_category_name_english"))
    return joined.select(*cols)


def dim_products(src: Src, run_date: _dt.date | str | None = None) -> DataFrame:
    out = dense_key(product_attributes(src), numeric_id_order("product_id"), "product_key")
    return out.withColumn("last_updated", run_date_lit(run_date))


def dim_sellers(src: Src, run_date: _dt.date | str | None = None) -> DataFrame:
    s = src["sellers"]
    out = s.select(*_place_columns(s, "seller_zip_code_prefix", "seller_city", "seller_state"))
    out = dense_key(out, numeric_id_order("seller_id"), "seller_key")
    return out.withColumn("last_updated", run_date_lit(run_date))


def _clean_geolocation(src: Src) -> DataFrame:
    g = src["geolocation"]
    return g.select(*_place_columns(g, "geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"))


def geolocation_first_rows(src: Src) -> DataFrame:
    """One row per padded zip, the first in ingest order (the dimension
    without its key): a single map-side aggregate."""
    return keep_first(_clean_geolocation(src), ["geolocation_zip_code_prefix"], [SRC_POS]).drop(SRC_POS)


def dim_geolocation(src: Src) -> DataFrame:
    """One row per padded zip: the first in ingest order. The key is the
    position of the kept row in the whole source (so it has gaps)."""
    kept = keep_first_with_position(_clean_geolocation(src), ["geolocation_zip_code_prefix"], [F.col(SRC_POS)],
                                    "geolocation_key")
    return kept.drop(SRC_POS)


def dim_payments(src: Src) -> DataFrame:
    """One row per (lower-cased type, installments): the first in row order
    (order id as a number, then sequence); key = that row's position."""
    p = src["payments"]
    p = p.select("order_id", "payment_sequential", F.lower("payment_type").alias("payment_type"),
                 fill_int("payment_installments", 1).alias("payment_installments"), "payment_value")
    order = [F.expr("try_cast(order_id AS BIGINT)"), F.col("order_id"), F.col("payment_sequential")]
    return keep_first_with_position(p, ["payment_type", "payment_installments"], order, "payment_key")


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes for a single ``date_key`` column."""
    d = F.col("date_key")
    return days.select(
        d,
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, DAY_NAME).alias("day_name"),
        F.date_format(d, MONTH_NAME).alias("month_name"),
        is_weekend(d).alias("is_weekend"))


def dim_dates(spark: SparkSession, start: str = DEFAULT_CALENDAR[0], end: str = DEFAULT_CALENDAR[1]) -> DataFrame:
    """Inclusive daily calendar between two dates (default 2016..2025)."""
    span = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))
                                 .alias("date_key"))
    return calendar(span)


def dim_dates_covering(dates: DataFrame, col: str) -> DataFrame:
    """Calendar over whole years spanning ``col`` of ``dates`` (the data's own
    range). The span is one global aggregate; the days are generated from it."""
    bounds = dates.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    span = bounds.select(F.explode(F.sequence(
        F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)))).alias("date_key"))
    return calendar(span)


# --- surrogate-key maps: (natural key, surrogate key) only -----------------
# The positional keys depend on the order columns alone, so the maps are the
# dimensions' keys without carrying (and checkpointing) every other column.

def customer_keys(src: Src) -> DataFrame:
    return dense_key(src["customers"].select("customer_id"), numeric_id_order("customer_id"), "customer_key")


def product_keys(src: Src) -> DataFrame:
    return dense_key(src["products"].select("product_id"), numeric_id_order("product_id"), "product_key")


def seller_keys(src: Src) -> DataFrame:
    return dense_key(src["sellers"].select("seller_id"), numeric_id_order("seller_id"), "seller_key")


def geolocation_keys(src: Src) -> DataFrame:
    g = src["geolocation"].select(zfill("geolocation_zip_code_prefix").alias("geolocation_zip_code_prefix"), SRC_POS)
    return keep_first_with_position(g, ["geolocation_zip_code_prefix"], [F.col(SRC_POS)],
                                    "geolocation_key").drop(SRC_POS)


def payment_keys(src: Src) -> DataFrame:
    p = src["payments"].select("order_id", "payment_sequential", F.lower("payment_type").alias("payment_type"),
                               fill_int("payment_installments", 1).alias("payment_installments"))
    order = [F.expr("try_cast(order_id AS BIGINT)"), F.col("order_id"), F.col("payment_sequential")]
    return keep_first_with_position(p, ["payment_type", "payment_installments"], order, "payment_key")
