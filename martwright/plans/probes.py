"""Operator probes: each key operator applied to a whole source table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import title_case
from ..operators.keys import category_code, dense_key, keep_first, numeric_id_order, stable_key

Src = Mapping[str, DataFrame]


def payment_type_codes(src: Src) -> DataFrame:
    """Every payment row with the category code of its raw-case type."""
    p = src["payments"].select("order_id", "payment_sequential", "payment_type")
    return category_code(p, "payment_type", "payment_code")


def item_positions(src: Src) -> DataFrame:
    """Every order item with its 1-based position in item order (order id as
    a number, item number, then the remaining columns as tie-breaks)."""
    items = src["order_items"]
    order = [*numeric_id_order("order_id"), F.col("order_item_id").asc_nulls_last(),
             *numeric_id_order("product_id"), *numeric_id_order("seller_id"),
             F.col("shipping_limit_date").asc_nulls_last(), F.col("price").asc_nulls_last(),
             F.col("freight_value").asc_nulls_last()]
    return dense_key(items, order, "item_key")


def payment_positions(src: Src) -> DataFrame:
    """Every payment numbered by its type alone (a handful of values hold all
    rows): per type its rows, the positions they take and the sum of their
    positions, which shows each position taken once."""
    keyed = stable_key(src["payments"].select("payment_type", "payment_value"), [F.col("payment_type").asc_nulls_last()], "position")
    return keyed.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("position").alias("first_position"), F.max("position").alias("last_position"),
        F.sum(F.col("position").cast("decimal(38,0)")).alias("position_sum"))


def first_payment_per_order(src: Src) -> DataFrame:
    return keep_first(src["payments"], ["order_id"], ["payment_sequential"])


def title_case_cities(src: Src) -> DataFrame:
    cities = [src["geolocation"].select(F.col("geolocation_city").alias("city")),
              src["customers"].select(F.col("customer_city").alias("city")),
              src["sellers"].select(F.col("seller_city").alias("city"))]
    distinct = reduce(DataFrame.unionByName, cities).distinct()
    return distinct.select("city", title_case("city").alias("city_title"))
