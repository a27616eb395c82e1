"""Sets of orders per day, product and city, stored with the marts, and the order counts that roll up from them.

The marts' order counts are COUNT(DISTINCT order_id): those of a month, a category, a state or everything do not follow
from them (an order has items of several products). The refresh stores a bitmap of orders (``operators.bitmaps``) for each
day, product and city, made from the written fact and rollup; every coarser count is then read off the bitmaps alone.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bitmaps

ORDER_NUMBERS = "order_numbers"
ORDERS_OF_DAY, ORDERS_OF_PRODUCT, ORDERS_OF_CITY = "orders_of_day", "orders_of_product", "orders_of_city"
CITY = ["geolocation_city", "geolocation_state"]


def order_numbers(rollup: DataFrame) -> DataFrame:
    """(order_id, order_no): orders numbered by their day, so that a day's bits lie side by side."""
    return bitmaps.number_keys(rollup, "order_id", [F.min("order_date_key")], "order_no")


def orders_of_day(rollup: DataFrame, numbers: DataFrame) -> DataFrame:
    return bitmaps.build(rollup.select("order_id", "order_date_key").join(numbers, "order_id"), ["order_date_key"], "order_no")


def orders_of_product(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    """Fact rows are reduced to (product, order) before they meet the numbers: their fan-out is not joined."""
    pairs = fact.where("product_key IS NOT NULL").select("product_key", "order_id").distinct()
    return bitmaps.build(pairs.join(numbers, "order_id"), ["product_key"], "order_no")


def orders_of_city(rollup: DataFrame, numbers: DataFrame, geo: DataFrame) -> DataFrame:
    """Orders per city as the city mart matches them (raw zip text against the dimension's)."""
    g = geo.select("geolocation_zip_code_prefix", *CITY)
    placed = rollup.join(g, F.col("geolocation_key").cast("string") == g["geolocation_zip_code_prefix"])
    return bitmaps.build(placed.select("order_id", *CITY).join(numbers, "order_id"), CITY, "order_no")


def _level(dimension: str, level: str, counted: DataFrame, name: F.Column) -> DataFrame:
    return counted.select(F.lit(dimension).alias("dimension"), F.lit(level).alias("level"), name.cast("string").alias("group_name"), "order_count")


def order_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(dimension, level, group_name, order_count): day -> month -> all, product -> category -> all, city -> state -> all.

    Reads the stored bitmaps and, for categories, ``dim_products``; neither the fact nor the rollup."""
    def counts(dimension: str, finest: DataFrame, levels: Mapping[str, tuple[list[str], F.Column]], own: str) -> list[DataFrame]:
        # the finest level is stored as it is counted; the others are merged from it
        return [_level(dimension, level, (bitmaps.cardinality if level == own else bitmaps.count_distinct)(finest, groups, "order_count"), name)
                for level, (groups, name) in levels.items()]

    everything = ([], F.lit("all"))
    day = tables[ORDERS_OF_DAY].withColumn("month", F.date_format("order_date_key", "yyyy-MM"))
    categories = tables["dim_products"].select(F.col("product_id").alias("product_key"), F.col("product_category_name_english").alias("category"))
    product = tables[ORDERS_OF_PRODUCT].join(categories, "product_key")
    return reduce(DataFrame.unionByName, [
        *counts("date", day, {"day": (["order_date_key"], F.col("order_date_key")), "month": (["month"], F.col("month")), "all": everything}, "day"),
        *counts("product", product, {"product": (["product_key"], F.col("product_key")), "category": (["category"], F.col("category")),
                                     "all": everything}, "product"),
        *counts("place", tables[ORDERS_OF_CITY], {"city": (CITY, F.concat_ws(", ", *CITY)),
                                                  "state": (["geolocation_state"], F.col("geolocation_state")), "all": everything}, "city")])
