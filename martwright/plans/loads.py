"""Key and reference checks of orders and items that arrive in loads, each against the loads before it.

Loads are two-year spans. An order arrives in the load of its purchase; those of priority 5-LOW come one load
late, and those of priority 1-URGENT are sent again with the next load. An item arrives in the load of its shipping
limit. The checks (``operators.keyruns``) read a load and the keys kept so far, no loaded table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyruns import KeyRuns
from ..session import scratch_path, width_for
from ..sources.fixtures import Sources

LATE_PRIORITY, RESENT_PRIORITY = "5-LOW", "1-URGENT"
LOAD_YEARS = 2


def _span(day: str) -> F.Column:
    return F.floor(F.year(day) / LOAD_YEARS).cast("int")


def order_arrivals(src: Sources) -> DataFrame:
    """(order_id, load): late ones once, later; resent ones twice."""
    o = src.driver("orders").select(F.col("o_orderkey").cast("string").alias("order_id"), "o_orderpriority", _span("o_orderdate").alias("span"))
    first = o.select("order_id", (F.col("span") + F.when(F.col("o_orderpriority") == LATE_PRIORITY, 1).otherwise(0)).alias("load"))
    again = o.where(F.col("o_orderpriority") == RESENT_PRIORITY).select("order_id", (F.col("span") + 1).alias("load"))
    return first.unionByName(again)


def load_checks(spark: SparkSession, src: Sources) -> DataFrame:
    """Per load: the key of its orders, then (its orders added) the references of its items."""
    arrivals = order_arrivals(src)
    items = src["order_items"].select("order_id", _span("shipping_limit_date").alias("load"))
    loads = sorted({r[0] for df in (arrivals, items) for r in df.select("load").distinct().collect() if r[0] is not None})   # one per span
    with width_for(spark, [arrivals, items]) as width:
        return _checked(spark, arrivals, items, loads, width)


def _checked(spark: SparkSession, arrivals: DataFrame, items: DataFrame, loads: list[int], buckets: int) -> DataFrame:
    runs = KeyRuns.create(spark, scratch_path(spark, "order-keys"), "order_id string", buckets=buckets)
    parts = []
    for load in loads:
        orders, sent = arrivals.where(F.col("load") == load).select("order_id"), items.where(F.col("load") == load)
        keys = runs.key_check(orders)
        parts.append(keys.select(F.lit(load).alias("load"), F.lit("orders.order_id").alias("check_name"), "n_rows", "n_null_keys", "n_duplicate_keys",
                                 "n_known_keys", F.lit(0).cast("long").alias("n_dangling")))
        runs = runs.add(orders)
        refs = runs.reference_check(sent, ["order_id"])
        zero = F.lit(0).cast("long")
        parts.append(refs.select(F.lit(load).alias("load"), F.lit("order_items.order_id").alias("check_name"), F.col("child_rows").alias("n_rows"),
                                 zero.alias("n_null_keys"), zero.alias("n_duplicate_keys"), zero.alias("n_known_keys"),
                                 F.col("dangling_rows").alias("n_dangling")))
    if not parts:
        return spark.createDataFrame([], "load int, check_name string, n_rows long, n_null_keys long, n_duplicate_keys long, n_known_keys long, n_dangling long")
    return reduce(DataFrame.unionByName, parts).where("n_rows > 0")
