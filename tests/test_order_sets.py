"""Bitmaps of keys (merge, loads, groups that hold all keys) and the order counts that roll up from them."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martwright import registry
from martwright.operators import bitmaps
from martwright.plans import order_sets, pipeline
from martwright.operators import publish


def _exact(df, groups):
    agg = F.count_distinct("k").alias("n")
    return sorted(map(tuple, (df.groupBy(*groups).agg(agg) if groups else df.agg(agg)).collect()), key=str)


def _got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_counts_equal_count_distinct_at_every_level(spark):
    # one group holds a third of all rows, keys lie in several groups, with null groups, null keys and repeats
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 97 == 0, None).otherwise(F.concat(F.lit("g"), F.col("id") % 20)).alias("g"),
        F.when(F.col("id") % 50 == 7, None).otherwise(F.concat(F.lit("k"), F.col("id") * 31 % 1700)).alias("k"))
    rows = rows.withColumn("top", F.substring("g", 1, 2))
    numbers = bitmaps.number_keys(rows, "k", [], "no")
    got = [r.no for r in numbers.orderBy("no").collect()]
    assert got == list(range(rows.select("k").dropna().distinct().count()))
    stored = bitmaps.build(rows.join(numbers, "k"), ["top", "g"], "no")
    assert _got(bitmaps.cardinality(stored, ["top", "g"])) == _exact(rows.dropna(subset=["k"]), ["top", "g"])
    for groups in (["top"], ["g"], []):
        assert _got(bitmaps.count_distinct(stored, groups)) == _exact(rows.dropna(subset=["k"]), groups)
    # all 64 bits of a word, the sign bit too
    assert stored.where("word = 0").agg(F.bit_or("bits")).first()[0] == -1


def test_a_later_load_is_merged(spark):
    first = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y")], "g string, k string")
    later = spark.createDataFrame([("a", "y"), ("b", "z"), ("c", "z"), ("c", "w")], "g string, k string")
    known = bitmaps.number_keys(first, "k", [], "no")
    new = bitmaps.number_keys(later, "k", [], "no", known=known)
    assert {r.k: r.no for r in known.unionByName(new).collect()} == {"x": 0, "y": 1, "w": 2, "z": 3}
    numbers = known.unionByName(new)
    both = bitmaps.build(first.join(known, "k"), ["g"], "no").unionByName(bitmaps.build(later.join(numbers, "k"), ["g"], "no"))
    assert _got(bitmaps.count_distinct(both, ["g"])) == [("a", 2), ("b", 2), ("c", 2)]
    assert _got(bitmaps.count_distinct(both, [])) == [(4,)]


def test_empty(spark):
    none = spark.createDataFrame([], "g string, k string")
    numbers = bitmaps.number_keys(none, "k", [], "no")
    stored = bitmaps.build(none.join(numbers, "k"), ["g"], "no")
    assert numbers.count() == 0 and _got(bitmaps.count_distinct(stored, ["g"])) == [] and _got(bitmaps.count_distinct(stored, [])) == [(0,)]
    known = bitmaps.number_keys(spark.createDataFrame([("a", "x")], "g string, k string"), "k", [], "no", known=numbers)
    assert [tuple(r) for r in known.collect()] == [("x", 0)]


def test_bits_of_a_day_lie_side_by_side(spark):
    rollup = spark.range(1280).select(F.col("id").cast("string").alias("order_id"),
                                      F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 10).cast("int")).alias("order_date_key"))
    days = order_sets.orders_of_day(rollup, order_sets.order_numbers(rollup))
    assert days.count() == 20                               # 128 orders a day: two words of 64


@pytest.fixture(scope="module")
def root(spark):
    return registry.built_warehouse(spark, SF_SMALL)


def test_levels_read_the_sets_alone(spark, root):
    counts = pipeline.order_counts(spark, root)
    one, files = publish.Snapshot(spark, root), counts.inputFiles()
    read = {t for t in one if any(f"/{one.tables[t]}/" in f for f in files)}
    assert read == {order_sets.ORDERS_OF_DAY, order_sets.ORDERS_OF_PRODUCT, order_sets.ORDERS_OF_CITY, "dim_products"}
    # one refresh publishes them with the marts
    assert {order_sets.ORDERS_OF_DAY, order_sets.ORDERS_OF_PRODUCT, order_sets.ORDERS_OF_CITY} <= set(one)
    got = {(r.dimension, r.level): r.order_count for r in counts.where("level = 'all'").collect()}
    fact = one["fact_orders"]
    assert got["date", "all"] == fact.select("order_id").distinct().count()
    # the finest counts are the marts' own
    daily = {str(r.order_date): r.order_count for r in one["mart_sales_daily"].collect()}
    assert {r.group_name: r.order_count for r in counts.where("level = 'day'").collect()} == daily
    product = {r.product_id: r.order_count for r in one["mart_product_performance"].collect()}
    assert {r.group_name: r.order_count for r in counts.where("level = 'product'").collect()} == product
    assert sum(product.values()) > got["product", "all"]    # what adding up the mart would have given
