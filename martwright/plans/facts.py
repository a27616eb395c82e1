"""Order fact at its declared grain and the compact frames the marts use.

The fact joins orders -> items -> payments on ``order_id`` with left joins, so
an order with i items and p payments gives max(1,i)*max(1,p) rows (payments fan
out over items). Every mart and report measure that does not read a payment
column sees each item row ``fanout = max(1, p)`` times. Instead of
materialising the fan-out, the marts read

* ``item_grain``  : one row per fact item (item-less orders excluded) + ``fanout``;
* ``order_rollup``: one row per order, items and payments pre-aggregated per
  ``order_id`` before the join shuffle, measures already multiplied.

Both give exactly the sums/counts of the fan-out (decimal arithmetic), never
emit item x payment pairs, and keep everything partitioned by ``order_id``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cleaning import day_diff, fill_int, money, zfill
from ..operators.keys import rank_values
from ..session import scratch_path
from ..sources.schemas import FACT_COLUMNS

Src = Mapping[str, DataFrame]

ORDER_DATE_SOURCE = "order_purchase_timestamp"

# Rows of one side in a cell of the fan-out grid (at most GRID_SIDE squared
# pairs are made by one task, whatever the order).
GRID_SIDE = 2_000
# Rows of a key that are numbered by one task (a power of two).
PIECE_ROWS = 1 << 13


def _orders_with_zip(src: Src, with_zip: bool = True) -> DataFrame:
    """Orders with the customer's zip. Joined at order grain, before the
    fan-out, so only orders (not fact rows) are shuffled by customer.

    ``with_zip=False`` skips the join for jobs that read no customer column:
    with ``customer_id`` the customers' declared key (checked by
    ``dq_primary_keys`` and the pipeline gates) the left join neither adds
    nor removes order rows, so it would only cost a shuffle of all orders."""
    if not with_zip:
        return src["orders"]
    c = src["customers"].select("customer_id", "customer_zip_code_prefix")
    return src["orders"].join(c, "customer_id", "left")


def _payment_counts(src: Src) -> DataFrame:
    return src["payments"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n_payments"))


def _fanout() -> F.Column:
    return F.greatest(F.coalesce(F.col("n_payments"), F.lit(0)), F.lit(1)).cast("long")


def payment_type_codes(src: Src) -> DataFrame:
    """(payment_type, code): dense code of the raw-case type over the types
    that reach the fact (payments whose order exists), sorted."""
    pays = src["payments"].select("order_id", "payment_type")
    reaching = pays.join(src["orders"].select("order_id"), "order_id", "left_semi")
    values = reaching.select("payment_type").where(F.col("payment_type").isNotNull()).distinct()
    return rank_values(values, "payment_type", "code")


def _common_columns(df: DataFrame) -> dict[str, F.Column]:
    geo = (F.col("customer_zip_code_prefix") if "customer_zip_code_prefix" in df.columns
           else F.lit("unknown"))
    purchase = F.col(ORDER_DATE_SOURCE).cast("timestamp_ntz")
    return {
        "order_id": F.col("order_id"),
        "customer_key": F.col("customer_id"),
        "product_key": F.col("product_id"),
        "seller_key": F.col("seller_id"),
        "geolocation_key": geo,
        "order_date_key": F.to_date(purchase),
        "order_status": F.lower("order_status"),
        "price": F.col("price"),
        "freight_value": F.col("freight_value"),
        "total_amount": F.col("price") + F.col("freight_value"),
        "delivery_time": day_diff(purchase, F.col("order_delivered_customer_date")),
        "estimated_delivery_time": day_diff(purchase, F.col("order_estimated_delivery_date")),
    }


def _written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` as a scratch table: a lost task reads the same rows again, and the planner knows its size."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def number_rows(rows: DataFrame, key: str, piece: int = PIECE_ROWS) -> DataFrame:
    """``_mw_pos``: 0, 1, 2, ... within each ``key``, however many rows it has, identical ones included.

    Two levels of prefix sums: rows are numbered within (key, piece), where a piece is up to ``piece`` neighbouring rows
    of an input partition, the numbers are written, and a key's pieces are offset by the rows of those before.
    No task sees more of a key than a piece, or one row per piece.
    """
    spark, at = rows.sparkSession, F.monotonically_increasing_id()
    # a partition's ids start at a multiple of 2 ** 33, so pieces never span partitions
    dealt = rows.withColumn("_mw_at", at).withColumn("_mw_piece", F.shiftright("_mw_at", piece.bit_length() - 1))
    local = F.row_number().over(Window.partitionBy(key, "_mw_piece").orderBy("_mw_at"))
    numbered = _written(spark, dealt.withColumn("_mw_local", local).drop("_mw_at"), "numbered")
    before = Window.partitionBy(key).orderBy("_mw_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy(key, "_mw_piece").agg(F.count(F.lit(1)).alias("_mw_n")).select(
        key, "_mw_piece", F.coalesce(F.sum("_mw_n").over(before), F.lit(0)).alias("_mw_before"))
    return numbered.join(offsets, [key, "_mw_piece"]).select(
        *rows.columns, (F.col("_mw_before") + F.col("_mw_local") - 1).alias("_mw_pos"))


def _cells(rows: DataFrame, own: str, other_side: DataFrame, other: str, side: int) -> DataFrame:
    """Deal an order's rows into cells of ``side`` rows (``own``) and repeat
    each once per cell of the other side (``other``)."""
    count = other_side.groupBy("order_id").agg(F.count(F.lit(1)).alias("_mw_n"))
    cells = F.ceil(F.coalesce(F.col("_mw_n"), F.lit(1)) / F.lit(side)).cast("long")
    return (number_rows(rows, "order_id").withColumn(own, F.floor(F.col("_mw_pos") / F.lit(side)).cast("long")).drop("_mw_pos")
            .join(count, "order_id", "left")
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), cells - 1))).drop("_mw_n"))


def crowded_orders(items: DataFrame, payments: DataFrame, side: int) -> DataFrame:
    """Orders with over ``side`` items or payments (written: one row per such order)."""
    found = [df.groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > side).select("order_id")
             for df in (items, payments)]
    return _written(items.sparkSession, found[0].unionByName(found[1]).where("order_id IS NOT NULL").distinct(), "crowded-orders")


def fan_out(orders: DataFrame, items: DataFrame, payments: DataFrame, side: int = GRID_SIDE) -> DataFrame:
    """``orders LEFT JOIN items LEFT JOIN payments`` on ``order_id``.

    An order with at most ``side`` items and ``side`` payments is joined as written. The pairs of any other form a grid:
    items are numbered (``number_rows``) into ``ceil(items / side)`` cells and repeated per payment cell,
    payments likewise, and the two meet on (order, item cell, payment cell), so its pairs spread over as many
    tasks as it has cells, from both sides. Every pair appears exactly once; each order takes one of the two
    ways by its own counts. Those orders without items join their payments directly.
    """
    columns = [*orders.columns, *[c for c in items.columns if c != "order_id"],
               *[c for c in payments.columns if c != "order_id"]]

    def plain(o: DataFrame, i: DataFrame, p: DataFrame) -> DataFrame:
        return o.join(i, "order_id", "left").join(p, "order_id", "left").select(*columns)

    crowded = crowded_orders(items, payments, side)
    if crowded.isEmpty():
        return plain(orders, items, payments)
    rest = plain(*[df.join(crowded, "order_id", "left_anti") for df in (orders, items, payments)])
    o, i, p = (df.join(crowded, "order_id", "left_semi") for df in (orders, items, payments))
    left = o.join(_cells(i, "_mw_i", p, "_mw_p", side), "order_id")
    paired = left.join(_cells(p, "_mw_p", i, "_mw_i", side), ["order_id", "_mw_i", "_mw_p"], "left")
    bare = o.join(i.select("order_id"), "order_id", "left_anti").join(p, "order_id", "left")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in items.schema.fields if f.name != "order_id"]
    return (rest.unionByName(paired.select(*columns))
            .unionByName(bare.select("*", *empty).select(*columns)))


def fact_orders(src: Src, side: int = GRID_SIDE) -> DataFrame:
    """The fact as declared: 14 columns at item x payment grain."""
    df = fan_out(_orders_with_zip(src), src["order_items"], src["payments"], side)
    df = df.join(payment_type_codes(src), "payment_type", "left")
    cols = _common_columns(df)
    cols["payment_key"] = F.coalesce(F.col("code"), F.lit(0)).cast("int")
    cols["payment_value"] = F.col("payment_value")
    return df.select(*[cols[c].alias(c) for c in FACT_COLUMNS])


ITEM_GRAIN_COLUMNS = ["order_id", "order_item_id", "customer_key", "product_key", "seller_key", "geolocation_key",
                      "order_date_key", "order_status", "price", "freight_value", "total_amount", "delivery_time",
                      "estimated_delivery_time"]


def fact_order_items(src: Src) -> DataFrame:
    """Corrected grain: one row per order item (item-less orders once), no
    payment fan-out."""
    df = _orders_with_zip(src).join(src["order_items"], "order_id", "left")
    cols = _common_columns(df)
    cols["order_item_id"] = F.col("order_item_id")
    return df.select(*[cols[c].alias(c) for c in ITEM_GRAIN_COLUMNS])


def item_grain(src: Src, with_fanout: bool = True) -> DataFrame:
    """Fact rows that carry an item, one per item, with ``fanout`` = number
    of fact rows each stands for (1 everywhere when ``with_fanout`` is False).

    Items drive the joins (many-to-one onto orders and payment counts, both
    unique per order), so a hot order's items sit on the splittable side of
    every join and AQE can spread them over several tasks.
    """
    df = src["order_items"].join(_orders_with_zip(src, with_zip=False), "order_id", "inner")
    if with_fanout:
        df = df.join(_payment_counts(src), "order_id", "left")
    cols = _common_columns(df)
    return df.select(*[cols[c].alias(c) for c in ["order_id", "product_key", "order_date_key", "order_status",
                                                    "price", "total_amount"]],
                     (_fanout() if with_fanout else F.lit(1).cast("long")).alias("fanout"))


def order_rollup(src: Src, with_fanout: bool = True, with_zip: bool = True) -> DataFrame:
    """One row per order: revenue (decimal, fan-out applied) and the number of
    fact rows the order produces. Items and payments are aggregated per
    order before joining, so a hot order shuffles one row, not its items.
    ``with_zip=False``: no ``geolocation_key`` (and no customers join)."""
    items = src["order_items"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum(money(F.col("price") + F.col("freight_value"))).alias("amount"))
    df = _orders_with_zip(src, with_zip).join(items, "order_id", "left")
    if with_fanout:
        df = df.join(_payment_counts(src), "order_id", "left")
    fan = _fanout() if with_fanout else F.lit(1).cast("long")
    cols = _common_columns(df)
    rows = F.greatest(F.coalesce(F.col("n_items"), F.lit(0)), F.lit(1)).cast("long") * fan
    return df.select(cols["order_id"].alias("order_id"), cols["order_date_key"].alias("order_date_key"),
                     cols["order_status"].alias("order_status"), cols["geolocation_key"].alias("geolocation_key"),
                     (F.col("amount") * fan).alias("revenue"), rows.alias("fact_rows"))


def rollup_of(fact: DataFrame) -> DataFrame:
    """``order_rollup`` from fact rows: one row per order with its revenue and
    number of fact rows, what the daily and city marts read."""
    return fact.groupBy("order_id", "order_date_key", "order_status", "geolocation_key").agg(
        F.sum(money("total_amount")).alias("revenue"), F.count(F.lit(1)).alias("fact_rows"))


def fact_orders_surrogate_keys(src: Src, dim_customers: DataFrame, dim_products: DataFrame,
                               dim_sellers: DataFrame, dim_geolocation: DataFrame,
                               dim_payments: DataFrame) -> DataFrame:
    """The fact with dimension surrogate keys instead of natural ids.

    The ``dim_*`` arguments need only their natural and surrogate key columns
    (the written dimensions, or the key maps of ``dims``).

    Each key is attached at its own source's grain before the fan-out join:
    customer and geolocation keys on orders, product and seller keys on items,
    the payment key on payments (matched on lower-cased type and whole
    installments, the dimension's natural key).
    """
    cust = dim_customers.select("customer_id", F.col("customer_key").alias("_ck"))
    geo = dim_geolocation.select(F.col("geolocation_zip_code_prefix").alias("_zip"),
                                 F.col("geolocation_key").alias("_gk"))
    o = (src["orders"].join(src["customers"].select("customer_id", "customer_zip_code_prefix"), "customer_id", "left")
         .join(cust, "customer_id", "left"))
    o = o.join(geo, zfill(o["customer_zip_code_prefix"]) == geo["_zip"], "left")
    prod = dim_products.select("product_id", F.col("product_key").alias("_pk"))
    sell = dim_sellers.select("seller_id", F.col("seller_key").alias("_sk"))
    items = src["order_items"].join(prod, "product_id", "left").join(sell, "seller_id", "left")
    pdim = dim_payments.select(F.col("payment_type").alias("_pt"), F.col("payment_installments").alias("_pi"),
                               F.col("payment_key").alias("_yk"))
    pays = src["payments"]
    pays = pays.join(pdim, (F.lower(pays["payment_type"]) == pdim["_pt"])
                     & (fill_int(pays["payment_installments"], 1) == pdim["_pi"]), "left")
    df = fan_out(o, items, pays)
    cols = _common_columns(df)
    cols.update({"customer_key": F.col("_ck"), "product_key": F.col("_pk"), "seller_key": F.col("_sk"),
                 "geolocation_key": F.col("_gk"), "payment_key": F.col("_yk"),
                 "payment_value": F.col("payment_value")})
    return df.select(*[cols[c].alias(c) for c in FACT_COLUMNS])
