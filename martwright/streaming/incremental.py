"""Incremental daily-sales refresh by months (see ``order_state`` for the one by deltas).

New and changed orders land as files in an inbox folder. A file-source stream
picks them up and ``foreachBatch`` does, per micro-batch:

1. find the months the batch touches (its own, and any an updated order moves
   out of) and record them under the epoch's id, *before* anything changes;
2. upsert the batch into the staged orders (partitioned by purchase month) by
   ``order_id``, rewriting only these months; of several versions of an order
   the one that arrived last wins (file time, file, row in the file);
3. recompute the mart rows of the recorded months from the staged tables and
   overwrite only those ``order_month`` partitions.

A replay after a stop at any point reads the recorded months, so a month that
an order has already left is refreshed all the same. Late items and payments
arrive through streams of their own: each micro-batch is one ``load`` partition
of the staged table (written again on replay), and the months of its orders are
refreshed.

Exact ``COUNT(DISTINCT order_id)`` is not available in a streaming
aggregation, so days are recomputed in batch form inside ``foreachBatch``;
the stream's checkpoint records which files were consumed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dml import (in_partitions, overwrite_partitions, replace_table, table_exists, touched_partitions,
                             upsert_partitions)
from ..plans import marts
from ..plans.pipeline import StagedSources, table_path
from ..session import scratch_path, shuffle_width, width_for
from ..sources.schemas import SOURCES
from . import order_state

MART = "mart_sales_daily"
LOOKBACK_DAYS = 365  # orders after (last order day - LOOKBACK_DAYS) arrive late
MART_INPUTS = ("order_items", "payments")
MONTH = "order_month"
SEQ = "_arrival"     # orders a batch's versions of one order
LOAD = "load"        # partition of a staged detail table: one per micro-batch
INITIAL = "initial"


def _mart_path(root: str) -> str:
    return table_path(root, MART)


def _month(c) -> F.Column:
    return F.trunc(c, "month")


def _with_month(orders: DataFrame) -> DataFrame:
    return orders.withColumn(MONTH, _month(F.col("order_purchase_timestamp")))


def stage_orders(orders: DataFrame, root: str) -> None:
    """Staged orders partitioned by purchase month."""
    replace_table(_with_month(orders), table_path(root, "stg_orders"), partition_by=(MONTH,))


def write_months(mart_rows: DataFrame, root: str, months: list[_dt.date] | None = None) -> None:
    """Overwrite the mart's ``order_month`` partitions for ``mart_rows``."""
    rows = mart_rows.withColumn(MONTH, _month(F.col("order_date")))
    overwrite_partitions(rows, _mart_path(root), MONTH, months)


def refresh_months(spark: SparkSession, root: str, months: list[_dt.date]) -> None:
    """Recompute the mart for ``months``. The staged orders are read with
    partition pruning, their items and payments by semi-joins on the touched
    order ids, which scan the staged items and payments (``order_state`` does without)."""
    st = StagedSources(spark, root)
    touched = st["orders"].where(in_partitions(MONTH, months)).drop(MONTH)
    ids = touched.select("order_id")
    view = {
        "orders": touched,
        "order_items": st["order_items"].join(ids, "order_id", "left_semi"),
        "payments": st["payments"].join(ids, "order_id", "left_semi"),
    }
    write_months(marts.mart_sales_daily(view), root, months)


def read_mart(spark: SparkSession, root: str) -> DataFrame:
    return marts.conform(spark.read.parquet(_mart_path(root)), MART)


def epoch_months(spark: SparkSession, root: str, stream: str, epoch: int, found: DataFrame) -> list[_dt.date]:
    """The months recorded for an epoch; ``found`` (one month column) is
    evaluated and recorded if there are none yet. Bounded by the months."""
    path = f"{root.rstrip('/')}/_epochs/{stream}/{epoch}"
    if not table_exists(spark, path):
        replace_table(found.toDF(MONTH).distinct().coalesce(1), path)
    return [r[0] for r in spark.read.parquet(path).collect()]


def process_batch(spark: SparkSession, root: str, batch: DataFrame, epoch: int) -> None:
    """Upsert one micro-batch of orders and refresh the months it touches.

    ``batch`` needs the arrival order ``SEQ``; without it two versions of one
    order could not be told apart."""
    if SEQ not in batch.columns:
        raise ValueError(f"a batch of orders needs the column {SEQ!r} (arrival order)")
    if batch.isEmpty():
        return
    path, rows = table_path(root, "stg_orders"), _with_month(batch)
    touched = touched_partitions(spark.read.parquet(path), rows, ["order_id"], MONTH)
    months = epoch_months(spark, root, "orders", epoch,
                          spark.createDataFrame([(m,) for m in touched], f"{MONTH} date"))
    upsert_partitions(spark, path, rows, ["order_id"], MONTH, SEQ)
    refresh_months(spark, root, months)


def stage_details(rows: DataFrame, root: str, name: str) -> None:
    """First load of staged items or payments."""
    replace_table(rows.withColumn(LOAD, F.lit(INITIAL)), table_path(root, f"stg_{name}"), partition_by=(LOAD,))


def process_details(spark: SparkSession, root: str, name: str, batch: DataFrame, epoch: int) -> None:
    """Append one micro-batch of items or payments and refresh the months of
    their orders; a replay overwrites the batch's own partition."""
    if batch.isEmpty():
        return
    (batch.withColumn(LOAD, F.lit(str(epoch))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(LOAD).parquet(table_path(root, f"stg_{name}")))
    orders = spark.read.parquet(table_path(root, "stg_orders"))
    months = orders.join(batch.select("order_id"), "order_id", "left_semi").select(MONTH)
    refresh_months(spark, root, epoch_months(spark, root, name, epoch, months))


def _arrivals(spark: SparkSession, name: str, inbox: str) -> DataFrame:
    return spark.readStream.schema(SOURCES[name].schema).parquet(inbox)


def start_stream(spark: SparkSession, root: str, inbox: str, checkpoint: str):
    arrival = F.struct(*[F.col(f"_metadata.{c}").alias(c) for c in ("file_modification_time", "file_path", "row_index")])
    return (_arrivals(spark, "orders", inbox).select("*", arrival.alias(SEQ)).writeStream
            .foreachBatch(lambda df, epoch: process_batch(spark, root, df, epoch))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def start_detail_stream(spark: SparkSession, root: str, name: str, inbox: str, checkpoint: str):
    return (_arrivals(spark, name, inbox).writeStream
            .foreachBatch(lambda df, epoch: process_details(spark, root, name, df, epoch))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def incremental_sales_daily(spark: SparkSession, src) -> DataFrame:
    """Older orders with their items and payments as the first load, the recent ones through one stream of
    deltas (``order_state``); the result must equal a full rebuild."""
    with width_for(spark, [src[name] for name in ("orders", *MART_INPUTS)]):
        return _by_deltas(spark, src)


def _by_deltas(spark: SparkSession, src) -> DataFrame:
    root = scratch_path(spark, "incremental")
    orders = src["orders"]
    last_day: _dt.date = orders.agg(F.max("order_purchase_timestamp")).first()[0]
    cutoff = F.lit(str(last_day - _dt.timedelta(days=LOOKBACK_DAYS))).cast("date")
    late = orders.where(orders["order_purchase_timestamp"] > cutoff)

    state = order_state.OrderState.start(spark, root, buckets=shuffle_width(spark))
    first = order_state.as_events("orders", orders.where(orders["order_purchase_timestamp"] <= cutoff))
    for name in MART_INPUTS:
        first = first.unionByName(order_state.as_events(name, src[name].join(late.select("order_id"), "order_id", "left_anti")))
    state.process(first, order_state.FOLDED)

    late.write.parquet(f"{root}/inbox/orders")
    for name in MART_INPUTS:
        src[name].join(late.select("order_id"), "order_id", "left_semi").write.parquet(f"{root}/inbox/{name}")
    order_state.start_stream(spark, root, f"{root}/inbox", f"{root}/_stream_checkpoint").awaitTermination()
    return order_state.OrderState(spark, root).mart_sales_daily()
