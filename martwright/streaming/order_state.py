"""Daily sales by deltas: a micro-batch costs its own orders, not the staged tables.

One stream carries orders, deleted orders, items and payments as events. Per order a state row is kept: whether the order is
there, its day, and the number and amount of its items and of its payments. What an order adds to its day follows
from its row alone, so a micro-batch

1. reduces its events to one change per order (of several versions of an order the last to arrive wins);
2. reads the state of just these orders, from the hash buckets they lie in;
3. writes their new state as a run of this epoch, beside what each order added to the mart before;
4. writes the days' deltas of this epoch: minus what the orders added before, plus what they add now.

The mart is the sum of the deltas per day: an order that moves leaves one day and enters another, a deleted one leaves, and
items that come before their order wait in its state. Items and payments are never staged or read again.

A replay writes the same epoch again from the state of earlier epochs, so stopping anywhere changes nothing. Runs and
deltas are named by a publication per fold (``operators.publish``): ``compact`` folds all epochs into one run and one
set of days, and commits both at once. Buckets are chosen at ``start`` from the expected orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import avg_money, money
from ..operators import publish
from ..operators.dml import table_exists
from ..plans import marts
from ..plans.facts import ORDER_DATE_SOURCE
from ..session import scratch_path
from ..sources.schemas import MONEY, SOURCES

KINDS = ("orders", "deleted_orders", "order_items", "payments")
AMOUNT = "decimal(38,6)"
EVENTS = f"kind string, order_id string, day date, amount {AMOUNT}, arrival struct<time: timestamp, path: string, row: long>"
STATE = f"order_id string, known boolean, day date, items long, amount {AMOUNT}, payments long, was_known boolean, was_day date, was_revenue {AMOUNT}"
DELTAS = f"order_date date, orders long, priced long, revenue {AMOUNT}"
BUCKET, EPOCH = "bucket", "epoch"
FOLDED = -1


def as_events(kind: str, rows: DataFrame, arrival: Column | None = None) -> DataFrame:
    """Rows of a source table (``deleted_orders``: ids) as events."""
    none = F.lit(None)
    day = F.to_date(F.col(ORDER_DATE_SOURCE).cast("timestamp_ntz")) if kind == "orders" else none
    amount = money(F.col("price") + F.col("freight_value")) if kind == "order_items" else none
    at = arrival if arrival is not None else F.struct(none.cast("timestamp").alias("time"), none.cast("string").alias("path"),
                                                      none.cast("long").alias("row"))
    return rows.select(F.lit(kind).alias("kind"), F.col("order_id"), day.cast("date").alias("day"), amount.cast(AMOUNT).alias("amount"),
                       at.alias("arrival"))


def _revenue(amount: str, payments: str) -> Column:
    return (F.col(amount) * F.greatest(F.col(payments), F.lit(1)).cast("decimal(18,0)")).cast(AMOUNT)


class OrderState:
    """State and deltas under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.number = publish.current(spark, root)
        if self.number is None:
            raise FileNotFoundError(f"no order state under {root}")
        self.manifest = publish.load(spark, root, self.number)
        self.buckets: int = self.manifest["buckets"]

    @classmethod
    def start(cls, spark: SparkSession, root: str, buckets: int) -> OrderState:
        publish.commit(spark, root, {"buckets": buckets, "state": publish.new_folder("state"), "deltas": publish.new_folder("deltas")}, None)
        return cls(spark, root)

    def _path(self, part: str) -> str:
        return f"{self.root}/{self.manifest[part]}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("order_id"), F.lit(self.buckets)).cast("int")

    def _runs(self, before: int, buckets: list[int] | None = None) -> DataFrame:
        """State runs of epochs before ``before`` in the given buckets (partition pruning)."""
        schema = f"{STATE}, {BUCKET} int, {EPOCH} long"
        if not table_exists(self.spark, self._path("state")):
            return self.spark.createDataFrame([], schema)
        runs = self.spark.read.schema(schema).parquet(self._path("state")).where(F.col(EPOCH) < before)
        return runs if buckets is None else runs.where(F.col(BUCKET).isin(buckets))

    def changes(self, events: DataFrame) -> DataFrame:
        """One row per order of a batch."""
        order = F.col("kind").isin("orders", "deleted_orders")
        last = F.max(F.when(order, F.struct("arrival", (F.col("kind") == "orders").alias("known"), "day")))
        one = lambda kind: F.count(F.when(F.col("kind") == kind, F.lit(1)))
        return events.where("order_id IS NOT NULL").groupBy("order_id").agg(
            last.alias("last"), one("order_items").alias("items"), F.sum("amount").cast(AMOUNT).alias("amount"), one("payments").alias("payments"))

    def next_state(self, changes: DataFrame, before: int) -> DataFrame:
        """New state rows of the changed orders, with what they added until now. ``changes`` must be a written table."""
        touched = [r[0] for r in changes.select(self._bucket().alias("b")).distinct().collect()]      # at most the buckets
        rows = self._runs(before, touched).join(changes.select("order_id"), "order_id", "left_semi")
        old = rows.groupBy("order_id").agg(F.max_by(F.struct("known", "day", "items", "amount", "payments"), EPOCH).alias("old"))
        both = changes.join(old, "order_id", "left")
        was_known = F.coalesce(F.col("old.known"), F.lit(False))
        zero = F.lit(0).cast("long")
        amount = F.when(F.col("amount").isNull(), F.col("old.amount")).otherwise(
            (F.col("amount") + F.coalesce(F.col("old.amount"), F.lit(0).cast(AMOUNT))).cast(AMOUNT))
        new = both.select(
            "order_id", F.when(F.col("last").isNull(), was_known).otherwise(F.col("last.known")).alias("known"),
            F.when(F.col("last").isNull(), F.col("old.day")).otherwise(F.col("last.day")).alias("day"),
            (F.col("items") + F.coalesce("old.items", zero)).alias("items"), amount.alias("amount"),
            (F.col("payments") + F.coalesce("old.payments", zero)).alias("payments"), was_known.alias("was_known"),
            F.col("old.day").alias("was_day"), _revenue("old.amount", "old.payments").alias("was_revenue"))
        return new.withColumn(BUCKET, self._bucket())

    def process(self, events: DataFrame, epoch: int) -> None:
        """Apply one micro-batch; a replay of an epoch writes the same again."""
        path = scratch_path(self.spark, "order-changes")
        self.changes(events).write.parquet(path)
        changes = self.spark.read.parquet(path)
        if changes.isEmpty():
            return
        (self.next_state(changes, epoch).withColumn(EPOCH, F.lit(epoch).cast("long")).hint("rebalance", BUCKET)
         .sortWithinPartitions(BUCKET, "order_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(EPOCH, BUCKET).parquet(self._path("state")))
        written = self._runs(epoch + 1).where(F.col(EPOCH) == epoch)
        (self._deltas(written).withColumn(EPOCH, F.lit(epoch).cast("long")).coalesce(1).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(EPOCH).parquet(self._path("deltas")))

    def _deltas(self, run: DataFrame) -> DataFrame:
        """What a run of state rows changes, per day."""
        now = run.where("known").select(F.col("day").alias("order_date"), F.lit(1).alias("n"), _revenue("amount", "payments").alias("revenue"))
        was = run.where("was_known").select(F.col("was_day").alias("order_date"), F.lit(-1).alias("n"), (-F.col("was_revenue")).alias("revenue"))
        return now.unionByName(was).groupBy("order_date").agg(
            F.sum("n").alias("orders"), F.coalesce(F.sum(F.when(F.col("revenue").isNotNull(), F.col("n"))), F.lit(0)).cast("long").alias("priced"),
            F.coalesce(F.sum("revenue"), F.lit(0)).cast(AMOUNT).alias("revenue"))

    def days(self) -> DataFrame:
        """The deltas of all epochs, summed per day."""
        if not table_exists(self.spark, self._path("deltas")):
            return self.spark.createDataFrame([], DELTAS)
        every = self.spark.read.schema(f"{DELTAS}, {EPOCH} long").parquet(self._path("deltas"))
        return every.groupBy("order_date").agg(F.sum("orders").alias("orders"), F.sum("priced").alias("priced"),
                                               F.sum("revenue").cast(AMOUNT).alias("revenue")).where("orders > 0")

    def mart_sales_daily(self) -> DataFrame:
        """The mart, equal to one built from all rows; revenue is NULL on a day whose orders have no priced item."""
        total = F.when(F.col("priced") > 0, F.col("revenue"))
        daily = self.days().select("order_date", F.col("orders").alias("order_count"), total.cast(MONEY).alias("total_revenue"),
                                   avg_money(total, F.col("orders")).alias("average_order_value"))
        return marts.conform(daily, "mart_sales_daily")

    def compact(self) -> OrderState:
        """Fold all epochs into one run and one set of days, in new folders that one commit puts in place. To be
        called between micro-batches (epochs go on from the stream's own count)."""
        folded = {**self.manifest, "state": publish.new_folder("state"), "deltas": publish.new_folder("deltas")}
        fields = [f.split()[0] for f in STATE.split(", ")]
        last = self._runs(1 << 62).groupBy("order_id", BUCKET).agg(F.max_by(F.struct(*fields[1:]), EPOCH).alias("s")).select(
            "order_id", "s.*", BUCKET, F.lit(FOLDED).cast("long").alias(EPOCH))
        (last.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "order_id").write.partitionBy(EPOCH, BUCKET)
         .parquet(f"{self.root}/{folded['state']}"))
        self.days().withColumn(EPOCH, F.lit(FOLDED).cast("long")).coalesce(1).write.partitionBy(EPOCH).parquet(f"{self.root}/{folded['deltas']}")
        publish.commit(self.spark, self.root, folded, self.number)
        return OrderState(self.spark, self.root)


def event_stream(spark: SparkSession, inbox: str) -> DataFrame:
    """The four inbox folders (``<inbox>/<kind>``) as one stream of events; a missing folder is left out."""
    at = F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("path"),
                  F.col("_metadata.row_index").alias("row"))
    streams = None
    for kind in KINDS:
        if table_exists(spark, f"{inbox}/{kind}"):
            schema = "order_id string" if kind == "deleted_orders" else SOURCES[kind].schema
            one = as_events(kind, spark.readStream.schema(schema).parquet(f"{inbox}/{kind}"), at)
            streams = one if streams is None else streams.unionByName(one)
    if streams is None:
        raise FileNotFoundError(f"no inbox folder under {inbox}")
    return streams


def start_stream(spark: SparkSession, root: str, inbox: str, checkpoint: str):
    """Drain the inbox into the state under ``root``; epochs are the stream's own."""
    return (event_stream(spark, inbox).writeStream
            .foreachBatch(lambda df, epoch: OrderState(spark, root).process(df, epoch))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
