"""The daily mart by deltas against a rebuild."""

import random

import pytest
from pyspark.sql import functions as F

from martwright.plans import marts
from martwright.session import scratch_path
from martwright.sources.schemas import SOURCES
from martwright.streaming import order_state
from martwright.streaming.order_state import OrderState, as_events


def _mart(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _frame(spark, name, rows):
    """Rows given by a few columns as the source table."""
    schema = SOURCES[name].schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def _order(spark, oid, day):
    kind = next(f.dataType.typeName() for f in SOURCES["orders"].schema.fields if f.name == "order_purchase_timestamp")
    row = {"order_id": oid, "order_status": "s"}
    df = _frame(spark, "orders", [row]).drop("order_purchase_timestamp")
    return df.withColumn("order_purchase_timestamp", F.lit(day).cast(kind)).select(*[f.name for f in SOURCES["orders"].schema.fields])


def test_updates_moves_deletes_and_replays_equal_a_rebuild(spark):
    rnd = random.Random(3)
    root = scratch_path(spark, "t-state")
    state = OrderState.start(spark, root, buckets=5)
    assert _mart(state.mart_sales_daily()) == []
    orders, items, pays = {}, [], []
    days = ["2001-01-01", "2001-01-02", "2001-02-01", None]
    for epoch in range(6):
        batch = None

        def add(df, batch=None):
            return df if batch is None else batch.unionByName(df)

        news, gone = [], []
        for n in range(rnd.randint(0, 6)):
            oid, day = f"o{rnd.randint(0, 9)}", rnd.choice(days)
            news.append((oid, day, epoch * 100 + n))
            orders[oid] = day
        for n in range(rnd.randint(0, 2)):
            oid = f"o{rnd.randint(0, 9)}"
            gone.append((oid, epoch * 100 + 50 + n))
            orders.pop(oid, None)
        new_items = [{"order_id": f"o{rnd.randint(0, 12)}", "order_item_id": epoch * 100 + n, "price": rnd.choice([None, 1.25, 10.0, 3.333333]),
                      "freight_value": 0.5} for n in range(rnd.randint(0, 12))]
        new_pays = [{"order_id": f"o{rnd.randint(0, 12)}", "payment_sequential": n, "payment_type": "card"} for n in range(rnd.randint(0, 8))]
        items, pays = items + new_items, pays + new_pays
        at = lambda n: F.struct(F.lit(None).cast("timestamp").alias("time"), F.lit("f").alias("path"), F.lit(n).cast("long").alias("row"))
        for oid, day, n in news:
            batch = add(as_events("orders", _order(spark, oid, day), at(n)), batch)
        for oid, n in gone:
            batch = add(as_events("deleted_orders", spark.createDataFrame([(oid,)], "order_id string"), at(n)), batch)
        batch = add(as_events("order_items", _frame(spark, "order_items", new_items)), batch)
        batch = add(as_events("payments", _frame(spark, "payments", new_pays)), batch)
        batch = spark.createDataFrame(batch.collect(), order_state.EVENTS)
        state.process(batch, epoch)
        if epoch % 2:
            state.process(batch, epoch)                     # replayed
        if epoch == 3:
            # stopped after the state was written, before the deltas: replayed, too
            changes = scratch_path(spark, "t-changes")
            state.changes(batch).write.parquet(changes)
            rows = state.next_state(spark.read.parquet(changes), epoch).withColumn("epoch", F.lit(epoch).cast("long"))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch", "bucket").parquet(state._path("state"))
            state.process(batch, epoch)
        built = [_order(spark, o, d) for o, d in orders.items()]
        whole = _frame(spark, "orders", [])
        for o in built:
            whole = whole.unionByName(o)
        want = marts.mart_sales_daily({"orders": whole, "order_items": _frame(spark, "order_items", items), "payments": _frame(spark, "payments", pays)})
        assert _mart(state.mart_sales_daily()) == _mart(want), epoch
        if epoch == 2:
            before = _mart(state.mart_sales_daily())
            state = state.compact()
            assert _mart(state.mart_sales_daily()) == before
            assert {r[0] for r in state._runs(1 << 62).select("epoch").distinct().collect()} <= {order_state.FOLDED}


def test_a_micro_batch_reads_only_its_buckets_and_writes_only_its_days(spark, src_small):
    root = scratch_path(spark, "t-state")
    state = OrderState.start(spark, root, buckets=16)
    first = as_events("orders", src_small["orders"])
    for name in ("order_items", "payments"):
        first = first.unionByName(as_events(name, src_small[name]))
    state.process(first, order_state.FOLDED)
    assert _mart(state.mart_sales_daily()) == _mart(marts.mart_sales_daily(src_small))
    one = src_small["orders"].orderBy("order_id").limit(1)
    day = one.first().order_purchase_timestamp
    batch = as_events("orders", one.withColumn("order_purchase_timestamp", F.date_add("order_purchase_timestamp", 1).cast(
        one.schema["order_purchase_timestamp"].dataType)))
    path = scratch_path(spark, "t-changes")
    state.changes(batch).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = state.next_state(spark.read.parquet(path), 0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # the plan scans the batch and pruned state buckets, and no staged table of orders, items or payments
    assert "stg_" not in plan and "price" not in plan and plan.count("FileScan parquet") == 3
    assert plan.count("PartitionFilters: [isnotnull(epoch") == 1 and "bucket#" in plan.split("PartitionFilters:")[2]
    state.process(batch, 0)
    deltas = spark.read.parquet(state._path("deltas")).where("epoch = 0")
    assert deltas.count() == 2 and deltas.agg(F.sum("orders")).first()[0] == 0
    state_files = {r[0] for r in spark.read.parquet(state._path("state")).where("epoch = 0").select("bucket").distinct().collect()}
    assert len(state_files) == 1 and day is not None


def test_stream_of_all_kinds(spark, src_small):
    root = scratch_path(spark, "t-state-stream")
    with pytest.raises(FileNotFoundError):
        order_state.event_stream(spark, f"{root}/inbox")
    OrderState.start(spark, root, buckets=4)
    for name in ("orders", "order_items", "payments"):
        src_small[name].write.parquet(f"{root}/inbox/{name}")
    order_state.start_stream(spark, root, f"{root}/inbox", f"{root}/_cp").awaitTermination()
    gone = src_small["orders"].orderBy("order_id").select("order_id").limit(20)
    OrderState(spark, root).compact()                       # epochs of another writer may start again after a fold
    OrderState(spark, root).process(as_events("deleted_orders", gone,
                                              F.struct(F.current_timestamp().alias("time"), F.lit("p").alias("path"), F.lit(0).cast("long").alias("row"))), 0)
    left = src_small["orders"].join(gone, "order_id", "left_anti")
    want = marts.mart_sales_daily({**src_small.as_dict(), "orders": left})
    assert _mart(OrderState(spark, root).mart_sales_daily()) == _mart(want)
