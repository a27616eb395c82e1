"""Invariants of the fact and marts, trap rows, and the pipeline refresh."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martwright.plans import facts, marts, pipeline, reports
from martwright.session import scratch_path
from martwright.sources.schemas import MANIFEST


def test_fact_row_count_invariant(src_small):
    items = src_small["order_items"].groupBy("order_id").count().withColumnRenamed("count", "i")
    pays = src_small["payments"].groupBy("order_id").count().withColumnRenamed("count", "p")
    expect = (src_small["orders"].join(items, "order_id", "left").join(pays, "order_id", "left")
              .select((F.greatest(F.coalesce("i", F.lit(0)), F.lit(1))
                       * F.greatest(F.coalesce("p", F.lit(0)), F.lit(1))).alias("n"))
              .agg(F.sum("n")).first()[0])
    assert facts.fact_orders(src_small).count() == expect == 14741
    rollup_rows = facts.order_rollup(src_small).agg(F.sum("fact_rows")).first()[0]
    assert rollup_rows == expect


def test_marts_from_rollups_equal_marts_from_fact(src_small):
    fact = facts.fact_orders(src_small)
    a = sorted(tuple(r) for r in marts.mart_sales_daily(src_small).collect())
    b = sorted(tuple(r) for r in marts.mart_sales_daily_from_fact(fact).collect())
    assert a == b
    assert sum(r[1] for r in a) == src_small["orders"].count()


def test_day_with_only_itemless_orders_has_null_revenue(spark):
    src = {
        "orders": spark.createDataFrame(
            [("o1", "c1", "F", dt.date(2020, 1, 1), None, None, None, dt.date(2020, 1, 5)),
             ("o2", "c1", "F", dt.date(2020, 1, 2), None, None, None, dt.date(2020, 1, 5))],
            "order_id string, customer_id string, order_status string, order_purchase_timestamp date, "
            "order_approved_at date, order_delivered_carrier_date date, order_delivered_customer_date date, "
            "order_estimated_delivery_date date"),
        "customers": spark.createDataFrame([("c1", 1500)], "customer_id string, customer_zip_code_prefix int"),
        "order_items": spark.createDataFrame([("o2", 1, "p", "s", 10.0, 1.0), ("o2", 2, "p", "s", 5.0, 0.5)],
                                             "order_id string, order_item_id int, product_id string, "
                                             "seller_id string, price double, freight_value double"),
        "payments": spark.createDataFrame([("o2", 1, "x", None, 1.0), ("o2", 2, "y", None, 1.0)],
                                          "order_id string, payment_sequential int, payment_type string, "
                                          "payment_installments double, payment_value double"),
    }
    got = {r.order_date: r for r in marts.mart_sales_daily(src).collect()}
    assert got[dt.date(2020, 1, 1)].order_count == 1 and got[dt.date(2020, 1, 1)].total_revenue is None
    # two payments fan the two items out: (11.0 + 5.5) * 2
    assert got[dt.date(2020, 1, 2)].total_revenue == Decimal("33.00")
    assert got[dt.date(2020, 1, 2)].average_order_value == Decimal("33.00")


def test_city_report_as_written_joins_zip_to_row_number(spark):
    """The as-written report matches a fact zip against the dimension's row
    number; on hand-made rows where the numbers coincide it finds a city."""
    src = {
        "orders": spark.createDataFrame([("o1", "c1", "F", dt.date(2020, 1, 1), None, None, None, None)],
                                        "order_id string, customer_id string, order_status string, "
                                        "order_purchase_timestamp date, order_approved_at date, "
                                        "order_delivered_carrier_date date, order_delivered_customer_date date, "
                                        "order_estimated_delivery_date date"),
        "customers": spark.createDataFrame([("c1", 1)], "customer_id string, customer_zip_code_prefix int"),
        "order_items": spark.createDataFrame([("o1", 1, "p", "s", 10.0, 1.0)],
                                             "order_id string, order_item_id int, product_id string, "
                                             "seller_id string, price double, freight_value double"),
        "payments": spark.createDataFrame([], "order_id string, payment_sequential int, payment_type string, "
                                              "payment_installments double, payment_value double"),
    }
    geo = spark.createDataFrame([("01500", "Far", 1), ("00001", "Near", 2)],
                                "geolocation_zip_code_prefix string, geolocation_city string, geolocation_key long")
    as_written = reports.report_revenue_by_city(src, geo).collect()
    assert [(r.geolocation_city, r.total_revenue) for r in as_written] == [("Far", Decimal("11.00"))]
    by_zip = reports.report_revenue_by_city_zip(src, geo).collect()
    assert [(r.geolocation_city, r.total_revenue) for r in by_zip] == [("Near", Decimal("11.00"))]


def test_top_k_null_first_ties_by_id(spark):
    mart = spark.createDataFrame(
        [("p2", "c", 1, Decimal("5.00")), ("p1", "c", 1, Decimal("5.00")), ("p3", "c", 1, None)],
        "product_id string, product_category_name_english string, total_quantity long, total_revenue decimal(18,2)")
    got = [r.product_id for r in reports.report_top20_products(mart).collect()]
    assert got == ["p3", "p1", "p2"]


def test_pipeline_refresh_is_idempotent(spark, src_small):
    root = scratch_path(spark, "t-pipeline")
    pipeline.run(spark, src_small, root, run_date="2024-10-26")
    first = {t: sorted(map(tuple, pipeline.read_table(spark, root, t).collect()), key=repr)
             for t in ["mart_sales_daily", "dim_geolocation", "dim_payments"]}
    checks = pipeline.checks(spark, root)
    tables = checks["tables"].collect()
    assert len(tables) == sum(len(v) for v in MANIFEST.values()) and all(r.present for r in tables)
    assert all(r.non_empty for r in checks["row_counts"].collect())
    pk = {r.table_name: r for r in checks["primary_keys"].collect()}
    assert all(pk[m].ok for m in ["mart_sales_daily", "mart_product_performance", "mart_city_revenue"])
    fk = {(r.child_table, r.child_column): r for r in checks["foreign_keys"].collect()}
    assert fk[("products", "product_category_name")].dangling_rows > 0  # 'promo' has no translation
    assert fk[("order_items", "order_id")].dangling_rows == 0
    pipeline.run(spark, src_small, root, run_date="2024-10-26")
    again = {t: sorted(map(tuple, pipeline.read_table(spark, root, t).collect()), key=repr) for t in first}
    assert again == first
    assert pipeline.read_table(spark, root, "dim_dates").count() == 3653


def _join_tasks(df, order_id):
    """Tasks that make the pairs of one order (small shuffles not merged, as at scale)."""
    spark, off = df.sparkSession, {"spark.sql.adaptive.coalescePartitions.enabled": "false",
                                   "spark.sql.autoBroadcastJoinThreshold": "-1",
                                   "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    saved = {k: spark.conf.get(k, None) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        rows = df.where(F.col("order_id") == order_id).groupBy(F.spark_partition_id().alias("t")).count()
        return rows.count()
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _sides(spark, n_items, n_payments, same=False):
    orders = spark.createDataFrame([("h", "x"), ("n", "y")], "order_id string, v string")
    items = spark.createDataFrame([("h", 0 if same else i) for i in range(n_items)] + [("n", 1)], "order_id string, i int")
    pays = spark.createDataFrame([("h", 0 if same else p) for p in range(n_payments)] + [("n", 1)], "order_id string, p int")
    return orders, items, pays


def test_fan_out_spreads_one_order_from_both_sides(spark):
    for n_items, n_payments, same in [(1, 900, False), (900, 1, False), (900, 1, True), (60, 60, True)]:
        sides = _sides(spark, n_items, n_payments, same)
        got = facts.fan_out(*sides, side=20)
        plain = sides[0].join(sides[1], "order_id", "left").join(sides[2], "order_id", "left")
        assert got.columns == plain.columns
        assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
        assert _join_tasks(got, "h") > 3


def test_fan_out_keeps_orders_without_items_or_payments(spark):
    orders = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "order_id string")
    items = spark.createDataFrame([("a", 1), ("b", 2)], "order_id string, i int")
    pays = spark.createDataFrame([("a", 5), ("a", 6), ("c", 7)], "order_id string, p int")
    got = sorted(map(tuple, facts.fan_out(orders, items, pays).collect()), key=repr)
    assert got == [("a", 1, 5), ("a", 1, 6), ("b", 2, None), ("c", None, 7), ("d", None, None)]


def test_amounts_are_rounded_after_summing(spark):
    src = {
        "orders": spark.createDataFrame([("o", "c", "F", dt.date(2020, 1, 1), None, None, None, None)],
                                        "order_id string, customer_id string, order_status string, "
                                        "order_purchase_timestamp date, order_approved_at date, "
                                        "order_delivered_carrier_date date, order_delivered_customer_date date, "
                                        "order_estimated_delivery_date date"),
        "customers": spark.createDataFrame([("c", 1)], "customer_id string, customer_zip_code_prefix int"),
        "order_items": spark.createDataFrame([("o", i, "p", "s", 0.004, 0.0) for i in range(1000)],
                                             "order_id string, order_item_id int, product_id string, "
                                             "seller_id string, price double, freight_value double"),
        "payments": spark.createDataFrame([], "order_id string, payment_sequential int, payment_type string, "
                                              "payment_installments double, payment_value double"),
    }
    assert marts.mart_sales_daily(src).first().total_revenue == Decimal("4.00")
    fact = facts.fact_orders(src)
    assert marts.mart_sales_daily_from_fact(fact).first().total_revenue == Decimal("4.00")
    dim = spark.createDataFrame([("p", "x", "y")], "product_id string, product_category_name string, "
                                                   "product_category_name_english string")
    row = marts.mart_product_performance_from_fact(fact, dim).first()
    assert (row.total_revenue, row.avg_item_price) == (Decimal("4.00"), Decimal("0.00"))


def test_marts_follow_the_written_fact(spark, src_small):
    from martwright.operators.dml import replace_table
    root = scratch_path(spark, "t-follow")
    pipeline.run(spark, src_small, root, run_date="2024-10-26")
    fact = pipeline.read_table(spark, root, "fact_orders")
    assert marts.mart_sales_daily_from_fact(fact).exceptAll(marts.mart_sales_daily(src_small)).isEmpty()
    day = fact.agg(F.min("order_date_key")).first()[0]
    replace_table(fact.where(F.col("order_date_key") != day), pipeline.table_path(root, "fact_orders"))
    pipeline.publish_marts(spark, root)
    got = pipeline.read_table(spark, root, "mart_sales_daily")
    assert got.where(F.col("order_date") == F.lit(day)).isEmpty()
    assert got.count() == marts.mart_sales_daily(src_small).count() - 1


def test_top20_cities_limit_bites(spark):
    mart = spark.createDataFrame([(f"c{i:02d}", "s", 1, Decimal(i)) for i in range(25)],
                                 "geolocation_city string, geolocation_state string, order_count long, "
                                 "total_revenue decimal(18,2)")
    got = [r.geolocation_city for r in reports.report_top20_cities(mart).collect()]
    assert got == [f"c{i:02d}" for i in range(24, 4, -1)]


def test_sql_layers_gates_and_reports(spark, src_small):
    from martwright.plans import catalog
    root = scratch_path(spark, "t-catalog")
    pipeline.run(spark, src_small, root, run_date="2024-10-26", gates=True, buckets=8,
                 fact_partition_by=("order_status",))
    names = catalog.register_layers(spark, root, buckets=8)
    fact_rows = catalog.execute_sql(spark, "SELECT COUNT(*) AS n FROM warehouse.fact_orders WHERE order_status = 'f'")
    assert fact_rows.first().n == facts.fact_orders(src_small).where("order_status = 'f'").count() > 0
    joined = spark.sql("SELECT COUNT(*) AS n FROM staging.stg_orders o JOIN staging.stg_order_items i "
                       "ON o.order_id = i.order_id")
    assert "Bucketed: true" in joined._jdf.queryExecution().executedPlan().toString()
    assert "mart.mart_sales_daily" in names and len(names) == sum(len(v) for v in MANIFEST.values())
    types = dict((f.name, f.dataType.simpleString()) for f in spark.table("mart.mart_sales_daily").schema.fields)
    assert types["total_revenue"] == "decimal(18,2)"
    total = catalog.execute_sql(spark, "SELECT SUM(order_count) AS n FROM mart.mart_sales_daily").first().n
    assert total == src_small["orders"].count()
    rep = pipeline.reports_from_warehouse(spark, root)
    assert rep["report_total_orders_all_days"].first()[0] == total
    assert rep["report_revenue_by_month"].count() == 0  # default calendar 2016-2025 misses 1995-2001 orders
    catalog.drop_table(spark, "mart", "mart_city_revenue", root)
    assert not spark.catalog.tableExists("mart.mart_city_revenue")
    missing = {r.table_name: r.present for r in pipeline.checks(spark, root)["tables"].collect()}
    assert missing["mart_city_revenue"] is False


def test_gate_rejects_duplicate_source_keys(spark, src_small):
    dup = dict(src_small.as_dict())
    dup["customers"] = src_small["customers"].unionByName(src_small["customers"].limit(1))
    with pytest.raises(pipeline.DataQualityError):
        pipeline.run(spark, dup, scratch_path(spark, "t-gate"), run_date="2024-10-26")
    lost = dict(src_small.as_dict())
    lost["customers"] = src_small["customers"].where("customer_id <> '1'")
    lost["orders"] = src_small["orders"].withColumn("customer_id", F.lit("1"))
    with pytest.raises(pipeline.DataQualityError, match="dangling"):
        pipeline.run(spark, lost, scratch_path(spark, "t-gate"), run_date="2024-10-26")


def test_incremental_batch_replay_is_idempotent(spark, src_small):
    """Re-running a micro-batch (as after a failure) leaves the mart equal to
    a full rebuild."""
    from martwright.operators import dml
    from martwright.streaming import incremental as inc
    root = scratch_path(spark, "t-incr")
    orders = src_small["orders"]
    cutoff = F.lit("1998-06-01").cast("date")
    inc.stage_orders(orders.where(orders["order_purchase_timestamp"] <= cutoff), root)
    for name in inc.MART_INPUTS:
        inc.stage_details(src_small[name], root, name)
    inc.write_months(marts.mart_sales_daily(pipeline.StagedSources(spark, root)), root)
    late = orders.where(orders["order_purchase_timestamp"] > cutoff).withColumn(inc.SEQ, F.lit(1))
    inc.process_batch(spark, root, late, 0)
    inc.process_batch(spark, root, late, 0)  # replayed epoch
    got = sorted(map(tuple, inc.read_mart(spark, root).collect()))
    want = sorted(map(tuple, marts.mart_sales_daily(src_small).collect()))
    assert got == want
    # an update that moves an order to another month: the old month loses it
    first = orders.orderBy("order_id").limit(1).collect()[0]
    moved = spark.createDataFrame([first], orders.schema).withColumn(
        "order_purchase_timestamp", F.lit("2001-12-15").cast("date"))
    # stopped between the upsert and the refresh, then replayed
    rows = inc._with_month(moved.withColumn(inc.SEQ, F.lit(1)))
    path = pipeline.table_path(root, "stg_orders")
    touched = dml.touched_partitions(spark.read.parquet(path), rows, ["order_id"], inc.MONTH)
    inc.epoch_months(spark, root, "orders", 1, spark.createDataFrame([(m,) for m in touched], "m date"))
    dml.upsert_partitions(spark, path, rows, ["order_id"], inc.MONTH, inc.SEQ)
    inc.process_batch(spark, root, moved.withColumn(inc.SEQ, F.lit(1)), 1)
    staged = spark.read.parquet(pipeline.table_path(root, "stg_orders"))
    assert staged.where(F.col("order_id") == first.order_id).count() == 1
    expect_src = {**{n: src_small[n] for n in inc.MART_INPUTS},
                  "orders": orders.where(F.col("order_id") != first.order_id).unionByName(moved)}
    want2 = sorted(map(tuple, marts.mart_sales_daily(expect_src).collect()))
    assert sorted(map(tuple, inc.read_mart(spark, root).collect())) == want2
    # two versions of an order in one batch: the later arrival wins, whatever its text
    two = moved.withColumn("order_status", F.lit("shipped")).withColumn(inc.SEQ, F.lit(1)).unionByName(
        moved.withColumn("order_status", F.lit("delivered")).withColumn(inc.SEQ, F.lit(2)))
    inc.process_batch(spark, root, two, 2)
    staged = spark.read.parquet(path)
    assert [r.order_status for r in staged.where(F.col("order_id") == first.order_id).collect()] == ["delivered"]
    with pytest.raises(ValueError):
        inc.process_batch(spark, root, moved, 3)
    # late items refresh the months of their orders, once even if replayed
    extra = src_small["order_items"].where(F.col("order_id") == first.order_id).limit(1).withColumn("price", F.lit(1000.0))
    inc.process_details(spark, root, "order_items", extra, 0)
    inc.process_details(spark, root, "order_items", extra, 0)
    expect_src["order_items"] = src_small["order_items"].unionByName(extra)
    want3 = sorted(map(tuple, marts.mart_sales_daily(expect_src).collect()))
    assert sorted(map(tuple, inc.read_mart(spark, root).collect())) == want3


def test_pipeline_from_delimited_files(spark, src_small):
    """Source tables written as CSV files (free text included), bulk-loaded
    with their schemas and run through the refresh: same marts."""
    from martwright.sources.files import CsvSources
    from martwright.sources.schemas import SRC_POS, STAGING_ORDER
    folder = scratch_path(spark, "t-csv-sources")
    for name in STAGING_ORDER:
        df = src_small[name]
        if SRC_POS in df.columns:  # one file in ingest order; the position is re-derived on load
            df = df.orderBy(SRC_POS).drop(SRC_POS).coalesce(1)
        (df.write.option("header", True).option("quote", '"').option("escape", '"')
         .option("emptyValue", '""').csv(f"{folder}/{name}.csv"))
    root = scratch_path(spark, "t-csv-pipeline")
    pipeline.run(spark, CsvSources(spark, folder), root, run_date="2024-10-26")
    for mart in ["mart_sales_daily", "mart_product_performance", "mart_city_revenue", "dim_geolocation"]:
        got = sorted(map(tuple, pipeline.read_table(spark, root, mart).collect()), key=repr)
        want_df = getattr(marts, mart)(src_small) if mart.startswith("mart") else None
        if want_df is None:
            from martwright.plans import dims
            want_df = dims.dim_geolocation(src_small)
        assert got == sorted(map(tuple, want_df.collect()), key=repr), mart


def test_bucketed_staging_removes_order_shuffles(spark, src_small):
    """Without broadcasts (as at scale), the daily mart over bucketed staging
    joins and pre-groups orders, items and payments without any exchange: the
    only shuffle left is the final per-day aggregate."""
    root = scratch_path(spark, "t-buckets")
    pipeline.stage(src_small, root, buckets=8)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        df = marts.mart_sales_daily(pipeline.StagedSources(spark, root))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, marts.mart_sales_daily(src_small).collect()))
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_restaging_without_buckets_drops_the_bucket_spec(spark, src_small):
    root = scratch_path(spark, "t-rebucket")
    pipeline.stage(src_small, root, buckets=4)
    assert spark.catalog.tableExists(pipeline.bucketed_table_name(root, "orders"))
    pipeline.stage(src_small, root, buckets=0)
    assert not spark.catalog.tableExists(pipeline.bucketed_table_name(root, "orders"))
    assert pipeline.StagedSources(spark, root)["orders"].count() == src_small["orders"].count()


def test_one_order_holding_a_third_of_items_and_payments(spark, src_small):
    """Skewed variant of the data: every third item and payment is moved to a
    single order. Marts from the pre-aggregated rollups still equal the marts
    computed from the materialised fact, and the hot order's pairs are
    made by several tasks."""
    hot_id = src_small["orders"].orderBy("order_id").first().order_id

    def to_hot(df):
        return df.withColumn("order_id", F.when(F.xxhash64(*[F.col(c) for c in df.columns]) % 3 == 0,
                                                F.lit(hot_id)).otherwise(F.col("order_id")))

    skewed = {**src_small.as_dict(),
              "order_items": to_hot(src_small["order_items"]),
              "payments": to_hot(src_small["payments"])}
    share = skewed["order_items"].where(F.col("order_id") == hot_id).count() / skewed["order_items"].count()
    assert 0.25 < share < 0.45
    fact = facts.fact_orders(skewed, side=100)
    plain = _multiset(facts.fact_orders(skewed, side=10 ** 6))
    assert _join_tasks(fact, hot_id) > 1
    assert _multiset(fact) == plain
    assert sorted(map(tuple, marts.mart_sales_daily(skewed).collect())) == \
        sorted(map(tuple, marts.mart_sales_daily_from_fact(facts.fact_orders(skewed, side=10 ** 6)).collect()))
    # the same over bucketed staging, where a bucket holds the whole order
    root = scratch_path(spark, "t-hot-buckets")
    pipeline.stage(skewed, root, buckets=4)
    staged = facts.fact_orders(pipeline.StagedSources(spark, root), side=100)
    assert _join_tasks(staged, hot_id) > 1 and _multiset(staged) == plain


def _multiset(df):
    """Row count and order-free digests of the rows: equal for equal multisets."""
    row = F.struct(*[F.col(c) for c in sorted(df.columns)])
    return tuple(df.agg(F.count(F.lit(1)), *[F.sum(F.xxhash64(row, F.lit(salt)).cast("decimal(38,0)")) for salt in (1, 2)]).first())


@pytest.mark.parametrize("side", ["items", "payments"])
def test_a_hot_orders_rows_are_numbered_by_many_tasks(spark, src_small, side):
    """All rows of one side in one order, from one input partition: every task numbers a piece of them."""
    rows = src_small["order_items" if side == "items" else "payments"].withColumn("order_id", F.lit("hot")).coalesce(1)
    n = rows.count()
    piece = 256
    numbered = facts.number_rows(rows, "order_id", piece)
    assert sorted(r[0] for r in numbered.select("_mw_pos").collect()) == list(range(n))
    assert numbered.drop("_mw_pos").columns == rows.columns and _multiset(numbered.drop("_mw_pos")) == _multiset(rows)
    at = F.monotonically_increasing_id()
    pieces = rows.withColumn("p", F.shiftright(at, piece.bit_length() - 1)).groupBy("order_id", "p").count()
    assert n > 3 * piece and pieces.agg(F.max("count")).first()[0] <= piece
    # what the window's tasks hold: no partition of the shuffle by (order, piece) is over three times the median
    held = sorted(r[1] for r in rows.withColumn("p", F.shiftright(at, 4)).repartition(8, "order_id", "p")
                  .groupBy(F.spark_partition_id()).count().collect())
    assert len(held) == 8 and held[-1] < 3 * held[len(held) // 2]


def test_refresh_drops_the_shuffles_of_its_steps(spark, src_small, monkeypatch):
    """While it writes, each query's shuffle files go as it ends; jobs with a row per product and order come last, one by one."""
    from martwright.session import SHUFFLE_CLEANUP, scratch_path

    before, seen, write = spark.conf.get(SHUFFLE_CLEANUP, None), [], pipeline._write_new

    def watched(df, root, table, partition_by=()):
        seen.append((table, spark.conf.get(SHUFFLE_CLEANUP, None)))
        return write(df, root, table, partition_by)

    monkeypatch.setattr(pipeline, "_write_new", watched)
    root = scratch_path(spark, "t-dropped")
    pipeline.run(spark, src_small, root, run_date="2024-01-01")
    assert {on for _, on in seen} == {"true"} and spark.conf.get(SHUFFLE_CLEANUP, None) == before
    assert [t for t, _ in seen[-2:]] == ["mart_product_performance", "orders_of_product"]
    assert all(".zstd." in f for f in pipeline.read_table(spark, root, "fact_orders").inputFiles())
