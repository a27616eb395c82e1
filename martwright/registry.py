"""Key -> job over a driver data directory (``(spark, sf_dir) -> DataFrame``).

Keys follow SURVEY §7.3. Jobs that need written tables (staging copies, the
table-set and row-count checks) run the whole refresh once per data directory
and Spark application into a scratch folder under the checkpoint directory.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle import RUN_DATE
from .operators import quality
from .plans import dims, facts, loads, lookups, maintenance, marts, pipeline, probes, reports
from .session import configure, scratch_path
from .sources.fixtures import Sources
from .sources.schemas import MART_KEYS, MART_LENGTHS, SOURCES, STAGING_ORDER

Job = Callable[[SparkSession, str], DataFrame]

_BUILT: dict[tuple[str, str], str] = {}
_LOCK = threading.Lock()


def _src(spark: SparkSession, sf_dir: str) -> Sources:
    configure(spark)
    return Sources(spark, sf_dir)


def built_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Root of a full refresh of ``sf_dir`` (run once per application)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if key not in _BUILT:
            root = scratch_path(spark, "warehouse")
            pipeline.run(spark, _src(spark, sf_dir), root, run_date=RUN_DATE)
            _BUILT[key] = root
        return _BUILT[key]


def _job(fn: Callable[[Sources], DataFrame]) -> Job:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_src(spark, sf_dir))
    return run


def _spark_job(fn: Callable[[SparkSession, Sources], DataFrame]) -> Job:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, _src(spark, sf_dir))
    return run


def _staged(table: str) -> Job:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return pipeline.read_table(spark, built_warehouse(spark, sf_dir), f"stg_{table}")
    return run


def _check(name: str) -> Job:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = built_warehouse(spark, sf_dir)
        return pipeline.checks(spark, root)[name]
    return run


def _order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.order_counts(spark, built_warehouse(spark, sf_dir))


def _fk(s: Sources) -> DataFrame:
    specs = [(t, c, pt, pc) for t, spec in SOURCES.items() for c, pt, pc in spec.foreign_keys]
    return quality.foreign_keys(s.as_dict(), specs)


def _pk(s: Sources) -> DataFrame:
    tables = {**s.as_dict(), **{m: getattr(marts, m)(s) for m in MART_KEYS}}
    specs = {**{t: spec.primary_key for t, spec in SOURCES.items() if spec.primary_key}, **MART_KEYS}
    return quality.primary_keys(tables, specs)


def _lengths(s: Sources) -> DataFrame:
    tables = {**s.as_dict(), **{m: getattr(marts, m)(s) for m in MART_LENGTHS}}
    limits = {**{t: spec.lengths for t, spec in SOURCES.items()}, **MART_LENGTHS}
    return quality.lengths(tables, limits)


def _surrogate(s: Sources) -> DataFrame:
    return facts.fact_orders_surrogate_keys(s, dims.customer_keys(s), dims.product_keys(s), dims.seller_keys(s),
                                            dims.geolocation_keys(s), dims.payment_keys(s))


def _order_calendar(s: Sources) -> DataFrame:
    return dims.dim_dates_covering(s["orders"], "order_purchase_timestamp")


def _incremental(spark: SparkSession, s: Sources) -> DataFrame:
    from .streaming.incremental import incremental_sales_daily
    return incremental_sales_daily(spark, s)


REGISTRY: dict[str, Job] = {
    # staging copies (written by the refresh, read back)
    **{f"stg_{t}": _staged(t) for t in STAGING_ORDER},
    # dimensions
    "dim_customers": _job(lambda s: dims.dim_customers(s, RUN_DATE)),
    "dim_products": _job(lambda s: dims.dim_products(s, RUN_DATE)),
    "dim_sellers": _job(lambda s: dims.dim_sellers(s, RUN_DATE)),
    "dim_geolocation": _job(dims.dim_geolocation),
    "dim_dates": _job(_order_calendar),
    "dim_payments": _job(dims.dim_payments),
    # fact
    "fact_orders": _job(facts.fact_orders),
    "fact_lookups": _spark_job(lookups.busiest_lookups),
    # marts
    "mart_sales_daily": _job(marts.mart_sales_daily),
    "mart_product_performance": _job(marts.mart_product_performance),
    "mart_city_revenue": _job(marts.mart_city_revenue),
    # reports
    "report_revenue_by_month": _job(lambda s: reports.report_revenue_by_month(s, _order_calendar(s))),
    "report_orders_by_status": _job(reports.report_orders_by_status),
    "report_units_by_category": _job(reports.report_units_by_category),
    "report_revenue_by_city": _job(reports.report_revenue_by_city),
    "report_sales_daily": _job(lambda s: reports.report_sales_daily(marts.mart_sales_daily(s))),
    "report_top20_products": _job(lambda s: reports.report_top20_products(marts.mart_product_performance(s))),
    "report_top20_cities": _job(lambda s: reports.report_top20_cities(marts.mart_city_revenue(s))),
    "report_total_revenue_all_days": _job(lambda s: reports.report_total_revenue_all_days(marts.mart_sales_daily(s))),
    "report_total_orders_all_days": _job(lambda s: reports.report_total_orders_all_days(marts.mart_sales_daily(s))),
    "report_order_counts": _order_counts,
    # row maintenance and files
    "upsert_by_key": _spark_job(maintenance.upsert_customers),
    "delete_by_keys": _spark_job(maintenance.delete_orders),
    "append_rows": _spark_job(maintenance.append_sellers),
    "truncate_table": _spark_job(maintenance.truncate_orders),
    "dump_table": _spark_job(maintenance.dump_reviews),
    "reload_dump": _spark_job(maintenance.reload_reviews),
    "load_csv": _spark_job(maintenance.load_reviews_csv),
    "load_csv_tables": _spark_job(maintenance.load_csv_tables),
    "get_records": _spark_job(maintenance.orders_by_status_records),
    # data checks
    "dq_row_counts": _check("row_counts"),
    "dq_tables": _check("tables"),
    "dq_foreign_keys": _job(_fk),
    "dq_primary_keys": _job(_pk),
    "dq_lengths": _job(_lengths),
    "dq_loads": _spark_job(loads.load_checks),
    # operator probes
    "category_code": _job(probes.payment_type_codes),
    "dense_key": _job(probes.item_positions),
    "stable_key": _job(probes.payment_positions),
    "keep_first": _job(probes.first_payment_per_order),
    "title_case_city": _job(probes.title_case_cities),
    # corrected variants
    "mart_city_revenue_padded": _job(marts.mart_city_revenue_padded),
    "report_revenue_by_city_zip": _job(reports.report_revenue_by_city_zip),
    "fact_order_items": _job(facts.fact_order_items),
    "mart_sales_daily_item_grain": _job(marts.mart_sales_daily_item_grain),
    # on the original project's to-do list
    "incremental_sales_daily": _spark_job(_incremental),
    "fact_orders_surrogate_keys": _job(_surrogate),
}


def queries() -> dict[str, Job]:
    return dict(REGISTRY)
