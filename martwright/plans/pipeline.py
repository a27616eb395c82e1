"""The daily warehouse refresh: staging -> six dimensions + fact -> three marts.

Staged tables live under ``root/staging/<table>`` as parquet; a copy is a whole-table
replace with a folder swap (``operators.dml`` states its gap). The seven warehouse tables, the
three marts and the rollup are written to new folders and become visible together, in one
publication (``operators.publish``), after the gates have passed: a reader sees all of a refresh or nothing
of it, and a failed one leaves the last publication as it was. Dimensions and the fact only
read staging, so they are submitted concurrently as separate Spark jobs. Marts and fact-level
reports read the written fact and the rollup made from it, never staging.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import publish, quality
from ..operators.dml import replace_bucketed_table, replace_table, table_exists
from ..operators.zorder import z_ordered
from ..session import COMPRESSION, scratch_scope, shuffle_width, shuffles_dropped, width_for
from ..sources.schemas import MANIFEST, MART_KEYS, MART_LENGTHS, SOURCES, STAGING_ORDER
from . import dims, facts, marts, order_sets, reports

LAYER_OF = {t: layer for layer, ts in MANIFEST.items() for t in ts}


# The per-order rollup of the written fact, published with it.
ROLLUP = "order_rollup"


def table_path(root: str, table: str) -> str:
    """Folder of a table: where the last publication under ``root`` has it, else ``root/<layer>/<table>``."""
    spark = SparkSession.getActiveSession()
    if spark is not None and LAYER_OF.get(table) != "staging":
        published = publish.Snapshot(spark, root)
        if table in published:
            return published.path(table)
    return f"{root.rstrip('/')}/{LAYER_OF.get(table, 'work')}/{table}"


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One table. To read several of one refresh take a ``publish.Snapshot``."""
    return spark.read.parquet(table_path(root, table))


# Staged tables joined and grouped on the order id: bucketed and sorted by it
# with one bucket count, so the fact and the order-level marts read them
# co-partitioned instead of shuffling items and payments again per job.
ORDER_KEYED = ("orders", "order_items", "payments")
BUCKET_KEY = "order_id"


def bucketed_table_name(root: str, name: str) -> str:
    """Session catalog name of a bucketed staging table (private per root, so
    two warehouses in one session never alias each other)."""
    return f"default.mw_{hashlib.sha1(root.encode()).hexdigest()[:12]}_stg_{name}"


class StagedSources(Mapping):
    """Source name -> staged table (``stg_<name>``): the bucketed catalog table
    when it is registered in this session, else the parquet folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getitem__(self, name: str) -> DataFrame:
        if name in ORDER_KEYED:
            ident = bucketed_table_name(self.root, name)
            if self.spark.catalog.tableExists(ident):
                return self.spark.table(ident)
        return read_table(self.spark, self.root, f"stg_{name}")

    def __iter__(self):
        return iter(STAGING_ORDER)

    def __len__(self) -> int:
        return len(STAGING_ORDER)


BUCKET_BYTES = 256 * 1024 * 1024


def bucket_count(spark: SparkSession, tables: Sequence[DataFrame]) -> int:
    """Buckets of about ``BUCKET_BYTES`` of the largest table, as the planner
    knows its size from the files; at least the shuffle width."""
    sizes = [int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in tables]
    return min(max(shuffle_width(spark), -(-max(sizes) // BUCKET_BYTES)), MAX_BUCKETS)


# The catalog's own limit on buckets of a table (spark.sql.sources.bucketing.maxBuckets).
MAX_BUCKETS = 100_000


def stage(src: Mapping[str, DataFrame], root: str, buckets: int | None = None, parallelism: int = 4) -> None:
    """Raw-to-staging copy of the nine source tables (``stg_`` prefix), as
    concurrent jobs (the copies are independent). Orders, items and payments
    are bucketed by order id into ``buckets`` files (default: from the size of
    the sources, at least the session's shuffle width; 0 disables). A bucket
    holds whole orders; the fact deals a hot order over tasks again
    (``facts.fan_out``)."""
    spark = src[STAGING_ORDER[0]].sparkSession
    n = bucket_count(spark, [src[name] for name in ORDER_KEYED]) if buckets is None else buckets

    def copy(name: str) -> None:
        path = table_path(root, f"stg_{name}")
        if n and name in ORDER_KEYED:
            replace_bucketed_table(src[name], path, bucketed_table_name(root, name), BUCKET_KEY, n)
        else:
            # a bucket spec left from an earlier run must not describe these files
            spark.sql(f"DROP TABLE IF EXISTS {bucketed_table_name(root, name)}")
            replace_table(src[name], path)

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        for f in [pool.submit(copy, name) for name in STAGING_ORDER]:
            f.result()


def _write_new(df: DataFrame, root: str, table: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` to a folder of its own that no reader knows yet; its name relative to ``root``."""
    folder = publish.new_folder(table)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("errorifexists").option("compression", COMPRESSION)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{root.rstrip('/')}/{folder}")
    return folder


def _all_written(root: str, jobs: Mapping[str, Callable[[], DataFrame]], parallelism: int, partition_by: Mapping[str, Sequence[str]]
                 ) -> dict[str, str]:
    """Concurrent writes; table -> folder. A job's scratch tables go when its table is written."""
    spark = SparkSession.active()

    def write(name: str) -> str:
        with scratch_scope(spark):
            return _write_new(jobs[name](), root, name, partition_by.get(name, ()))

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        found = {n: pool.submit(write, n) for n in jobs}
        return {n: f.result() for n, f in found.items()}


def write_warehouse(spark: SparkSession, root: str, run_date: _dt.date | str | None = None,
                    calendar: tuple[str, str] = dims.DEFAULT_CALENDAR, fact_partition_by: Sequence[str] = (),
                    parallelism: int = 4, fact_cluster_by: Sequence[str] = ()) -> dict[str, str]:
    """The six dimensions and the fact from staging, in folders that are not published yet."""
    st = StagedSources(spark, root)
    jobs = {
        "dim_customers": lambda: dims.dim_customers(st, run_date),
        "dim_products": lambda: dims.dim_products(st, run_date),
        "dim_sellers": lambda: dims.dim_sellers(st, run_date),
        "dim_geolocation": lambda: dims.dim_geolocation(st),
        "dim_dates": lambda: dims.dim_dates(spark, *calendar),
        "dim_payments": lambda: dims.dim_payments(st),
        "fact_orders": lambda: z_ordered(facts.fact_orders(st), fact_cluster_by) if fact_cluster_by else facts.fact_orders(st),
    }
    return _all_written(root, jobs, parallelism, {"fact_orders": fact_partition_by})


def build_warehouse(spark: SparkSession, root: str, run_date: _dt.date | str | None = None,
                    calendar: tuple[str, str] = dims.DEFAULT_CALENDAR, fact_partition_by: Sequence[str] = (),
                    parallelism: int = 4) -> None:
    """``write_warehouse``, published."""
    after = publish.current(spark, root)
    publish.publish_tables(spark, root, write_warehouse(spark, root, run_date, calendar, fact_partition_by, parallelism), after)


def write_marts(spark: SparkSession, root: str, warehouse: Mapping[str, DataFrame], parallelism: int = 3) -> dict[str, str]:
    """The three marts from a written warehouse, in folders that are not published yet. The fact's
    per-order rollup is written once (the daily and city marts and the reports read it), and so are the orders'
    numbers, which the sets of orders stored with the marts (``order_sets``) read."""
    fact, geo = warehouse["fact_orders"], warehouse["dim_geolocation"]
    folder = _write_new(facts.rollup_of(fact), root, ROLLUP)
    rollup = spark.read.parquet(f"{root.rstrip('/')}/{folder}")
    with scratch_scope(spark):
        numbered = _write_new(order_sets.order_numbers(rollup), root, order_sets.ORDER_NUMBERS)
    numbers = spark.read.parquet(f"{root.rstrip('/')}/{numbered}")
    jobs = {
        "mart_sales_daily": lambda: marts.mart_sales_daily_from_rollup(rollup),
        "mart_product_performance": lambda: marts.mart_product_performance_from_fact(fact, warehouse["dim_products"]),
        "mart_city_revenue": lambda: marts.mart_city_revenue_from_rollup(rollup, geo),
        order_sets.ORDERS_OF_DAY: lambda: order_sets.orders_of_day(rollup, numbers),
        order_sets.ORDERS_OF_PRODUCT: lambda: order_sets.orders_of_product(fact, numbers),
        order_sets.ORDERS_OF_CITY: lambda: order_sets.orders_of_city(rollup, numbers, geo),
    }
    # rows clustered inside each file by the mart's key, so parquet min/max
    # statistics prune date / product / city lookups
    cluster = {"mart_sales_daily": ["order_date"], "mart_product_performance": ["product_id"],
               "mart_city_revenue": ["geolocation_state", "geolocation_city"],
               order_sets.ORDERS_OF_DAY: ["order_date_key", "word"], order_sets.ORDERS_OF_PRODUCT: ["product_key", "word"],
               order_sets.ORDERS_OF_CITY: ["geolocation_state", "geolocation_city", "word"]}
    sorted_ = {n: (lambda n=n: jobs[n]().sortWithinPartitions(*cluster[n])) for n in jobs}
    # the jobs that shuffle a row per product and order follow the others one by one: the disk holds one such shuffle
    wide = ("mart_product_performance", order_sets.ORDERS_OF_PRODUCT)
    made = _all_written(root, {n: j for n, j in sorted_.items() if n not in wide}, parallelism, {})
    made |= _all_written(root, {n: sorted_[n] for n in wide}, 1, {})
    return {ROLLUP: folder, order_sets.ORDER_NUMBERS: numbered, **made}


def publish_marts(spark: SparkSession, root: str, parallelism: int = 3) -> None:
    """Marts and rollup of the warehouse as it is, published together."""
    after = publish.current(spark, root)
    warehouse = {t: read_table(spark, root, t) for t in ("fact_orders", "dim_products", "dim_geolocation")}
    publish.publish_tables(spark, root, write_marts(spark, root, warehouse, parallelism), after)


class DataQualityError(RuntimeError):
    """A gate between layers found duplicate or NULL keys."""


def _gate(checked: DataFrame, layer: str) -> None:
    bad = checked.where(~F.col("ok")).collect()  # at most one row per checked table
    if bad:
        raise DataQualityError(f"{layer}: key check failed for " + ", ".join(
            f"{r.table_name}({r.key_columns}): {r.n_null_keys} NULL, {r.n_duplicate_keys} duplicated" for r in bad))


# References the fact's joins rest on; others are reported, not gated (a dangling one there is data, e.g. an
# untranslated category).
GATED_REFERENCES = {("orders", "customer_id"), ("order_items", "order_id"), ("payments", "order_id")}


def gate_sources(spark: SparkSession, root: str) -> None:
    st = StagedSources(spark, root)
    specs = {t: spec.primary_key for t, spec in SOURCES.items() if spec.primary_key}
    _gate(quality.primary_keys({t: st[t] for t in specs}, specs), "staging")
    refs = [(t, c, pt, pc) for t, spec in SOURCES.items() for c, pt, pc in spec.foreign_keys if (t, c) in GATED_REFERENCES]
    bad = quality.foreign_keys({n: st[n] for n in STAGING_ORDER}, refs).where(~F.col("ok")).collect()  # one row per reference
    if bad:
        raise DataQualityError("staging: dangling references in " + ", ".join(
            f"{r.child_table}.{r.child_column}: {r.dangling_rows}" for r in bad))


def gate_marts(written: Mapping[str, DataFrame]) -> None:
    _gate(quality.primary_keys({m: written[m] for m in MART_KEYS}, MART_KEYS), "mart")


def run(spark: SparkSession, src: Mapping[str, DataFrame], root: str, run_date: _dt.date | str | None = None,
        calendar: tuple[str, str] = dims.DEFAULT_CALENDAR, fact_partition_by: Sequence[str] = (),
        gates: bool = True, buckets: int | None = None, fact_cluster_by: Sequence[str] = ()) -> str:
    """Whole refresh in dependency order; returns ``root``.

    ``fact_partition_by``: a folder per value of these columns. ``fact_cluster_by``: the fact's files laid along the Z order of
    these columns (``operators.zorder``), so that the file statistics prune lookups on each of them; one of the two.

    ``gates``: stop before building on staged sources whose primary keys are
    NULL or duplicated or whose order and customer references dangle, and publish
    nothing where the marts' keys are NULL or duplicated. The previous
    publication stays readable; older ones are dropped.
    """
    if fact_partition_by and fact_cluster_by:
        raise ValueError("partition the fact or cluster it, not both")
    after = publish.current(spark, root)
    with scratch_scope(spark), shuffles_dropped(spark), width_for(spark, [src[name] for name in ORDER_KEYED]):
        stage(src, root, buckets)
        if gates:
            gate_sources(spark, root)
        folders = write_warehouse(spark, root, run_date, calendar, fact_partition_by, fact_cluster_by=fact_cluster_by)

        def written(names) -> dict[str, DataFrame]:
            return {t: spark.read.parquet(f"{root.rstrip('/')}/{folders[t]}") for t in names}

        folders |= write_marts(spark, root, written(folders))
        if gates:
            gate_marts(written(MART_KEYS))
        publish.publish_tables(spark, root, folders, after)
    publish.vacuum(spark, root)
    return root


def reports_from_warehouse(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The BI reports over a built warehouse (from the fact, its rollup, the
    dimensions and the marts)."""
    one = publish.Snapshot(spark, root)                     # all reports read one publication
    rollup, fact, sales = one[ROLLUP], one["fact_orders"], one["mart_sales_daily"]
    return {
        "report_revenue_by_month": reports.revenue_by_month(rollup, one["dim_dates"]),
        "report_orders_by_status": reports.orders_by_status(rollup),
        "report_units_by_category": reports.units_by_category(fact.withColumn("fanout", F.lit(1).cast("long")),
                                                              one["dim_products"]),
        "report_revenue_by_city": reports.revenue_by_city(rollup, one["dim_geolocation"], on_zip=False),
        "report_sales_daily": reports.report_sales_daily(sales),
        "report_top20_products": reports.report_top20_products(one["mart_product_performance"]),
        "report_top20_cities": reports.report_top20_cities(one["mart_city_revenue"]),
        "report_total_revenue_all_days": reports.report_total_revenue_all_days(sales),
        "report_total_orders_all_days": reports.report_total_orders_all_days(sales),
    }


def order_counts(spark: SparkSession, root: str) -> DataFrame:
    """Distinct orders at every level of date, product and place, from the published sets of orders."""
    return order_sets.order_counts(publish.Snapshot(spark, root))


def present_tables(spark: SparkSession, root: str) -> dict[tuple[str, str], DataFrame]:
    """{(layer, table): frame} for every manifest table found under ``root``."""
    out = {}
    for layer, tables in MANIFEST.items():
        for t in tables:
            p = table_path(root, t)
            if table_exists(spark, p):
                out[(layer, t)] = spark.read.parquet(p)
    return out


def checks(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Data checks over a built warehouse (row counts, table set, keys)."""
    st = StagedSources(spark, root)
    src = {n: st[n] for n in STAGING_ORDER}
    fks = [(t, c, pt, pc) for t, spec in SOURCES.items() for c, pt, pc in spec.foreign_keys]
    pks = {t: spec.primary_key for t, spec in SOURCES.items() if spec.primary_key}
    mart_tables = {m: read_table(spark, root, m) for m in MART_KEYS if table_exists(spark, table_path(root, m))}
    limits = {t: spec.lengths for t, spec in SOURCES.items()}
    return {
        "row_counts": quality.row_counts(present_tables(spark, root)),
        "tables": quality.expected_tables(spark, MANIFEST, present_tables(spark, root)),
        "foreign_keys": quality.foreign_keys(src, fks),
        "primary_keys": quality.primary_keys({**src, **mart_tables},
                                             {**pks, **{m: k for m, k in MART_KEYS.items() if m in mart_tables}}),
        "lengths": quality.lengths({**src, **mart_tables},
                                   {**limits, **{m: n for m, n in MART_LENGTHS.items() if m in mart_tables}}),
    }
