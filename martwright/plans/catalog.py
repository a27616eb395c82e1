"""SQL access to a built warehouse: layers as databases, tables registered
over their folders, typed mart DDL, drop-if-exists, arbitrary statements.

BI tools and ad-hoc SQL then query ``staging.*``, ``warehouse.*`` and
``mart.*`` through the session catalog; Catalyst plans those statements like
any DataFrame job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import publish
from ..operators.dml import table_exists
from ..sources.schemas import MANIFEST, MART_SCHEMAS
from .pipeline import BUCKET_KEY, ORDER_KEYED, table_path


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def register_layers(spark: SparkSession, root: str, buckets: int | None = None) -> list[str]:
    """CREATE DATABASE IF NOT EXISTS per layer, and a table over every table
    folder present under ``root`` (marts with their declared column types).
    ``buckets``: the bucket count the refresh staged the order-keyed tables
    with, declared so SQL joins on ``order_id`` skip the shuffle too.
    Returns the registered ``layer.table`` names."""
    registered = []
    for layer, tables in MANIFEST.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root.rstrip('/')}/{layer}'")
        for t in tables:
            path = table_path(root, t)
            if not table_exists(spark, path):
                continue
            cols = f"({_ddl(MART_SCHEMAS[t])}) " if t in MART_SCHEMAS else ""
            clustered = ""
            if buckets and t.removeprefix("stg_") in ORDER_KEYED:
                cols = f"({_ddl(spark.read.parquet(path).schema)}) "
                clustered = (f"CLUSTERED BY (`{BUCKET_KEY}`) SORTED BY (`{BUCKET_KEY}`) INTO {buckets} BUCKETS ")
            spark.sql(f"DROP TABLE IF EXISTS {layer}.{t}")   # an external table: a new publication has new folders
            spark.sql(f"CREATE TABLE {layer}.{t} {cols}USING parquet {clustered}LOCATION '{path}'")
            if any(c.isPartition for c in spark.catalog.listColumns(f"{layer}.{t}")):
                spark.sql(f"ALTER TABLE {layer}.{t} RECOVER PARTITIONS")  # e.g. a fact partitioned by day
            spark.catalog.refreshTable(f"{layer}.{t}")
            registered.append(f"{layer}.{t}")
    return registered


def execute_sql(spark: SparkSession, statement: str) -> DataFrame:
    """Run one SQL statement against the session catalog."""
    return spark.sql(statement)


def drop_table(spark: SparkSession, layer: str, table: str, root: str | None = None) -> None:
    """DROP TABLE IF EXISTS; with ``root`` also takes the table out of the publication and removes its folder."""
    spark.sql(f"DROP TABLE IF EXISTS {layer}.{table}")
    if root is not None:
        path = table_path(root, table)
        published = publish.Snapshot(spark, root)
        if table in published:
            publish.commit(spark, root, {"tables": {t: f for t, f in published.tables.items() if t != table}}, published.number)
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(p):
            fs.delete(p, True)
