"""Row-maintenance and file jobs run against tables staged from the data.

Each job stages a source table into a fresh scratch folder under the shared
checkpoint directory, applies the operation there and returns the table as
read back, so the whole write path (swap, append, file formats) is exercised.
The change batches are derived from the driver tables, not made up:

* upsert: customers of the BUILDING segment arrive twice (sequence 1, then 2:
  the later version must win) and every supplier arrives as a new customer;
* delete: the orders of priority 5-LOW plus one key that does not exist;
* append: sellers into an empty table created like the sellers table, then
  customers re-shaped as sellers with their columns in another order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dml
from ..operators.keyed import KeyedTable
from ..session import scratch_path, shuffle_width
from ..sources import files
from ..sources.fixtures import Sources, _place
from ..sources.schemas import SOURCES, SRC_POS, STAGING_ORDER

UPSERT_SEGMENT = "BUILDING"
DELETE_PRIORITY = "5-LOW"
UNKNOWN_ORDER = "no-such-order"
DUMP_TABLE_NAME = "staging.stg_order_reviews"


def customer_changes(src: Sources) -> DataFrame:
    c = src.driver("customer")
    place = F.broadcast(_place(src.driver))
    moved = c.where(F.col("c_mktsegment") == UPSERT_SEGMENT).join(place, c.c_nationkey == F.col("n_nationkey"))
    base = [F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("customer_unique_id")]
    v1 = moved.select(*base, F.col("zip").alias("customer_zip_code_prefix"),
                      F.concat("city", F.lit("-1")).alias("customer_city"), F.col("state").alias("customer_state"),
                      F.lit(1).alias("seq"))
    v2 = moved.select(*base, (F.col("zip") + 1).alias("customer_zip_code_prefix"),
                      F.concat("city", F.lit("-2")).alias("customer_city"), F.col("state").alias("customer_state"),
                      F.lit(2).alias("seq"))
    s = src.driver("supplier")
    new = s.join(place, s.s_nationkey == F.col("n_nationkey")).select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("customer_id"),
        F.col("s_name").alias("customer_unique_id"), F.col("zip").alias("customer_zip_code_prefix"),
        F.col("city").alias("customer_city"), F.col("state").alias("customer_state"), F.lit(1).alias("seq"))
    return v1.unionByName(v2).unionByName(new)


def upsert_customers(spark: SparkSession, src: Sources) -> DataFrame:
    """Through a keyed table: only the files that hold a changed customer are rewritten."""
    path = scratch_path(spark, "upsert") + "/customers"
    table = KeyedTable.create(src["customers"], path, ["customer_id"], slots=shuffle_width(spark))
    return table.upsert(customer_changes(src), "seq").read()


def orders_to_delete(src: Sources) -> DataFrame:
    o = src.driver("orders")
    keys = o.where(F.col("o_orderpriority") == DELETE_PRIORITY).select(
        F.col("o_orderkey").cast("string").alias("order_id"))
    unknown = src.spark.createDataFrame([(UNKNOWN_ORDER,)], "order_id string")
    return keys.unionByName(unknown)


def delete_orders(spark: SparkSession, src: Sources) -> DataFrame:
    """Through a keyed table: the delete writes keys alone, and reading applies them."""
    path = scratch_path(spark, "delete") + "/orders"
    table = KeyedTable.create(src["orders"], path, ["order_id"], slots=shuffle_width(spark))
    return table.delete(orders_to_delete(src)).read()


def customers_as_sellers(src: Sources) -> DataFrame:
    c = src["customers"]
    return c.select(F.col("customer_state").alias("seller_state"), F.col("customer_city").alias("seller_city"),
                    F.col("customer_zip_code_prefix").alias("seller_zip_code_prefix"),
                    F.concat(F.lit("c"), F.col("customer_id")).alias("seller_id"))


def append_sellers(spark: SparkSession, src: Sources) -> DataFrame:
    path = scratch_path(spark, "append") + "/sellers"
    dml.create_table_like(spark, src["sellers"], path)
    dml.append_rows(src["sellers"], path)
    dml.append_rows(customers_as_sellers(src), path)
    return spark.read.parquet(path)


def truncate_orders(spark: SparkSession, src: Sources) -> DataFrame:
    """Rows of the table before and after."""
    path = scratch_path(spark, "truncate") + "/orders"
    dml.replace_table(src["orders"], path)
    before = spark.createDataFrame([("before", spark.read.parquet(path).count())], "stage string, n_rows long")
    dml.truncate_table(spark, path)
    after = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("after").alias("stage"), "n_rows")
    return before.unionByName(after)


def _dump_reviews(spark: SparkSession, src: Sources) -> str:
    return dml.dump_table(src["order_reviews"], scratch_path(spark, "dump"), DUMP_TABLE_NAME)


def dump_reviews(spark: SparkSession, src: Sources) -> DataFrame:
    """Dump manifest: table, file name and the rows that read back."""
    path = _dump_reviews(spark, src)
    back = files.reload_dump(spark, path, SOURCES["order_reviews"].schema)
    return back.agg(F.count(F.lit(1)).alias("rows_written")).select(
        F.lit(DUMP_TABLE_NAME).alias("table_name"), F.lit(dml.dump_file_name(DUMP_TABLE_NAME)).alias("file_name"),
        "rows_written")


def reload_reviews(spark: SparkSession, src: Sources) -> DataFrame:
    """Dump, then load the dump into a fresh table created like the source."""
    path = _dump_reviews(spark, src)
    table = scratch_path(spark, "reload") + "/order_reviews"
    dml.create_table_like(spark, src["order_reviews"], table)
    dml.append_rows(files.reload_dump(spark, path, SOURCES["order_reviews"].schema), table)
    return spark.read.parquet(table)


def load_reviews_csv(spark: SparkSession, src: Sources) -> DataFrame:
    """Reviews (free text with commas, quotes and line breaks) written as a
    CRLF delimited file with a header, then bulk-loaded with the schema by tasks
    that each read a byte range, wherever records begin."""
    path = dml.write_csv(src["order_reviews"], scratch_path(spark, "csv") + "/order_reviews", line_sep="\r\n")
    return files.read_csv(spark, path, SOURCES["order_reviews"].schema, split_records=True)


def load_csv_tables(spark: SparkSession, src: Sources) -> DataFrame:
    """All nine source tables written as delimited files and bulk-loaded again:
    rows, values and characters of every loaded column."""
    folder = scratch_path(spark, "csv-tables")
    for name in STAGING_ORDER:
        dml.write_csv(src[name].drop(SRC_POS), f"{folder}/{name}.csv", line_sep="\r\n")
    loaded = files.CsvSources(spark, folder)

    def measured(name: str) -> DataFrame:
        df, fields = loaded[name].drop(SRC_POS), SOURCES[name].schema.fields
        text = {f.name for f in fields if f.dataType.simpleString() == "string"}
        one = df.agg(F.array(*[F.struct(
            F.lit(f.name).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count(f.name).alias("n_values"),
            (F.sum(F.length(f.name)) if f.name in text else F.lit(None)).cast("long").alias("n_chars"))
            for f in fields]).alias("c"))
        return one.select(F.lit(name).alias("table_name"), F.explode("c").alias("c")).select("table_name", "c.*")

    return reduce(DataFrame.unionByName, [measured(n) for n in STAGING_ORDER])


def orders_by_status_records(spark: SparkSession, src: Sources) -> DataFrame:
    """A statement over a registered staging table whose rows (one per status)
    are fetched with ``files.get_records``."""
    src["orders"].createOrReplaceTempView("stg_orders")
    found = spark.sql("SELECT order_status, COUNT(*) AS order_count FROM stg_orders GROUP BY order_status")
    return spark.createDataFrame([tuple(r) for r in files.get_records(found)], found.schema)
