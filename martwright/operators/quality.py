"""Data checks: row counts, expected tables, foreign keys, primary keys,
column lengths. Each returns a small result frame (one row per table, key or
column); the work is distributed aggregation over the checked tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """(layer, table_name, row_count, non_empty) for {(layer, name): frame}."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
             for (layer, name), df in tables.items()]
    return _union(parts).withColumn("non_empty", F.col("row_count") > 0)


def expected_tables(spark: SparkSession, manifest: Mapping[str, Sequence[str]],
                    present: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """(layer, table_name, present, row_count) for every manifest entry; a
    missing table has present=false and a NULL count."""
    schema = T.StructType([T.StructField("layer", T.StringType()), T.StructField("table_name", T.StringType())])
    wanted = spark.createDataFrame([(layer, t) for layer, ts in manifest.items() for t in ts], schema)
    found = row_counts(present).select("layer", "table_name", "row_count") if present else \
        spark.createDataFrame([], "layer string, table_name string, row_count long")
    return (wanted.join(found, ["layer", "table_name"], "left")
            .select("layer", "table_name", F.col("row_count").isNotNull().alias("present"), "row_count"))


def foreign_key(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """(child_rows, dangling_rows) for one foreign key. The child is
    pre-aggregated per key value, so a hot key crosses the shuffle as one row."""
    per_key = (child.where(F.col(child_col).isNotNull())
               .groupBy(F.col(child_col).alias("_mw_k")).agg(F.count(F.lit(1)).alias("_mw_n")))
    keys = parent.select(F.col(parent_col).alias("_mw_p")).where(F.col("_mw_p").isNotNull()).distinct()
    j = per_key.join(keys, per_key["_mw_k"] == keys["_mw_p"], "left")
    return j.agg(F.coalesce(F.sum("_mw_n"), F.lit(0)).cast("long").alias("child_rows"),
                 F.coalesce(F.sum(F.when(F.col("_mw_p").isNull(), F.col("_mw_n"))), F.lit(0))
                 .cast("long").alias("dangling_rows"))


def foreign_keys(tables: Mapping[str, DataFrame], specs: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """specs: (child_table, child_column, parent_table, parent_column)."""
    parts = [foreign_key(tables[ct], cc, tables[pt], pc)
             .select(F.lit(ct).alias("child_table"), F.lit(cc).alias("child_column"),
                     F.lit(pt).alias("parent_table"), F.lit(pc).alias("parent_column"),
                     "child_rows", "dangling_rows")
             for ct, cc, pt, pc in specs]
    return _union(parts).withColumn("ok", F.col("dangling_rows") == 0)


def primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(n_rows, n_null_keys, n_duplicate_keys) for one declared key."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_mw_n"))
    return per_key.agg(
        F.coalesce(F.sum("_mw_n"), F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum(F.when(any_null, F.col("_mw_n"))), F.lit(0)).cast("long").alias("n_null_keys"),
        F.count(F.when(~any_null & (F.col("_mw_n") > 1), F.lit(1))).cast("long").alias("n_duplicate_keys"))


def primary_keys(tables: Mapping[str, DataFrame], specs: Mapping[str, Sequence[str]]) -> DataFrame:
    parts = [primary_key(tables[t], ks).select(F.lit(t).alias("table_name"),
                                               F.lit(",".join(ks)).alias("key_columns"),
                                               "n_rows", "n_null_keys", "n_duplicate_keys")
             for t, ks in specs.items()]
    return _union(parts).withColumn("ok", (F.col("n_null_keys") == 0) & (F.col("n_duplicate_keys") == 0))


def lengths(tables: Mapping[str, DataFrame], limits: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """(table_name, column_name, max_length, length_limit, within_limit)."""
    parts = []
    for t, cols in limits.items():
        if not cols:
            continue
        agg = tables[t].agg(*[F.max(F.length(F.col(c))).alias(c) for c in cols])
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("int").alias("max_length"),
                                  F.lit(n).alias("length_limit")) for c, n in cols.items()])
        parts.append(agg.select(F.lit(t).alias("table_name"), F.inline(rows)))
    out = _union(parts)
    return out.withColumn("within_limit", F.coalesce(F.col("max_length") <= F.col("length_limit"), F.lit(True)))
