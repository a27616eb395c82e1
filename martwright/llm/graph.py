"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.session import drop_path, scratch_path


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``node, comp``: the smallest node reachable, for nodes that have a link.

    Each round shuffles the links a few times by node and pre-aggregates; a star's hub is never
    gathered in one group, only its minimum. The number of rounds grows with the logarithm of the
    number of nodes. Self-links, repeated and reversed links are allowed; nulls are dropped. A round's links are a
    scratch table, which goes when the next one is written.
    """
    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "component-links")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    edges, path = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    size = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.withColumnRenamed("m", "v")).where("u <> v").distinct())
        old, (edges, path) = path, written(small)
        drop_path(spark, old)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == size:
            break
        size = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots)
