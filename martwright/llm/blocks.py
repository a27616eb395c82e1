"""Rows dealt into numbered blocks of about a given size, written once and read block by block."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

BLOCK_COL = "_mw_block"


def dealt(rows: DataFrame, key: str, weight: Column, size: int, label: str) -> tuple[Callable[[int], DataFrame], list[int]]:
    """A reader of one block, and the numbers of the blocks that have rows.

    ``weight``: aggregate whose value over all rows, divided by ``size``, is the number of blocks. Rows go to blocks by hash of
    ``key`` (the rows of a key stay together), so blocks are of about equal weight; only their numbers pass through the driver here."""
    spark, columns = rows.sparkSession, rows.columns
    total = rows.agg(weight.alias("w")).first()[0] or 0
    n = max(1, -(-int(total) // size))
    path = scratch_path(spark, label)
    (rows.withColumn(BLOCK_COL, F.pmod(F.xxhash64(key), F.lit(n))).repartition(BLOCK_COL)
     .write.partitionBy(BLOCK_COL).parquet(path))
    if not total:
        return (lambda b: rows.limit(0)), []
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    back = spark.read.schema(f"{schema}, {BLOCK_COL} long").parquet(path)
    found = sorted(r[0] for r in back.select(BLOCK_COL).distinct().collect())
    return (lambda b: back.where(F.col(BLOCK_COL) == b).select(*columns)), found
