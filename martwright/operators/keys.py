"""Key operators: distributed positional keys, category codes, keep-first.

``dense_key`` replaces a frame's ``index + 1``: a dense 1..N key in a declared
row order, computed without a single-partition window:

1. range-partition on the order columns and sort inside each partition;
2. write the rows with their partition and in-partition position to a scratch
   table, so both are fixed (a lost task re-reads it, it does not sample again);
3. count rows per partition -> running offsets (one row per partition, a
   proven size bound, so it is broadcast);
4. key = offset[partition] + position in partition + 1.

``stable_key`` does the same for orders with many equal values: the rows are
written with their input position first, which completes the order, so a range
boundary can lie inside a value and no task holds a whole value.

``keep_first`` is a grouped ``min(struct(order, row))``: partial aggregation
collapses a hot key to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_ROW_BITS = 33  # monotonically_increasing_id(): partition id << 33 | row index


def numeric_id_order(col: str) -> list[Column]:
    """Order by an id as a number, then by its text (non-numeric ids last)."""
    return [F.expr(f"try_cast(`{col}` AS BIGINT)").asc_nulls_last(), F.col(col).asc_nulls_last()]


def dense_key(df: DataFrame, order_by: Sequence[Column], key_col: str,
              num_partitions: int | None = None, persist_input: bool = False) -> DataFrame:
    """Append ``key_col`` (bigint) = 1-based position of the row in ``order_by``.

    ``persist_input``: the range shuffle evaluates its input twice (bounds
    sampling, then the map stage); persist an expensive input (joins,
    aggregates) for that span instead of recomputing it. The scratch table
    goes with its ``scratch_scope``.
    """
    spark = df.sparkSession
    cols = df.columns
    source = df.persist(StorageLevel.MEMORY_AND_DISK) if persist_input else df
    # Without an explicit count AQE may merge adjacent range partitions (the
    # order across partitions is kept); the scratch table then fixes them.
    ranged = (source.repartitionByRange(num_partitions, *order_by) if num_partitions
              else source.repartitionByRange(*order_by))
    ordered = ranged.sortWithinPartitions(*order_by).withColumn("_mw_id", F.monotonically_increasing_id())
    path = scratch_path(spark, "ordered")
    try:
        ordered.write.parquet(path)
    finally:
        if persist_input:
            source.unpersist()
    tagged = spark.read.schema(ordered.schema).parquet(path)
    tagged = tagged.select(*cols,
                           F.shiftright("_mw_id", _ROW_BITS).alias("_mw_part"),
                           F.col("_mw_id").bitwiseAND((1 << _ROW_BITS) - 1).alias("_mw_pos"))
    counts = tagged.groupBy("_mw_part").agg(F.count(F.lit(1)).alias("_mw_n"))
    before = Window.orderBy("_mw_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_mw_part", F.coalesce(F.sum("_mw_n").over(before), F.lit(0)).alias("_mw_off"))
    # one row per partition of the range shuffle: bounded by the shuffle width
    keyed = tagged.join(F.broadcast(offsets), "_mw_part")
    return keyed.select(*cols, (F.col("_mw_off") + F.col("_mw_pos") + 1).cast("long").alias(key_col))


def stable_key(df: DataFrame, order_by: Sequence[Column], key_col: str, num_partitions: int | None = None) -> DataFrame:
    """``dense_key`` for an order with equal values, as a stable sort: rows that
    are equal in ``order_by`` keep the order they have in ``df``.

    The input position (partition, then row) is written with the rows, so a
    lost task reads the same one again, and is the last part of the order. The
    ranges are cut on the whole order: a value that holds most rows, identical
    ones included, is spread over as many ranges as its rows need. Equal
    values cost 8 bytes a row and one more write, nothing else.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "positioned")
    positioned = df.withColumn("_mw_at", F.monotonically_increasing_id())
    positioned.write.parquet(path)
    rows = spark.read.schema(positioned.schema).parquet(path)
    return dense_key(rows, [*order_by, F.col("_mw_at").asc()], key_col, num_partitions).drop("_mw_at")


def keep_first(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """First row per ``keys`` in ``order_cols`` order (pandas ``drop_duplicates``
    keep='first'); NULL keys form one group. Column order is preserved."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.min(F.struct(*[F.col(c) for c in [*order_cols, *rest]])).alias("_mw_first")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*[F.col(c) if c in keys else F.col(f"_mw_first.`{c}`").alias(c) for c in df.columns])


def rank_values(values: DataFrame, col: str, rank_col: str) -> DataFrame:
    """(value, rank) for a frame of distinct non-NULL values: 1-based rank in
    ascending order."""
    return dense_key(values.select(col), [F.col(col).asc()], rank_col)


def category_code(df: DataFrame, col: str, code_col: str, universe: DataFrame | None = None) -> DataFrame:
    """``astype('category').cat.codes + 1``: dense code of the value in sorted
    order of the distinct values, NULL -> 0. ``universe`` is the frame whose
    distinct values define the categories (default: ``df``)."""
    values = (universe if universe is not None else df).select(F.col(col).alias("_mw_v"))
    values = values.where(F.col("_mw_v").isNotNull()).distinct()
    coded = rank_values(values, "_mw_v", "_mw_code")
    joined = df.join(coded, df[col] == coded["_mw_v"], "left")
    return joined.select(*[F.col(c) for c in df.columns if c != code_col],
                         F.coalesce(F.col("_mw_code"), F.lit(0)).cast("int").alias(code_col))


def _order_struct(order: Sequence[Column]) -> Column:
    """Ascending, NULLs-last order as one comparable struct."""
    fields = []
    for i, e in enumerate(order):
        fields += [e.isNull().alias(f"n{i}"), e.alias(f"v{i}")]
    return F.struct(*fields)


def keep_first_with_position(df: DataFrame, keys: Sequence[str], order: Sequence[Column], key_col: str) -> DataFrame:
    """``keep_first`` plus ``key_col`` = 1-based position of the kept row among
    *all* rows of ``df`` (the gapped key of a positional index assigned before
    de-duplication).

    The order is total: ``order`` (NULLs last), then ``keys``, then the
    remaining columns, so tied rows have different positions. Only the order
    and key columns are sorted; the kept rows come from a map-side aggregate
    and get their key's smallest position.
    """
    keys = list(keys)
    tagged = df.withColumn("_mw_o", _order_struct(order))
    kept = keep_first(tagged, keys, ["_mw_o"]).drop("_mw_o")
    narrow = tagged.select("_mw_o", *[F.col(k).alias(f"_mw_k{i}") for i, k in enumerate(keys)])
    names = narrow.columns[1:]
    positions = dense_key(narrow, [F.col("_mw_o").asc(), *[F.col(n).asc_nulls_last() for n in names]], key_col)
    first = positions.groupBy(*names).agg(F.min(key_col).alias(key_col))
    same = reduce(lambda a, b: a & b, [kept[k].eqNullSafe(first[n]) for k, n in zip(keys, names, strict=True)])
    return kept.join(first, same).select(*[kept[c] for c in df.columns], first[key_col])
