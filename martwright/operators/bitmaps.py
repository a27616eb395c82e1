"""Exact distinct counts that roll up: bitmaps over dense key numbers, kept as rows.

COUNT(DISTINCT key) cannot be added up: a key may occur in several groups. A bitmap can: number the keys 0, 1, 2, ...
(``number_keys``), set one bit per key of a group, and the bitmap of a coarser group is the OR of its groups'. A bitmap is
rows (group columns, ``word``, ``bits``): ``bits`` has the 64 numbers from ``64 * word``, and words without a bit have no row.
So it is a mergeable aggregate in plain columns:

* building, merging and counting are hash aggregates of 64-bit values, combined before each shuffle;
* a group that holds all keys is many rows, dealt over tasks by (group, word), never one large value;
* keys numbered in the order of the groups (orders by day) lie side by side: a day of n orders takes about n / 64 rows. A group
  whose keys lie far apart takes up to a row per key, the size of the distinct pairs it stands for.

Numbers are given once: ``number_keys(known=...)`` numbers only new keys, after the known ones, so the bitmaps of a later load can
be merged with stored ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import dense_key

WORD, BITS = "word", "bits"


def number_keys(keys: DataFrame, key: str, order_by: Sequence[Column], number: str, known: DataFrame | None = None) -> DataFrame:
    """(key, ``number``) of every distinct non-NULL ``key``: 0, 1, 2, ... in ``order_by`` (aggregates over a key's rows).

    ``known`` holds (key, ``number``) given before: only keys that are not there are returned, numbered after the largest."""
    order = [c.alias(f"_mw_o{i}") for i, c in enumerate(order_by)]
    per_key = keys.where(F.col(key).isNotNull()).groupBy(key).agg(*order) if order else keys.where(F.col(key).isNotNull()).select(key).distinct()
    first = 0
    if known is not None:
        per_key = per_key.join(known.select(key), key, "left_anti")
        last = known.agg(F.max(number)).first()[0]
        first = 0 if last is None else last + 1
    ranked = dense_key(per_key, [*[F.col(f"_mw_o{i}").asc_nulls_last() for i in range(len(order))], F.col(key).asc()], number)
    return ranked.select(key, (F.col(number) - 1 + F.lit(first)).cast("long").alias(number))


def build(rows: DataFrame, groups: Sequence[str], number: str) -> DataFrame:
    """Bitmap of the numbers of each group (NULL is a group; NULL numbers set no bit)."""
    n = F.col(number).cast("long")
    bit = F.expr(f"shiftleft(1L, CAST(CAST(`{number}` AS BIGINT) & 63 AS INT))")
    return merge(rows.where(n.isNotNull()).select(*groups, F.shiftright(n, 6).alias(WORD), bit.alias(BITS)), groups)


def merge(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """OR of bitmaps (of finer groups, or of several loads) per ``groups``."""
    return bitmaps.groupBy(*groups, WORD).agg(F.bit_or(BITS).alias(BITS))


def cardinality(bitmaps: DataFrame, groups: Sequence[str], count: str = "n") -> DataFrame:
    """Numbers set per group, of bitmaps with one row per (group, word)."""
    bits = F.coalesce(F.sum(F.bit_count(BITS).cast("long")), F.lit(0)).cast("long").alias(count)
    return bitmaps.groupBy(*groups).agg(bits) if groups else bitmaps.agg(bits)


def count_distinct(bitmaps: DataFrame, groups: Sequence[str], count: str = "n") -> DataFrame:
    """Distinct numbers per (coarser) group."""
    return cardinality(merge(bitmaps, groups), groups, count)
