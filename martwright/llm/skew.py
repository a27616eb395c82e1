"""A join that no key can load onto one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from this share of the left rows on (one in SHARE), so there are fewer than SHARE hot keys.
SHARE = 1000


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """Inner join; ``right`` has each key once, with its number of left rows in ``weight`` (``total`` in all).

    Rows of the fewer than ``SHARE`` keys that hold over one in ``SHARE`` of the left rows never shuffle: their right
    rows are broadcast, which that number bounds. All others are joined by key. ``left`` and ``right`` are read
    more than once and should be written tables.
    """
    bound = total // SHARE
    hot = right.where(F.col(weight) > bound)
    rest = right.where(F.col(weight) <= bound)
    cold = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return left.join(F.broadcast(hot), keys).unionByName(cold.join(rest, keys))
