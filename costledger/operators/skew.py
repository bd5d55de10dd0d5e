"""Joins on keys of which a few may hold much of the data."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# At most so many keys can each hold more than one part in HEAVY_KEYS of all
# rows, so the table of those keys is small at any scale and may be broadcast.
HEAVY_KEYS = 1000


def lookup_per_key(left: DataFrame, right: DataFrame, key: str, n_col: str, total: int,
                   how: str = "left") -> DataFrame:
    """Join ``left`` (``total`` rows) with ``right``, which has one row per
    ``key`` and in ``n_col`` (dropped) how many rows of ``left`` have it.
    Keys with more than total/HEAVY_KEYS rows are broadcast, so none of them
    meets in one task; the others are joined by shuffle."""
    cut = total // HEAVY_KEYS + 1
    heavy = right.where(F.col(n_col) > cut).drop(n_col)
    light = right.where(F.col(n_col) <= cut).drop(n_col)
    marked = left.join(F.broadcast(heavy.select(key, F.lit(True).alias("_heavy"))), key, "left")
    hot = marked.where("_heavy").drop("_heavy").join(F.broadcast(heavy), key, "inner")
    cold = marked.where("_heavy IS NULL").drop("_heavy").join(light, key, how)
    return hot.unionByName(cold)
