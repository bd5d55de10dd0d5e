"""Keep the highest-cost row per key, sort by cost."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import nan_to_null
from ..schemas import KEYS


def cost_order(cost: str = "cost", tie_breakers: Sequence[str] = ()):
    """Cost descending with NaN and NULL last, then the tie-breakers ascending."""
    return [nan_to_null(cost).desc_nulls_last(),
            *[F.col(c).asc_nulls_last() for c in tie_breakers]]


def keep_highest_cost(df: DataFrame, keys: Sequence[str] = KEYS, cost: str = "cost",
                      tie_breakers: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one with the highest cost.  NULL key parts group
    together.  ``row_number() == 1`` lets Spark plan a partial group limit
    before the shuffle, so a hot key leaves each map task as a single row."""
    w = Window.partitionBy(*keys).orderBy(*cost_order(cost, tie_breakers))
    return (df.withColumn("_rank", F.row_number().over(w))
              .filter(F.col("_rank") == 1).drop("_rank"))


def top_by_cost(df: DataFrame, n: int, cost: str = "cost",
                tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The ``n`` highest-cost rows (a distributed top-k, not a global sort)."""
    return df.orderBy(*cost_order(cost, tie_breakers)).limit(n)


def rank_by_cost(df: DataFrame, out: str = "cost_rank", cost: str = "cost",
                 tie_breakers: Sequence[str] = ()) -> DataFrame:
    """L1 over the whole frame: every row with its position in the order cost
    descending (NaN and NULL last), then the tie-breakers.  A distributed
    global rank (``sequence.rank_in_order``), not a single-task sort."""
    from .sequence import rank_in_order
    return rank_in_order(df, cost_order(cost, tie_breakers), out)
