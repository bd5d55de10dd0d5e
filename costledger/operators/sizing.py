"""Joins against small sides: written, so that Spark knows their size."""
from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import materialize as materialize_df


def known_size(df: DataFrame, materialize: bool = True) -> DataFrame:
    """``df``, written once unless it is a written table already.  The planner
    then has its exact size in bytes and broadcasts it, or shuffles, by that;
    an expensive side is computed once and survives executor loss."""
    return materialize_df(df) if materialize else df
