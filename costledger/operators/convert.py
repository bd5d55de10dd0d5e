"""Convert cost to US dollars and stamp lineage."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_missing_number, nan_to_null, utc_instant
from ..schemas import KEYS
from .dedup import keep_highest_cost
from .sizing import known_size


def _rate_side(lookup: DataFrame, materialize: bool = True) -> DataFrame:
    return known_size(lookup.select(
        F.col("currency_code").alias("_fx_currency"), F.col("rate").alias("_fx_rate")),
        materialize=materialize)


def attach_rate(df: DataFrame, lookup: DataFrame, how: str = "inner",
                materialize: bool = True) -> DataFrame:
    """Join the one-row-per-currency ``lookup`` (``currency_code``, ``rate``)
    as ``_fx_rate``.  The lookup is written, so Spark knows it is small and
    never shuffles the big side for it.  Currency match is exact.  ``materialize``
    writes the lookup once first (off when it is already a written table)."""
    return (df.join(_rate_side(lookup, materialize), F.col("currency") == F.col("_fx_currency"), how)
              .drop("_fx_currency"))


def finish_usd(df: DataFrame, policy: str = "drop", convention: str = "multiply",
               keep_rate: bool = False) -> DataFrame:
    """Compute ``cost_usd`` from ``_fx_rate`` (see ``to_usd``)."""
    cost, rate = F.col("cost").cast("double"), F.col("_fx_rate")
    if convention == "multiply":
        usd = cost * rate
    elif convention == "divide":
        usd = F.try_divide(cost, rate)
    else:
        raise ValueError(f"unknown convention {convention!r}")
    if policy == "drop":
        out = df.withColumn("cost_usd", usd).filter(~is_missing_number("cost_usd"))
    elif policy == "legacy":
        out = df.withColumn("cost_usd", F.when(rate != 0, nan_to_null(usd)))
    else:
        raise ValueError(f"unknown policy {policy!r}")
    return out.withColumnRenamed("_fx_rate", "rate") if keep_rate else out.drop("_fx_rate")


def to_usd(df: DataFrame, lookup: DataFrame, policy: str = "drop",
           convention: str = "multiply", keep_rate: bool = False) -> DataFrame:
    """Add ``cost_usd``.

    ``drop`` (default): rows without a rate, or whose result is NULL/NaN, are
    dropped; a rate of 0 is valid.  ``legacy``: every row is kept and
    ``cost_usd`` is NULL when the rate is missing or 0.  ``convention``
    ``divide`` reads rates as units per dollar."""
    how = "inner" if policy == "drop" else "left"
    return finish_usd(attach_rate(df, lookup, how), policy, convention, keep_rate)


def process_ad_rows(ads: DataFrame, lookup: DataFrame, policy: str = "drop",
                    tie_breakers: Sequence[str] = ("file_name",),
                    keys: Sequence[str] = KEYS, convention: str = "multiply",
                    materialize_rates: bool = True, per_file: str | None = None) -> DataFrame:
    """I4 over any number of files at once: keep the highest-cost row per key,
    then convert.  With ``per_file`` (a column that tells files apart) a
    file whose top row converts to nothing drops out of the key, as it would
    alone, and the best row of the other files stays; without it the top row
    of all files decides, which is the same unless an infinite cost meets a
    rate of 0.

    The currency is part of the key, so a key group has a rate for all its
    rows or for none: under ``drop`` the rate join runs before the dedup and
    rows that would be dropped never reach the shuffle.  The NULL/NaN check of
    the result still runs after the dedup, as in the per-file job."""
    how = "inner" if policy == "drop" else "left"
    with_rate = attach_rate(ads, lookup, how, materialize_rates)
    if per_file and policy == "drop":
        with_rate = finish_usd(keep_highest_cost(with_rate, [*keys, per_file], "cost", tie_breakers),
                               policy, convention, keep_rate=True) \
            .withColumnRenamed("rate", "_fx_rate").drop("cost_usd")
    deduped = keep_highest_cost(with_rate, keys, "cost", tie_breakers)
    return finish_usd(deduped, policy, convention)


def stamp_lineage(df: DataFrame, file_version_id, run_ts) -> DataFrame:
    """Add ``file_version_id`` and one processing timestamp for the whole run."""
    ts = run_ts if isinstance(run_ts, Column) else utc_instant(run_ts)
    return df.withColumns({
        "file_version_id": file_version_id,
        "last_processed_timestamp": ts.cast("timestamp"),
    })
