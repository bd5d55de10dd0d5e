"""Exchange rates: payload -> rows, newest per currency, global snapshot."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import RATES_PAYLOAD_MAP


def parse_rates_payload(text: Column | str, field: str | None = "rates") -> Column:
    """JSON text -> map currency -> rate.  With ``field`` the map sits under
    that key of the object; an absent or unreadable map becomes an empty map."""
    text = F.col(text) if isinstance(text, str) else text
    if field is None:
        parsed = F.from_json(text, RATES_PAYLOAD_MAP)
    else:
        parsed = F.from_json(text, f"struct<{field}: {RATES_PAYLOAD_MAP}>")[field]
    return F.coalesce(parsed, F.create_map().cast(RATES_PAYLOAD_MAP))


def explode_rates(df: DataFrame, rates_map: Column | str, date: Column,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (currency, rate) of the map, stamped with ``date``."""
    rates_map = F.col(rates_map) if isinstance(rates_map, str) else rates_map
    return df.select(*keep, date.cast("date").alias("date"),
                     F.explode(rates_map).alias("currency_code", "rate"))


def latest_rate_per_currency(rates: DataFrame) -> DataFrame:
    """Newest rate per currency; duplicate rows of one date resolve to the
    highest rate.  NULL dates lose to any date."""
    w = Window.partitionBy("currency_code").orderBy(
        F.col("date").desc_nulls_last(), F.col("rate").desc_nulls_last())
    return (rates.select("currency_code", "date", "rate")
                 .withColumn("_rank", F.row_number().over(w))
                 .filter(F.col("_rank") == 1).drop("_rank"))


def rates_on_latest_date(rates: DataFrame) -> DataFrame:
    """Rates of the single newest date in the table (scalar subquery), one per
    currency; duplicates resolve to the highest rate."""
    newest = rates.select(F.max("date")).scalar()
    return (rates.filter(F.col("date") == newest)
                 .groupBy("currency_code")
                 .agg(F.max("date").alias("date"), F.max("rate").alias("rate")))


def rate_lookup(rates: DataFrame, policy: str = "latest") -> DataFrame:
    """``latest``: newest rate per currency.  ``snapshot``: only currencies
    quoted on the newest date of the table.  ``lookup``: ``rates`` already
    holds one row per currency (and is a written table: it is not written
    again)."""
    if policy == "lookup":
        return rates
    if policy == "latest":
        return latest_rate_per_currency(rates)
    if policy == "snapshot":
        return rates_on_latest_date(rates)
    raise ValueError(f"unknown rate policy {policy!r}")
