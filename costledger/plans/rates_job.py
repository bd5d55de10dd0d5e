"""The daily rate load: landed API payloads -> rows -> append.

The HTTP fetch itself is not part of the library; a payload lands as a JSON
file (the response body) and this job turns every landed payload into rate
rows and appends them to the rates table."""
from __future__ import annotations

from pyspark.sql import SparkSession

from ..session import materialize
from ..sinks.rates import fold_newest
from ..sinks.tables import append_rates
from ..sources.rates import read_rates_payloads, require_not_null


class NoRates(RuntimeError):
    pass


def load_rates(spark: SparkSession, payload_path: str, rates_table: str,
               fetch_date: str | None = None) -> int:
    """Append the rates of the payloads under ``payload_path`` and fold them
    into the kept newest rates; stops without writing when they hold no rate
    at all (F11).  Returns the rows appended."""
    # Parsed once; checked, appended and counted from the written copy.
    rows = materialize(require_not_null(read_rates_payloads(spark, payload_path, fetch_date)))
    n = rows.count()
    if n == 0:
        raise NoRates(f"no exchange rate in {payload_path}")
    append_rates(rows, rates_table)
    fold_newest(spark, rates_table)
    return n
