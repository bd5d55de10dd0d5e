"""The newest rate per currency as a kept aggregate.

The rates table is append-only, a file per load.  Beside it, in
``<table>_newest``, lies an aggregate: the newest rate of each currency over
the loads it covers, and the names of these loads.  A load folds its rows in; a
run reads the aggregate and the loads that are not in it, so neither reads the
history.  The newest (date, rate) is a maximum, so folding load by load gives
what the whole history gives.

Each fold writes a generation of its own and then one line that names it.
Readers go by the last line: a fold that dies is not seen, and its load is read
as one not yet covered.  Two folds at once each cover what they list; the
loser's load is read as not covered until the next fold."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rates import latest_rate_per_currency
from ..schemas import RATES
from .tables import _json_or_none

_LINE = "seq long, path string"


def newest_root(rates_table: str) -> str:
    return f"{rates_table.rstrip('/')}_newest"


def load_names(spark: SparkSession, rates_table: str) -> list[str]:
    """The files of the rates table, one per load (no row is read)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(rates_table)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path) if f.isFile()]
    return sorted(n for n in names if n[0] not in "_.")


def _kept(spark: SparkSession, rates_table: str) -> tuple[int, str | None, list[str]]:
    """(number, folder, covered loads) of the last generation."""
    lines = _json_or_none(spark, f"{newest_root(rates_table)}/_lines", _LINE)
    last = lines.orderBy(F.col("seq").desc(), F.col("path").desc()).first() if lines is not None else None
    if last is None:
        return 0, None, []
    covered = [r["load"] for r in spark.read.schema("load string").json(f"{last['path']}/loads").collect()]
    return last["seq"], last["path"], covered           # names, one per load


def _newest(spark: SparkSession, rates_table: str, kept: str | None, since: list[str]) -> DataFrame:
    # The loads since by name: only their files are opened.
    history = [f"{rates_table.rstrip('/')}/{n}" for n in since] if since or kept else [rates_table]
    parts = [spark.read.schema(RATES).parquet(*history).select("currency_code", "date", "rate")] if history else []
    if kept:
        parts.append(spark.read.schema("currency_code string, date date, rate double").parquet(f"{kept}/rates"))
    return latest_rate_per_currency(parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0])


def read_newest(spark: SparkSession, rates_table: str) -> DataFrame:
    """(currency_code, date, rate): the newest rate per currency of the whole
    table, from the aggregate and the loads since.  The rates of the newest
    date of the table are among them (``rates_on_latest_date`` of the result)."""
    _, kept, covered = _kept(spark, rates_table)
    known = set(covered)
    return _newest(spark, rates_table, kept, [n for n in load_names(spark, rates_table) if n not in known])


def fold_newest(spark: SparkSession, rates_table: str) -> None:
    """Cover all loads that the table has now."""
    seq, kept, covered = _kept(spark, rates_table)
    names = load_names(spark, rates_table)
    known = set(covered)
    since = [n for n in names if n not in known]
    if not since:
        return
    path = f"{newest_root(rates_table)}/gen={seq + 1}-{uuid.uuid4().hex[:8]}"
    _newest(spark, rates_table, kept, since).coalesce(1).write.parquet(f"{path}/rates")
    spark.createDataFrame([(n,) for n in sorted(known | set(since))], "load string").coalesce(1).write.json(f"{path}/loads")
    spark.createDataFrame([(seq + 1, path)], _LINE).coalesce(1).write.mode("append").json(f"{newest_root(rates_table)}/_lines")
