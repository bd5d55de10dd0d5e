"""Column expressions shared by the operators.  All are built-in Spark
functions, so they stay inside whole-stage codegen."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import PARQUET_SUFFIX


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN becomes NULL.  Spark orders NaN above every number and ``max``
    returns it; the reference treats NaN like a missing cost."""
    c = col(c).cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


def is_missing_number(c) -> Column:
    """NULL or NaN (what pandas ``dropna`` drops)."""
    c = col(c)
    return c.isNull() | F.isnan(c)


def base_name(path) -> Column:
    """Last part of an object key (``a/b/c.parquet`` -> ``c.parquet``)."""
    return F.element_at(F.split(col(path), "/"), -1)


def folder_name(path) -> Column:
    """Second-last part of an object key: the date folder; NULL at top level."""
    parts = F.split(col(path), "/")
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2))


def is_parquet(name) -> Column:
    return col(name).endswith(PARQUET_SUFFIX)


def version_id(run_id, *parts) -> Column:
    """Deterministic version id of a file in a run.  Unlike a random UUID it is
    the same when a task is retried after an executor loss."""
    run = F.lit(run_id) if isinstance(run_id, str) else col(run_id)
    return F.sha2(F.concat_ws("~", run, *[col(p) for p in parts]), 256)


def md5_base64(hex_md5) -> Column:
    """Hex MD5 to the base64 form object stores report."""
    return F.base64(F.unhex(col(hex_md5)))


def strictly_greater(new, old) -> Column:
    """``old < new`` with SQL-warehouse NaN rules: NaN compares false.  In Spark
    NaN is the largest double, so ``1 < NaN`` would be true."""
    new, old = col(new), col(old)
    return (old < new) & ~F.isnan(new) & ~F.isnan(old)


def try_cast_columns(df, types: dict):
    """P10: cast columns to sink types; values that do not fit become NULL and
    are counted per row in ``cast_failures`` (Spark 4 is ANSI: a plain cast
    would fail the job)."""
    casts = {c: col(c).try_cast(t) for c, t in types.items()}
    failures = sum((F.when(col(c).isNotNull() & casts[c].isNull(), 1).otherwise(0)
                    for c in types), F.lit(0))
    return df.select(*[casts.get(c, col(c)).alias(c) for c in df.columns],
                     failures.cast("int").alias("cast_failures"))


def utc_instant(wall_clock: str):
    """A ``YYYY-MM-DD HH:MM:SS`` UTC wall-clock string as a timestamp, the
    same instant whatever the session time zone is."""
    return F.lit(f"{wall_clock}Z").cast("timestamp")
