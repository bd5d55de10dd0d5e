"""Queries over real files and tables: each writes what Spark derives from the
test tables, runs sources, jobs or the stream over it, and returns what is
read back.  Their SQL is in ``file_oracle.py``."""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import KEYS
from ..session import ensure_checkpoint_dir, materialize, settled
from ..sinks.rates import fold_newest, read_newest
from ..sinks.tables import append_rates, publish_tables, read_state, read_tables, write_ndjson
from ..sources import list_objects, read_ad_files, read_rates_ndjson, read_rates_table
from . import catalog, feed
from . import fixtures as fx
from .jobs import reset_state
from .rates_job import NoRates, load_rates


def _root(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name} {uuid.uuid4().hex}"


def stream_end_state(spark, d):
    """The stream over files that land in two rounds, with a restart
    between them and several micro-batches in each; the second round also
    holds a copy of every earlier file in another folder.  ``n_versions``
    counts the registry: copies make none."""
    from ..streaming import start_ingest_stream
    root = _root(spark, "stream")
    landing = f"{root}/landing"
    latest = materialize(fx.fx_rates(spark, d).groupBy("currency_code", "date").agg(F.max("rate").alias("rate")))

    def stream(day):
        q = start_ingest_stream(spark, landing, f"{root}/state", latest, f"{day} 00:00:00",
                                max_files=fx.n_ad_files(spark, d) // 2)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()

    fx.write_ad_files(spark, d, landing, fx.plain_name, "2024-01-29", lambda no: no % 2 == 0)
    stream("2024-01-29")
    fx.copy_files(list_objects(spark, landing, with_hash=False), "2024-01-30")
    fx.write_ad_files(spark, d, landing, fx.plain_name, "2024-01-30", lambda no: no % 2 == 1)
    stream("2024-01-30")
    target, registry = read_state(spark, f"{root}/state")
    return target.select(*KEYS, "cost", "cost_usd", registry.select(F.count("*")).scalar().alias("n_versions"))


def odd_files_report(spark, d):
    """What the reader makes of files that lack columns, are
    damaged or hold other types, with the current and the legacy rule."""
    root = _root(spark, "odd files")
    fx.write_odd_ad_files(spark, d, root)
    files = materialize(list_objects(spark, root, with_hash=False).select("object_key", "file_name"))
    out = []
    for pad in (False, True):
        rows, rejected, read = read_ad_files(spark, files, pad_missing=pad)
        per = rows.groupBy("object_key").agg(F.max("cost").alias("max_cost"), F.count("platform").alias("n_platforms"))
        bad = rejected.select("object_key", "missing", F.lit(True).alias("rejected"))
        out.append(files.join(read, "object_key", "left").join(per, "object_key", "left")
                   .join(bad, "object_key", "left")
                   .select(F.lit(pad).alias("pad"), "file_name", F.coalesce("rejected", F.lit(False)).alias("rejected"),
                           F.coalesce("missing", F.lit("")).alias("missing"),
                           F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                           F.coalesce("cast_failures", F.lit(0)).alias("cast_failures"), "max_cost",
                           F.coalesce("n_platforms", F.lit(0)).alias("n_platforms")))
    return out[0].unionByName(out[1])


def rates_load(spark, d):
    """Payloads landed as JSON, one a year, loaded one by
    one; a payload without rates stops its load and appends nothing.  The
    table, and which rows the kept aggregate holds."""
    root = _root(spark, "rates")
    year = F.year("date").alias("year")
    best = fx.fx_rates(spark, d).groupBy(year, "currency_code").agg(F.max("rate").alias("rate"))
    payload = F.to_json(F.struct(F.lit(True).alias("success"), F.map_from_entries(
        F.collect_list(F.struct("currency_code", "rate"))).alias("rates")))     # a row per currency
    best.groupBy("year").agg(payload.alias("value")).write.partitionBy("year").text(f"{root}/landing")
    years = sorted(r["year"] for r in best.select("year").distinct().collect())     # calendar years
    for y in years:
        load_rates(spark, f"{root}/landing/year={y}", f"{root}/table", f"{y}-12-31")
    spark.createDataFrame([('{"success": true, "rates": {}}',)], "value string").write.text(f"{root}/none")
    try:
        load_rates(spark, f"{root}/none", f"{root}/table", "2030-01-01")
        raise RuntimeError("a payload without rates was loaded")
    except NoRates:
        pass
    newest = read_newest(spark, f"{root}/table").withColumn("_newest", F.lit(True))
    return (read_rates_table(spark, f"{root}/table").join(newest, ["date", "currency_code", "rate"], "left")
            .select("date", "currency_code", "rate", F.col("_newest").isNotNull().alias("is_newest")))


def latest_rate_kept(spark, d):
    """The newest rates from the kept aggregate and the load since:
    three loads, of which two are folded in."""
    path = _root(spark, "kept rates")
    daily = fx.fx_rates(spark, d).groupBy("date", "currency_code").agg(F.max("rate").alias("rate"))
    for load in range(3):
        append_rates(daily.where(F.year("date") % 3 == load), path)
        if load < 2:
            fold_newest(spark, path)
    return read_newest(spark, path)


def rates_ndjson(spark, d):
    """The rate history as newline-delimited JSON and back."""
    path = _root(spark, "ndjson")
    write_ndjson(fx.fx_rates(spark, d), path)
    return read_rates_ndjson(spark, path)


def listing_changes(spark, d):
    """The difference between two listings, here what was registered
    and what is listed."""
    before = fx.registry(spark, d).where("status = 'processed'").select(
        F.col("file_name").alias("object_key"), "file_name", "file_hash")
    return feed.listing_changes(before, fx.listing(spark, d)).select("file_name", "file_hash", "change")


def _in_tables(spark, make) -> DataFrame:
    """What ``make`` reads from the two tables of the names it gets, written;
    the tables are dropped."""
    names = tuple(f"{n}_{uuid.uuid4().hex[:10]}" for n in ("target", "registry"))
    try:
        return settled(spark, lambda: make(names))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {names[0]}")
        spark.sql(f"DROP VIEW IF EXISTS {names[1]}")
        for t in spark.catalog.listTables(None, f"{names[1]}_v*"):
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def _publish_ingest(spark, d, names):
    """The ingest run of ``ingest_end_state`` published into tables that hold
    the state before it."""
    res, target0, registry0 = catalog.ingest_run(spark, d)
    days = target0.select("dt").distinct()
    publish_tables(spark, *names, days, target0, registry0, buckets=4)
    before = materialize(_counts(spark, names, "before"))
    publish_tables(spark, *names, res.touched_dates, res.target_touched, res.registry, res.registry_changes,
                   _root(spark, "undo"), fx.RUN_ID)
    return before


def _counts(spark, names, step) -> DataFrame:
    target, registry = read_tables(spark, *names)
    return target.agg(F.count("*").alias("n_rows")).select(
        F.lit(step).alias("step"), "n_rows",
        registry.select(F.count_if(F.col("status") == "processed")).scalar().alias("n_processed"),
        registry.select(F.count_if(F.col("status") == "deleted")).scalar().alias("n_deleted"))


def table_ingest_end_state(spark, d):
    """The ingest run published into a bucketed target table and
    a registry in hash buckets; the target read back."""
    def make(names):
        _publish_ingest(spark, d, names)
        return read_tables(spark, *names)[0]
    return _in_tables(spark, make)


def table_ingest_registry(spark, d):
    """The registry of that run; only touched buckets were written."""
    def make(names):
        _publish_ingest(spark, d, names)
        return read_tables(spark, *names)[1]
    return _in_tables(spark, make)


def table_states(spark, d):
    """What the tables hold before the run, after it and after a
    reset."""
    def make(names):
        before = _publish_ingest(spark, d, names)
        after = materialize(_counts(spark, names, "after"))
        reset_state(spark, _root(spark, "reset"), tables=names)
        return before.unionByName(after).unionByName(_counts(spark, names, "reset"))
    return _in_tables(spark, make)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_end_state": stream_end_state,
    "odd_files_report": odd_files_report,
    "rates_load": rates_load,
    "latest_rate_kept": latest_rate_kept,
    "rates_ndjson": rates_ndjson,
    "listing_changes": listing_changes,
    "table_ingest_end_state": table_ingest_end_state,
    "table_ingest_registry": table_ingest_registry,
    "table_states": table_states,
}
