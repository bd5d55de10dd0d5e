"""The scheduled jobs: daily ingest, rate load, full rebuild and reset.
Each reads and writes only through Spark sources and sinks."""
from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..schemas import REGISTRY, TARGET, empty
from ..session import materialize, own_copies
from ..sinks.rates import read_newest
from ..sinks.tables import (begin_run, drop_undo, publish, publish_tables, read_carry, read_listing, read_state, read_tables,
                            read_version_dates, registry_layout, restore_undo, swap_registry, truncate_table,
                            write_version_dates)
from ..sources.adfiles import parquet_loader
from ..sources.listing import list_objects
from ..sources.rates import read_rates_table
from .feed import change_feed
from .rates_job import load_rates  # noqa: F401  (the rate job, I5)
from .run import RunResult, apply_run, rebuild, run_clock


def run_ingest(spark: SparkSession, source_root: str, state_root: str, rates_table: str,
               now: datetime | None = None, rate_policy: str = "latest", policy: str = "drop",
               convention: str = "multiply", allow_empty: bool = False, pad_missing: bool = False,
               tables: tuple[str, str] | None = None) -> RunResult:
    """List the source, reconcile against the last committed state,
    ingest what is new and commit the new target, registry and listing.

    By default the state is a snapshot per run under ``state_root`` (atomic;
    untouched dates are copied, not shuffled).  With ``tables=(target,
    registry)`` the state lives in the catalog and only the touched ``dt``
    partitions are rewritten (the mode for a large target); ``state_root``
    then keeps the listing with its hashes, the report, which run is under way
    and, until it is committed, the old rows of the partitions it replaces: a
    run that died is undone and done again under its own id.

    The frames of the result are those committed; the copies a run makes on
    its way are removed at its end."""
    run_id, run_ts, run_date = run_clock(now)
    if tables:
        begun, dead_ts, dead_date, redo = begin_run(spark, state_root, run_id, run_ts, run_date)
        if redo and (registry_layout(spark, tables[1]) or {}).get("run") == begun:
            # The registry is the last of the tables: that run only missed its log line.
            publish(spark, state_root, begun, None, None)
            drop_undo(spark, state_root, begun)
            begin_run(spark, state_root, run_id, run_ts, run_date)
        elif redo:
            run_id, run_ts, run_date = begun, dead_ts, dead_date
            restore_undo(spark, tables[0], state_root, run_id)
        target, registry = read_tables(spark, *tables)
    else:
        target, registry = read_state(spark, state_root)
    with own_copies(spark):
        before, carry = read_listing(spark, state_root), read_carry(spark, state_root)
        listing = materialize(list_objects(spark, source_root, known=before))
        feed = change_feed(before, listing, carry) if before is not None and carry is not None else None
        # Both rate policies hold on the newest rate per currency as on the whole history.
        res = apply_run(listing, registry, target, lambda: read_newest(spark, rates_table),
                        parquet_loader(spark, pad_missing), run_id, run_ts, run_date,
                        rate_policy=rate_policy, policy=policy, convention=convention,
                        allow_empty=allow_empty, feed=feed, version_dates=read_version_dates(spark, state_root))
        report_path = f"{state_root}/report/run={run_id}"
        res.report.write.mode("overwrite").parquet(report_path)
        summary = spark.createDataFrame(res.summary.collect(), res.summary.schema)      # one row
        s = summary.first()
        changed = (s["n_ingested"] + s["n_relayed"] + s["n_dead_versions"]) > 0
        if changed:
            write_version_dates(res.version_dates, state_root, run_id)
        if tables:
            if changed:
                publish_tables(spark, *tables, res.touched_dates, res.target_touched, res.registry,
                               res.registry_changes, state_root, run_id)
            entry = publish(spark, state_root, run_id, None, None, res.listing, carry=res.carry)
            drop_undo(spark, state_root, run_id)
        elif changed:
            entry = publish(spark, state_root, run_id, res.target_touched, res.registry, res.listing,
                            untouched=res.target_untouched, carry=res.carry)
        else:                 # nothing changed: log the run and its listing only
            entry = publish(spark, state_root, run_id, None, None, res.listing, carry=res.carry)
    target, registry = read_tables(spark, *tables) if tables else read_state(spark, state_root)
    return RunResult(registry, spark.read.parquet(report_path), summary,
                     spark.read.parquet(entry["listing_path"]),
                     lambda: (target.select("dt").distinct(), target, target.limit(0),
                             target.select("file_version_id", "dt").distinct()))


def run_rebuild(spark: SparkSession, source_root: str, rates_table: str,
                rate_policy: str = "snapshot") -> DataFrame:
    """Consolidate everything under ``source_root`` from scratch."""
    return rebuild(list_objects(spark, source_root), read_rates_table(spark, rates_table),
                   parquet_loader(spark), rate_policy)


def reset_state(spark: SparkSession, state_root: str, now: datetime | None = None,
                tables: tuple[str, str] | None = None) -> dict:
    """An empty target and registry, in the catalog too with
    ``tables`` (the next run starts over)."""
    run_id, _, _ = run_clock(now)
    if tables:
        swap_registry(spark, tables[1], empty(spark, REGISTRY))
        if spark.catalog.tableExists(tables[0]):
            truncate_table(spark, tables[0])
    return publish(spark, state_root, f"reset-{run_id}", empty(spark, TARGET), empty(spark, REGISTRY))
