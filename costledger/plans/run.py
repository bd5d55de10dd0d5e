"""One ingest run as a set-based Spark job.

The reference walks the listing file by file and asks the warehouse per file.
Here a run is a handful of joins and aggregates over the whole listing and
registry, then one dedup shuffle over the rows of all new files and one
upsert.  ``apply_run`` is pure: it returns the new target, the new registry
and a report; ``publish`` (in ``sinks``) writes them."""
from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as ops
from ..functions import is_parquet, utc_instant, version_id
from ..operators.sequence import lag_in_order
from ..operators.skew import lookup_per_key
from ..schemas import AD_INPUT, KEYS, REGISTRY, STATUS_DELETED, STATUS_PROCESSED, TARGET, empty
from ..session import ensure_checkpoint_dir, materialize
from .feed import Feed, in_scope, left_open

# A loader gets the files to read (object_key, file_name, file_hash) and returns
# (rows with object_key + the ad columns, rejected files by object_key and,
# if it knows, the reason) and may add what it read of each file.
Loader = Callable[[DataFrame], tuple[DataFrame, ...]]


class RunResult:
    """What a run makes of the state.  The report and the registry need no ad
    row; the target is worked out when it is first asked for."""

    def __init__(self, registry: DataFrame, report: DataFrame, summary: DataFrame,
                 listing: DataFrame | None, merged: Callable[[], tuple[DataFrame, ...]],
                 registry_changes: tuple[DataFrame, Callable[[DataFrame], DataFrame]] | None = None,
                 carry: DataFrame | None = None):
        self.registry = registry
        self.report = report      # one row per listed object with what the run did
        self.summary = summary    # one row: counts and the late-file flag
        self.listing = listing    # the listing as read (hashes included), written once
        # The versions a run records or tombstones, and what it makes of old registry rows.
        self.registry_changes = registry_changes
        self.carry = carry        # what the next run must look at again
        self._merged = merged

    @cached_property
    def _parts(self):
        return self._merged()

    @property
    def touched_dates(self) -> DataFrame:
        """dt values whose rows may have changed."""
        return self._parts[0]

    @property
    def target_touched(self) -> DataFrame:
        """The new target rows of those dates only."""
        return self._parts[1]

    @property
    def target_untouched(self) -> DataFrame:
        return self._parts[2]

    @property
    def version_dates(self) -> DataFrame:
        """(file_version_id, dt) of the rows this run brought in."""
        return self._parts[3]

    @property
    def target(self) -> DataFrame:
        return self.target_touched.unionByName(self.target_untouched)


class EmptyListing(RuntimeError):
    pass


def run_clock(now: datetime | None = None) -> tuple[str, str, str]:
    """(run_id, run_ts, run_date) of a run started now, in UTC.
    One timestamp stamps every row and registry entry of the run; runs started
    in the same second still differ in their id."""
    now = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
    ts = now.strftime("%Y-%m-%d %H:%M:%S")
    return f"run-{now.strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:8]}", ts, now.strftime("%Y-%m-%d")


def classify(listing: DataFrame, registry: DataFrame) -> DataFrame:
    """Every listed Parquet object (a visit, in list order = key order) with
    whether the sequential job would ingest it.

    A visit is ingested when its (name, hash) is not live at that moment.
    With one name per content that is only the first visit, when the pair
    has no live version.  With copies (a content under several names) the
    holder changes at every visit whose name differs from the previous visit
    of the same content; those visits are found by ``lag_in_order`` over the
    copies only, which range-partitions them, so a content copied under
    millions of names is split over many tasks.  The last ingested visit of
    a content owns it (``final``); earlier ones are relayed: ingested, then
    removed in the same run.  An object without a content hash is never
    known to be live, so it is ingested by every run."""
    pq = listing.filter(is_parquet("file_name")).select("object_key", "folder", "file_name", "file_hash")
    hashed = pq.filter(F.col("file_hash").isNotNull())
    total = hashed.count()
    # One partial aggregate per hash: several names <=> min(name) < max(name);
    # with a single name the first visit of the pair is the first of the hash.
    per_hash = hashed.groupBy("file_hash").agg(
        (F.min("file_name") < F.max("file_name")).alias("_copied"),
        F.min("object_key").alias("_first_key"), F.count(F.lit(1)).alias("_n"))
    live = ops.live_versions(registry).select("file_name", "file_hash").distinct() \
        .withColumn("_live", F.lit(True))
    occ = (lookup_per_key(hashed, per_hash, "file_hash", "_n", total, "inner")
           .join(live, ["file_name", "file_hash"], "left")
           .withColumn("is_live", F.col("_live").isNotNull()))
    single = occ.filter(~F.col("_copied")).withColumn(
        "ingest", (F.col("object_key") == F.col("_first_key")) & ~F.col("is_live"))
    copies = lag_in_order(occ.filter(F.col("_copied")), "file_hash", "object_key",
                          "file_name", "_prev_name")
    prev = F.col("_prev_name")
    copies = copies.withColumn(
        "ingest", F.when(prev.isNull(), ~F.col("is_live")).otherwise(prev != F.col("file_name"))
    ).drop("_prev_name")
    visits = materialize(single.unionByName(copies))
    last_ingest = visits.groupBy("file_hash").agg(
        F.max(F.when(F.col("ingest"), F.col("object_key"))).alias("_final_key"), F.count(F.lit(1)).alias("_n"))
    known = (lookup_per_key(visits, last_ingest, "file_hash", "_n", total, "inner")
             .select("object_key", "folder", "file_name", "file_hash", "is_live", "ingest",
                     F.coalesce(F.col("object_key") == F.col("_final_key"), F.lit(False)).alias("final"),
                     F.col("_copied").alias("is_copy")))
    bare = pq.filter(F.col("file_hash").isNull()).select(
        "*", F.lit(False).alias("is_live"), F.lit(True).alias("ingest"), F.lit(True).alias("final"),
        F.lit(False).alias("is_copy"))
    return known.unionByName(bare)


def apply_run(listing: DataFrame, registry: DataFrame, target: DataFrame,
              rates: DataFrame | Callable[[], DataFrame],
              load: Loader, run_id: str, run_ts: str, run_date: str,
              rate_policy: str = "latest", policy: str = "drop", convention: str = "multiply",
              allow_empty: bool = False, reconcile: bool = True, redo: bool = False,
              version_dates: DataFrame | None = None, feed: Feed | None = None) -> RunResult:
    """One run of the ingest job.

    1. Versions of names that are no longer listed die (last version per
       name); not with ``reconcile=False``, for a listing of new files only.
    2. Listed Parquet objects are visited in key order (``classify``): a visit
       is ingested when its (name, hash) has no live version at that moment;
       with copies, every change of name between visits of one content
       re-ingests it, and the last ingested visit owns the content (earlier
       ones are recorded and tombstoned in the same run).
    3. Live versions carrying an ingested content die, so a renamed or copied
       file hands its rows over.
    4. Dead versions lose their target rows and are tombstoned; the rows of
       the accepted owners are deduped together (highest cost, ties in list
       order), converted, and upserted where the cost is strictly higher.
    Rejected files (damaged, missing columns) are not recorded and retried
    next run, but the versions they replace are still removed, as in the
    reference.  ``rates`` may be a function; it is called only if a file is
    new.  ``redo``: an earlier attempt died after it began to write, so target
    rows of versions the registry does not know are removed first.
    ``version_dates`` (file_version_id, dt) from earlier runs saves looking
    for the dates of dead versions in the target.  With ``feed`` (what changed
    since the last run, ``change_feed``) only what it names is looked at; if
    that is nothing, the registry is not read.
    """
    ensure_checkpoint_dir(listing.sparkSession)
    # The listing (content hashes included) is used four times: compute it once.
    listing = materialize(listing)
    if not allow_empty and listing.isEmpty():
        raise EmptyListing("the listing is empty; refusing to delete every processed file")

    spark = listing.sparkSession
    bare = listing.filter(F.col("file_hash").isNull() & is_parquet("file_name"))
    if feed is None:
        scope, known = listing, registry
    elif feed.quiet() and bare.isEmpty():
        scope, known = listing.limit(0), empty(spark, REGISTRY)
    else:
        scope, known = in_scope(listing, registry, feed)
        scope, known = materialize(scope), materialize(known)

    files = materialize(classify(scope, known))
    owners = files.filter(F.col("ingest") & F.col("final"))
    relay = files.filter(F.col("ingest") & ~F.col("final"))

    dead = (ops.live_versions(known)
            .join(owners.select("file_hash"), "file_hash", "left_semi")
            .select("file_version_id"))
    if reconcile:
        dead = dead.unionByName(ops.files_missing(known, scope).select("file_version_id"))
    if redo:
        live = ops.live_versions(registry).select("file_version_id")
        dead = dead.unionByName(target.select("file_version_id").distinct()
                                .join(live, "file_version_id", "left_anti"))
    dead = materialize(dead.distinct())

    nothing_new = owners.isEmpty()
    if nothing_new:           # nothing to read: no loader job, no rate lookup
        rows = spark.createDataFrame([], T.StructType(
            [T.StructField("object_key", T.StringType()), *AD_INPUT.fields]))
        rejected, read = spark.createDataFrame([], "object_key string"), []
    else:
        rows, rejected, *read = load(owners.select("object_key", "file_name", "file_hash"))
    rejected_keys = rejected.select("object_key").distinct()
    accepted = (owners.join(rejected_keys, "object_key", "left_anti")
                .withColumn("file_version_id", version_id(run_id, "object_key", "file_hash")))

    def source() -> DataFrame:
        if nothing_new:
            return empty(spark, TARGET)
        lookup = ops.rate_lookup(rates() if callable(rates) else rates, rate_policy)
        if rate_policy != "lookup":
            lookup = materialize(lookup)
        # Only a rate of 0 can make a file's top row vanish (infinite cost)
        # while another file still has a row for the key.
        zero = not lookup.filter(F.col("rate") == 0).isEmpty()
        best = ops.process_ad_rows(rows, lookup, policy, tie_breakers=("object_key",), convention=convention,
                                   materialize_rates=False, per_file="object_key" if zero else None)
        # The file's name and version join the surviving rows only, written once.
        best = materialize(best)
        # A key's best rows of one very large file don't meet in one task.
        per_file = materialize(best.groupBy("object_key").agg(F.count(F.lit(1)).alias("_n")))
        owned = accepted.select("object_key", "file_name", "file_version_id").join(per_file, "object_key")
        best = lookup_per_key(best, owned, "object_key", "_n", per_file.agg(F.sum("_n")).first()[0] or 0, "inner")
        return materialize(ops.stamp_lineage(best, F.col("file_version_id"), utc_instant(run_ts))
                           .select(*TARGET.fieldNames()))

    def merged():
        new = source()
        touched, hot, cold = merge_touched_dates(target.select(*TARGET.fieldNames()), new, dead, version_dates)
        return (touched, hot.select(*TARGET.fieldNames()), cold.select(*TARGET.fieldNames()),
                new.select("file_version_id", "dt").distinct())

    rejected_hashes = owners.join(rejected_keys, "object_key", "left_semi").select("file_hash")
    relay_ok = relay.join(rejected_hashes, "file_hash", "left_anti")
    records = accepted.select("file_name", "file_hash", "file_version_id",
                              F.lit(STATUS_PROCESSED).alias("status")).unionByName(
        relay_ok.select("file_name", F.lit(None).cast("string").alias("file_hash"),
                        version_id(run_id, "object_key", "file_hash").alias("file_version_id"),
                        F.lit(STATUS_DELETED).alias("status")))
    def renewed(old: DataFrame) -> DataFrame:
        old = ops.tombstone(old, dead, run_ts, materialize=False)
        return ops.upsert_registry(old, records, run_ts).select(*REGISTRY.fieldNames())

    touched_versions = dead.unionByName(records.select("file_version_id"))

    report = _report(listing, files, rejected, read[0] if read else None, feed is not None)
    summary = report.agg(
        F.bool_or((F.col("folder") == F.lit(run_date)) & is_parquet("file_name"))
         .alias("found_today_file"),
        *[F.count_if(F.col("action") == a).alias(f"n_{a}") for a in ACTIONS],
        dead.select(F.count("*")).scalar().alias("n_dead_versions"),
    )
    carry = left_open(scope, known, files, rejected_keys) if reconcile else None
    return RunResult(renewed(registry), report, summary, listing, merged, (touched_versions, renewed), carry)


def dates_of_versions(target: DataFrame, versions: DataFrame, known: DataFrame | None) -> DataFrame:
    """The dates that hold rows of ``versions``: from ``known``
    (file_version_id, dt; any superset of the rows) where it has the version,
    else from a scan of the target's version and date columns."""
    wanted = versions.select("file_version_id").distinct()
    if known is None:
        return target.join(wanted, "file_version_id", "left_semi").select("dt")
    dates = known.join(wanted, "file_version_id", "left_semi").select("dt")
    unknown = materialize(wanted.join(known.select("file_version_id"), "file_version_id", "left_anti"))
    if unknown.isEmpty():
        return dates
    return dates.unionByName(target.join(unknown, "file_version_id", "left_semi").select("dt"))


def merge_touched_dates(target: DataFrame, source: DataFrame, dead: DataFrame,
                        version_dates: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Delete the dead versions and upsert the source (a written table),
    shuffling only the target rows of the dates this run touches: dates of the
    source and of the rows of dead versions.  Returns (touched dates, new rows
    of those dates, untouched rows).

    The touched dates are one row per day, written, so their size is known:
    the semi join with a ``dt``-partitioned target broadcasts them and prunes
    its partitions while it runs (the comparison makes the date side a filter
    for Spark).  Rows without a date are always among the touched ones."""
    dead_dates = dates_of_versions(target, dead, version_dates)
    touched = materialize(source.select("dt").unionByName(dead_dates).distinct())
    null_dt = F.col("dt").isNull()
    dates = touched.filter(F.col("dt") >= F.lit("0001-01-01").cast("date"))
    hot = target.join(dates, "dt", "left_semi").select(*target.columns)
    cold = target.join(dates, "dt", "left_anti").select(*target.columns).filter(~null_dt)
    # Rows without a date match nothing; beside the merge they leave the dated side as its files lie.
    loose = ops.delete_versions(target.filter(null_dt), dead, materialize=False)
    merged = ops.merge_max_cost(ops.delete_versions(hot, dead, materialize=False), source, KEYS, "cost")
    return touched, merged.unionByName(loose), cold


ACTIONS = ("skipped", "unchanged", "ingested", "relayed", "rejected")


def _report(listing, files, rejected, read, fed: bool) -> DataFrame:
    """What happened to each listed object; why it was rejected and how many
    values did not fit their column, if the loader tells.  With a feed
    (``fed``) objects that the run did not look at are unchanged."""
    reason = F.col("reason") if "reason" in rejected.columns else F.lit(None).cast("string")
    rej = rejected.groupBy("object_key").agg(F.min(reason).alias("reason")).withColumn("_rej", F.lit(True))
    out = (listing.join(files.select("object_key", "ingest", "final"), "object_key", "left")
           .join(rej, "object_key", "left"))
    ingest = F.coalesce("ingest", F.lit(False)) if fed else F.col("ingest")
    action = (F.when(~is_parquet("file_name"), "skipped").when(~ingest, "unchanged")
              .when(F.col("_rej"), "rejected").when(F.col("final"), "ingested").when(F.col("ingest"), "relayed")
              .otherwise(F.raise_error(F.concat(F.lit("no verdict on "), F.col("object_key")))))
    if read is None:
        return out.select(*listing.columns, action.alias("action"))
    return out.join(read, "object_key", "left").select(
        *listing.columns, action.alias("action"), "reason", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("cast_failures", F.lit(0)).alias("cast_failures"))


def rebuild(listing: DataFrame, rates: DataFrame, load: Loader,
            rate_policy: str = "snapshot") -> DataFrame:
    """Consolidate every listed Parquet file from scratch (the local dry
    run): first file per content in list order, dedup per file, convert,
    fold to the highest cost per key."""
    pq = materialize(listing.filter(is_parquet("file_name")))
    files = ops.first_per_content(pq.filter(F.col("file_hash").isNotNull()), "file_hash", "object_key") \
        .unionByName(pq.filter(F.col("file_hash").isNull()))
    rows, rejected, *_ = load(files.select("object_key", "file_name", "file_hash"))
    rows = rows.join(rejected.select("object_key"), "object_key", "left_anti")
    lookup = ops.rate_lookup(rates, rate_policy)
    return ops.fold_files(ops.attach_rate(rows, lookup), "object_key", KEYS)


def frame_loader(rows: DataFrame, rejected: DataFrame | None = None) -> Loader:
    """A ``Loader`` over rows already in a DataFrame (``object_key`` + the ad
    columns), for data derived by Spark from other tables and for tests."""
    def load(files: DataFrame):
        keys = files.select("object_key")
        got = rows.join(keys, "object_key", "left_semi")
        rej = (rejected.join(keys, "object_key", "left_semi") if rejected is not None
               else keys.limit(0))
        return got.join(rej.select("object_key"), "object_key", "left_anti"), rej
    return load
