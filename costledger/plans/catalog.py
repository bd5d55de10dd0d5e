"""The query catalog: one function per operator of the reference, each taking
(spark, sf_dir) and returning a lazy DataFrame over the whole test tables.
``oracle.py`` holds the equivalent SQL under the same names."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as ops
from ..functions import base_name, folder_name, is_parquet, md5_base64, utc_instant, version_id
from ..functions.columns import try_cast_columns
from ..schemas import KEYS
from ..session import materialize
from . import fixtures as fx

AD_COLS = [*KEYS, "cost", "file_name", "event_id"]
TIES = ("file_name", "event_id")


def _latest(spark, d):
    return ops.latest_rate_per_currency(fx.fx_rates(spark, d))


def _snapshot(spark, d):
    return ops.rates_on_latest_date(fx.fx_rates(spark, d))


def _dedup(ads: DataFrame) -> DataFrame:
    return ops.keep_highest_cost(ads.select(*AD_COLS), KEYS, "cost", TIES)


def flagship_ad_spend(spark: SparkSession, d: str) -> DataFrame:
    """I4: highest cost per key over all files, in USD at the newest rate."""
    return ops.process_ad_rows(fx.ad_rows(spark, d).select(*AD_COLS), _latest(spark, d),
                               tie_breakers=TIES) \
        .select(*KEYS, "cost", "cost_usd", "file_name", "event_id")


def ad_rows_scan(spark, d):
    return fx.ad_rows(spark, d)


def cast_ad_rows(spark, d):
    o = fx.table(spark, d, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).alias("priority_num"),
        F.col("o_orderstatus").alias("status_num"))
    return try_cast_columns(o, {"priority_num": "double", "status_num": "double"})


def dedup_max_cost(spark, d):
    return _dedup(fx.ad_rows(spark, d))


def sort_cost(spark, d):
    """L1: every row, in the cost order."""
    return fx.ad_rows(spark, d).select("event_id", "cost", "file_name") \
        .orderBy(*ops.cost_order("cost", ("event_id",)))


def sort_cost_rank(spark, d):
    """L1 over every row: the position of each ad row in the cost order."""
    return ops.rank_by_cost(fx.ad_rows(spark, d).select("event_id", "cost", "file_name"),
                            "cost_rank", "cost", ("event_id",))


def latest_rate(spark, d):
    return _latest(spark, d)


def rates_snapshot(spark, d):
    return _snapshot(spark, d)


def rates_explode(spark, d):
    ev = fx.table(spark, d, "events").select(
        F.col("event_id").alias("payload_id"), "ts",
        ops.parse_rates_payload("props", field=None).alias("rates"))
    return ops.explode_rates(ev, "rates", F.col("ts"), keep=("payload_id",))


def cost_usd(spark, d):
    ads = fx.ad_rows(spark, d).select("event_id", "currency", "cost")
    return ops.to_usd(ads, _latest(spark, d), "drop", keep_rate=True)


def cost_usd_legacy(spark, d):
    ads = fx.ad_rows(spark, d).select("event_id", "currency", "cost")
    return ops.to_usd(ads, _latest(spark, d), "legacy", keep_rate=True)


def distinct_currencies(spark, d):
    return fx.ad_rows(spark, d).select("currency") \
        .filter(F.col("currency").isNotNull()).distinct()


def stamp_lineage(spark, d):
    return ops.stamp_lineage(flagship_ad_spend(spark, d),
                             version_id(fx.RUN_ID, "file_name"),
                             utc_instant(fx.RUN_TS))


def _object_keys(spark, d):
    ads = fx.ad_rows(spark, d)
    return ads.select(F.concat(F.lit("in/"), F.col("dt").cast("string"), F.lit("/"),
                               F.col("file_name")).alias("object_key")).distinct()


def path_split(spark, d):
    return _object_keys(spark, d).select(
        "object_key", folder_name("object_key").alias("folder"),
        base_name("object_key").alias("file_name"),
        is_parquet(base_name("object_key")).alias("is_parquet"))


def late_file_check(spark, d):
    p = path_split(spark, d)
    today = F.col("folder") == F.lit(fx.RUN_DATE)
    return p.agg(F.bool_or(today & F.col("is_parquet")).alias("found_today_file"),
                 F.count("*").alias("n_objects"),
                 F.count_if(F.col("is_parquet")).alias("n_parquet"),
                 F.count_if(today).alias("n_today"))


def _docs_md5(spark, d):
    return fx.table(spark, d, "documents").select(
        "doc_id", "text", F.md5("text").alias("content_md5"))


def content_md5(spark, d):
    return _docs_md5(spark, d).select(
        "doc_id", "content_md5", md5_base64("content_md5").alias("content_md5_b64"),
        F.octet_length("text").cast("bigint").alias("n_bytes"))


def unique_content(spark, d):
    return ops.first_per_content(_docs_md5(spark, d).select("doc_id", "content_md5"),
                                 "content_md5", "doc_id")


def file_version_id(spark, d):
    docs = _docs_md5(spark, d).withColumn("doc_key", F.col("doc_id").cast("string"))
    return docs.select("doc_id", version_id(fx.RUN_ID, "doc_key", "content_md5")
                       .alias("file_version_id"))


def files_unchanged(spark, d):
    return ops.files_unchanged(fx.listing(spark, d), fx.registry(spark, d)) \
        .select("file_name", "file_hash")


def files_new(spark, d):
    return ops.files_new(fx.listing(spark, d), fx.registry(spark, d)) \
        .select("file_name", "file_hash")


def files_reuploaded(spark, d):
    return ops.files_reuploaded(fx.listing(spark, d), fx.registry(spark, d)) \
        .select("file_name", "file_hash")


def files_missing(spark, d):
    return ops.files_missing(fx.registry(spark, d), fx.listing(spark, d))


def listing_names(spark, d):
    return ops.listing_names(fx.listing(spark, d))


def names_except(spark, d):
    return ops.names_not_listed(fx.registry(spark, d), fx.listing(spark, d))


def files_renamed(spark, d):
    return ops.previous_version_other_name(
        fx.listing(spark, d).select("file_name", "file_hash"), fx.registry(spark, d))


def files_renamed_after_reconcile(spark, d):
    """The rename check on the registry after vanished files are tombstoned
    (the order of a run: reconcile first)."""
    return ops.previous_version_other_name(
        fx.listing(spark, d).select("file_name", "file_hash"), reconcile(spark, d))


def content_owner(spark, d):
    return ops.content_owner(fx.listing(spark, d))


def registry_last_version(spark, d):
    return ops.last_version_per_name(fx.registry(spark, d)) \
        .select("file_name", "file_version_id")


def _run_records(spark, d):
    listing, reg = fx.listing(spark, d), fx.registry(spark, d)
    new = ops.files_new(listing, reg).select(
        "file_name", "file_hash",
        version_id(fx.RUN_ID, "file_name", "file_hash").alias("file_version_id"))
    touched = ops.live_versions(reg).join(listing.select("file_name", "file_hash"),
                                          ["file_name", "file_hash"], "left_semi") \
        .select("file_name", "file_hash", "file_version_id")
    return new.unionByName(touched).withColumn("status", F.lit("processed"))


def registry_upsert(spark, d):
    return ops.upsert_registry(fx.registry(spark, d), _run_records(spark, d), fx.RUN_TS)


def registry_tombstone(spark, d):
    dead = files_renamed(spark, d).select(F.col("prev_version_id").alias("file_version_id"))
    return ops.tombstone(fx.registry(spark, d), dead, fx.RUN_TS)


def reconcile(spark, d):
    dead = files_missing(spark, d).select("file_version_id")
    return ops.tombstone(fx.registry(spark, d), dead, fx.RUN_TS)


def _merge_sides(spark, d):
    ads = fx.ad_rows(spark, d)
    target = _dedup(ads.filter(F.col("file_no") <= 3))
    source = _dedup(ads.filter(F.col("file_no") >= 3))
    return target, source


def merge_max_cost(spark, d):
    target, source = _merge_sides(spark, d)
    return ops.merge_max_cost(target, source, KEYS, "cost", with_action=True)


def delete_by_version(spark, d):
    target, source = _merge_sides(spark, d)
    merged = ops.merge_max_cost(target, source, KEYS, "cost")
    dead = fx.ad_rows(spark, d).filter(F.col("file_no") % 3 == 2).select("file_name")
    return ops.delete_versions(merged, dead, "file_name")


def outer_consolidate(spark, d):
    ads, snap = fx.ad_rows(spark, d), _snapshot(spark, d)
    old = ops.to_usd(_dedup(ads.filter(F.col("file_no") <= 3)), snap)
    new = ops.to_usd(_dedup(ads.filter(F.col("file_no") >= 3)), snap)
    return ops.consolidate_outer(old, new, KEYS)


def consolidate_max(spark, d):
    ads = fx.ad_rows(spark, d).select(*AD_COLS)
    return ops.fold_files(ops.attach_rate(ads, _snapshot(spark, d)), "file_name", KEYS)


def union_files(spark, d):
    ads = fx.ad_rows(spark, d)
    full = ads.filter(F.col("file_no") % 2 == 0).select(*AD_COLS)
    no_platform = ads.filter(F.col("file_no") % 2 == 1) \
        .select(*[c for c in AD_COLS if c != "platform"])
    return full.unionByName(no_platform, allowMissingColumns=True)


def ingest_run(spark, d):
    """One run of the ingest job over the ad files derived from ``events``,
    with the target and the registry before it."""
    from .run import apply_run, frame_loader
    ads = fx.ad_rows(spark, d)
    latest = materialize(_latest(spark, d))
    # The state before the run is a stored table in production: write it once.
    target0 = materialize(ops.stamp_lineage(
        ops.process_ad_rows(ads.filter(F.col("file_no") <= fx.COPIED_FILE).select(*AD_COLS),
                            latest, tie_breakers=TIES),
        F.concat(F.lit("v_"), F.col("file_name")), utc_instant(fx.REGISTRY_TS)))
    # The listing is metadata a run reads from the store: written once too.
    full_listing = materialize(fx.ingest_listing(spark, d))
    listing = full_listing.select("object_key", "folder", "file_name", "file_hash")
    registry0 = fx.ingest_registry0(spark, d)
    return apply_run(listing, registry0, target0, latest,
                     frame_loader(fx.ingest_rows(spark, d, full_listing)),
                     fx.RUN_ID, fx.RUN_TS, fx.RUN_DATE, rate_policy="lookup"), target0, registry0


def _ingest(spark, d):
    return ingest_run(spark, d)[0]


def ingest_end_state(spark, d):
    return _ingest(spark, d).target


def ingest_registry(spark, d):
    return _ingest(spark, d).registry


def ingest_report(spark, d):
    return _ingest(spark, d).report


def ingest_summary(spark, d):
    return _ingest(spark, d).summary


def file_ingest_end_state(spark, d):
    """The run over real files: written, listed, hashed, read and merged."""
    import uuid

    from ..schemas import REGISTRY, TARGET, empty
    from ..session import ensure_checkpoint_dir
    from ..sources import list_objects, parquet_loader
    from .run import apply_run
    root = f"{ensure_checkpoint_dir(spark)}/ad files {uuid.uuid4().hex}"
    n = fx.write_ad_files(spark, d, root)
    listing = list_objects(spark, root)
    res = apply_run(listing, empty(spark, REGISTRY), empty(spark, TARGET), _latest(spark, d), parquet_loader(spark),
                    fx.RUN_ID, fx.RUN_TS, fx.RUN_DATE)
    ingested = res.summary.first()["n_ingested"]
    if ingested != n:
        raise RuntimeError(f"{ingested} of {n} files ingested")
    return res.target.select(*KEYS, "cost", "cost_usd", "file_name")


def ingest_copies_report(spark, d):
    """What a run does with each object when a third are copies of one
    content and some have no hash."""
    from ..schemas import AD_INPUT, TARGET, empty
    from .run import apply_run, frame_loader
    rows = spark.createDataFrame([], "object_key string, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in AD_INPUT.fields))
    res = apply_run(materialize(fx.copied_listing(spark, d)), materialize(fx.copied_registry(spark, d)),
                    empty(spark, TARGET), _latest(spark, d), frame_loader(rows), fx.RUN_ID, fx.RUN_TS, fx.RUN_DATE)
    return res.report.select("object_key", "file_hash", "action")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flagship_ad_spend": flagship_ad_spend,
    "ad_rows_scan": ad_rows_scan,
    "cast_ad_rows": cast_ad_rows,
    "dedup_max_cost": dedup_max_cost,
    "sort_cost": sort_cost,
    "sort_cost_rank": sort_cost_rank,
    "latest_rate": latest_rate,
    "rates_snapshot": rates_snapshot,
    "rates_explode": rates_explode,
    "cost_usd": cost_usd,
    "cost_usd_legacy": cost_usd_legacy,
    "distinct_currencies": distinct_currencies,
    "stamp_lineage": stamp_lineage,
    "path_split": path_split,
    "late_file_check": late_file_check,
    "content_md5": content_md5,
    "unique_content": unique_content,
    "file_version_id": file_version_id,
    "files_unchanged": files_unchanged,
    "files_new": files_new,
    "files_reuploaded": files_reuploaded,
    "files_missing": files_missing,
    "listing_names": listing_names,
    "names_except": names_except,
    "files_renamed": files_renamed,
    "files_renamed_after_reconcile": files_renamed_after_reconcile,
    "content_owner": content_owner,
    "registry_last_version": registry_last_version,
    "registry_upsert": registry_upsert,
    "registry_tombstone": registry_tombstone,
    "reconcile": reconcile,
    "merge_max_cost": merge_max_cost,
    "delete_by_version": delete_by_version,
    "outer_consolidate": outer_consolidate,
    "consolidate_max": consolidate_max,
    "union_files": union_files,
    "ingest_end_state": ingest_end_state,
    "ingest_registry": ingest_registry,
    "ingest_report": ingest_report,
    "ingest_summary": ingest_summary,
    "file_ingest_end_state": file_ingest_end_state,
    "ingest_copies_report": ingest_copies_report,
}
