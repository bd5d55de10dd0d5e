"""File state: which listed files are unchanged, new, missing or copies.

Every check is a set operation over the whole listing and registry (semi /
anti joins, aggregates per hash); nothing is asked per file."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import STATUS_PROCESSED
from .skew import lookup_per_key


def live_versions(registry: DataFrame) -> DataFrame:
    """registry rows whose status is ``processed``."""
    return registry.filter(F.col("status") == STATUS_PROCESSED)


def last_version_per_name(registry: DataFrame) -> DataFrame:
    """One live version per name, the most recently processed one (then
    the highest version id)."""
    w = Window.partitionBy("file_name").orderBy(
        F.col("processed_date").desc_nulls_last(), F.col("file_version_id").desc_nulls_last())
    return (live_versions(registry)
            .withColumn("_rank", F.row_number().over(w))
            .filter(F.col("_rank") == 1).drop("_rank"))


def files_unchanged(listing: DataFrame, registry: DataFrame) -> DataFrame:
    """Listed files whose (name, hash) has a live version."""
    live = live_versions(registry).select("file_name", "file_hash")
    return listing.join(live, ["file_name", "file_hash"], "left_semi")


def files_new(listing: DataFrame, registry: DataFrame) -> DataFrame:
    """Listed files whose (name, hash) has no live version."""
    live = live_versions(registry).select("file_name", "file_hash")
    return listing.join(live, ["file_name", "file_hash"], "left_anti")


def files_reuploaded(listing: DataFrame, registry: DataFrame) -> DataFrame:
    """Listed files with new content under a name that has a live version
    (a re-upload: ingested, while the old version stays live)."""
    live = live_versions(registry)
    return (files_new(listing, registry)
            .join(live.select("file_name").distinct(), "file_name", "left_semi"))


def listing_names(listing: DataFrame) -> DataFrame:
    """Distinct base names in the listing."""
    return listing.select("file_name").distinct()


def names_not_listed(registry: DataFrame, listing: DataFrame) -> DataFrame:
    """Live names minus listed names."""
    return (live_versions(registry).select("file_name")
            .subtract(listing.select("file_name")))


def files_missing(registry: DataFrame, listing: DataFrame) -> DataFrame:
    """The last live version of every name that is no longer listed."""
    return (last_version_per_name(registry)
            .join(listing.select("file_name"), "file_name", "left_anti")
            .select("file_name", "file_version_id"))


def _first_two_names_per_hash(live: DataFrame) -> DataFrame:
    """Per hash, the smallest (name, version) and the smallest one with another
    name.  Two partial aggregations: a hash shared by millions of names still
    leaves every map task as one row, and no pair of names is ever formed; the
    first names reach the versions of a hot hash by broadcast."""
    first = (live.groupBy("file_hash")
             .agg(F.min(F.struct("file_name", "file_version_id")).alias("_first"), F.count(F.lit(1)).alias("_n")))
    second = (lookup_per_key(live.where(F.col("file_hash").isNotNull()), first, "file_hash", "_n", live.count(), "inner")
              .filter(F.col("file_name") != F.col("_first.file_name"))
              .groupBy("file_hash")
              .agg(F.min(F.struct("file_name", "file_version_id")).alias("_second")))
    return first.drop("_n").join(second, "file_hash", "left")


def previous_version_other_name(listing: DataFrame, registry: DataFrame) -> DataFrame:
    """For each listed file, the first live version (by name,
    then version id) that has the same hash under another name.  Files
    without one are left out.  A hash that many files share meets in no task:
    its candidates are broadcast (``lookup_per_key``)."""
    cands = _first_two_names_per_hash(
        live_versions(registry).select("file_name", "file_hash", "file_version_id"))
    pick = F.when(F.col("_first.file_name") != F.col("file_name"), F.col("_first")) \
            .otherwise(F.col("_second"))
    listed = listing.where(F.col("file_hash").isNotNull())
    counted = cands.join(listed.groupBy("file_hash").agg(F.count(F.lit(1)).alias("_n")), "file_hash")
    return (lookup_per_key(listed, counted, "file_hash", "_n", listing.count(), "inner")
            .withColumn("_prev", pick)
            .filter(F.col("_prev").isNotNull())
            .select(*listing.columns,
                    F.col("_prev.file_name").alias("prev_file_name"),
                    F.col("_prev.file_version_id").alias("prev_version_id")))


def content_owner(listing: DataFrame, order: str = "object_key") -> DataFrame:
    """Per hash, the file listed last (list order = ``order``) owns the
    content; also how many names carry it.  A partial aggregate per hash."""
    return (listing.groupBy("file_hash")
            .agg(F.max_by("file_name", order).alias("owner_file_name"),
                 F.max(order).alias("owner_key"),
                 F.countDistinct("file_name").alias("n_names")))


def first_per_content(df: DataFrame, hash_col: str, order: str) -> DataFrame:
    """keep the first row (by ``order``) of every content hash."""
    w = Window.partitionBy(hash_col).orderBy(F.col(order).asc_nulls_last())
    return (df.withColumn("_rank", F.row_number().over(w))
              .filter(F.col("_rank") == 1).drop("_rank"))
