"""J3 / J4 / I2 as a change feed: what a run has to look at.

A run leaves most files in a state that the next one would leave alone: listed
under one name, with a live version of that name and content.  Such files need
no look while they stay listed alike.  So the difference between the last
committed listing and the new one, with what the last run left open (copies,
rejected files, names that are gone but have older versions), names all
contents and names that a run can change.  Listing and registry are narrowed to
these, and every check of the run works on the narrowed frames.  Where nothing
changed the registry is not read."""
from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as ops
from ..functions import is_parquet
from ..session import materialize

CARRY = "file_name string, file_hash string"


class Feed(NamedTuple):
    """What may change: written tables of names and of contents."""

    names: DataFrame
    hashes: DataFrame

    def quiet(self) -> bool:
        return self.names.isEmpty() and self.hashes.isEmpty()


def listing_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """(object_key, file_name, file_hash, change): objects that were added or
    are gone, and both states of those whose content changed.  One full outer
    join on the object key, which is unique in a listing."""
    b = before.select("object_key", F.col("file_name").alias("_b_name"), F.col("file_hash").alias("_b_hash"),
                      F.lit(True).alias("_b"))
    n = now.select("object_key", "file_name", "file_hash", F.lit(True).alias("_n"))
    both = b.join(n, "object_key", "full_outer").where(
        F.col("_b").isNull() | F.col("_n").isNull() | ~F.col("file_hash").eqNullSafe(F.col("_b_hash")))
    old = F.struct(F.col("_b_name").alias("file_name"), F.col("_b_hash").alias("file_hash"),
                   F.when(F.col("_n").isNull(), "gone").otherwise("before").alias("change"))
    new = F.struct("file_name", "file_hash", F.when(F.col("_b").isNull(), "added").otherwise("after").alias("change"))
    states = F.filter(F.array(F.when(F.col("_b"), old), F.when(F.col("_n"), new)), lambda s: s.isNotNull())
    return both.select("object_key", F.inline(states))


def change_feed(before: DataFrame, now: DataFrame, carry: DataFrame) -> Feed:
    """The feed of a run over ``now`` after one that committed ``before`` and
    left ``carry`` open."""
    changes = materialize(listing_changes(before, now).select("file_name", "file_hash"))
    moved = changes.unionByName(carry.select("file_name", "file_hash"))
    return Feed(*(materialize(moved.select(c).where(F.col(c).isNotNull()).distinct()) for c in ("file_name", "file_hash")))


def in_scope(listing: DataFrame, registry: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    """(listing, registry) narrowed to what the feed can change: the contents
    and names in it, every name that has a live version of such a content, and
    objects without a content hash.  All rows of these names are in both, so a
    check by name or by content sees what it would see in the whole."""
    live = ops.live_versions(registry)
    names = feed.names.unionByName(live.join(feed.hashes, "file_hash", "left_semi").select("file_name"))
    names = materialize(names.distinct())
    by_name, by_hash = names.withColumn("_name", F.lit(True)), feed.hashes.withColumn("_hash", F.lit(True))
    scope = (listing.join(by_name, "file_name", "left").join(by_hash, "file_hash", "left")
             .where(F.col("_name") | F.col("_hash") | (F.col("file_hash").isNull() & is_parquet("file_name"))))
    return scope.select(*listing.columns), live.join(names, "file_name", "left_semi").select(*registry.columns)


def left_open(listing: DataFrame, registry: DataFrame, files: DataFrame, rejected: DataFrame) -> DataFrame:
    """What the next run must look at again though its listing may be the same
    (``CARRY``): contents with copies, contents of rejected files, and names
    that are not listed and have more than one live version, of which one
    dies each run."""
    copies = files.where("is_copy").select("file_hash")
    again = files.where("ingest AND final").join(rejected, "object_key", "left_semi").select("file_hash")
    gone = (ops.live_versions(registry).groupBy("file_name").count().where("count > 1")
            .join(listing.select("file_name"), "file_name", "left_anti").select("file_name"))
    nothing = F.lit(None).cast("string")
    return (copies.unionByName(again).where(F.col("file_hash").isNotNull()).distinct()
            .select(nothing.alias("file_name"), "file_hash")
            .unionByName(gone.select("file_name", nothing.alias("file_hash"))))
