"""Table changes without a row-level table format: every operator returns the
new table as a DataFrame; writing it is the job of ``plans.run``."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nan_to_null, strictly_greater
from ..schemas import KEYS, STATUS_DELETED, STATUS_PROCESSED
from .sizing import known_size


def _all_keys_set(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def merge_max_cost(target: DataFrame, source: DataFrame, keys: Sequence[str] = KEYS,
                   cost: str = "cost", with_action: bool = False) -> DataFrame:
    """Upsert ``source`` into ``target`` by ``keys``.

    A missing key is inserted; a matched row takes the whole source row only
    when the source cost is strictly higher (NaN never wins, a NULL target
    cost is never replaced).  Keys compare with ``=``: a row with a NULL key
    part never matches, so NULL-key source rows are always inserted and
    NULL-key target rows always kept; they pass beside the join, without a
    shuffle.  ``source`` must hold one row per key (see ``keep_highest_cost``)."""
    cols = target.columns
    source = source.select(*cols)
    keyed = _all_keys_set(keys)
    t = target.filter(keyed).withColumn("_in_t", F.lit(True)).alias("t")
    s = source.filter(keyed).withColumn("_in_s", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.join(s, on, "full_outer")
    in_t, in_s = F.col("t._in_t").isNotNull(), F.col("s._in_s").isNotNull()
    update = in_t & in_s & F.coalesce(
        strictly_greater(F.col(f"s.{cost}"), F.col(f"t.{cost}")), F.lit(False))
    take_s = ~in_t | update
    out = [F.when(take_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in cols]
    loose_t, loose_s = target.filter(~keyed), source.filter(~keyed)
    if not with_action:
        return joined.select(*out).unionByName(loose_t).unionByName(loose_s)
    action = (F.when(~in_t, "insert").when(~in_s, "target_only")
               .when(update, "update").otherwise("keep"))
    return (joined.select(*out, action.alias("merge_action"))
            .unionByName(loose_t.withColumn("merge_action", F.lit("target_only")))
            .unionByName(loose_s.withColumn("merge_action", F.lit("insert"))))


def delete_versions(target: DataFrame, dead: DataFrame,
                    version_col: str = "file_version_id", materialize: bool = True) -> DataFrame:
    """Drop target rows of the given file versions (anti join)."""
    dead = known_size(dead.select(version_col).distinct(), materialize)
    return target.join(dead, version_col, "left_anti").select(*target.columns)


def tombstone(registry: DataFrame, dead: DataFrame, run_ts, materialize: bool = True) -> DataFrame:
    """D3: the given versions, if still processed, become ``deleted`` with a
    NULL hash and a new processed date."""
    marks = known_size(dead.select("file_version_id").distinct().withColumn("_dead", F.lit(True)), materialize)
    hit = F.col("_dead").isNotNull() & (F.col("status") == STATUS_PROCESSED)
    ts = F.lit(run_ts).cast("timestamp_ntz")
    return (registry.join(marks, "file_version_id", "left")
            .select(*[
                (F.when(hit, F.lit(None).cast("string")).otherwise(F.col(c)) if c == "file_hash"
                 else F.when(hit, F.lit(STATUS_DELETED)).otherwise(F.col(c)) if c == "status"
                 else F.when(hit, ts).otherwise(F.col(c)) if c == "processed_date"
                 else F.col(c)).alias(c)
                for c in registry.columns]))


def upsert_registry(registry: DataFrame, records: DataFrame, run_ts) -> DataFrame:
    """Records (file_name, file_hash, file_version_id, status) keyed by
    version id.  A match updates hash, status and processed date; a new id is
    inserted with upload and processed date set to the run time."""
    ts = F.lit(run_ts).cast("timestamp_ntz")
    r = registry.withColumn("_in_r", F.lit(True)).alias("r")
    n = (records.select("file_name", "file_hash", "file_version_id", "status")
         .withColumn("_in_n", F.lit(True)).alias("n"))
    j = r.join(n, F.col("r.file_version_id") == F.col("n.file_version_id"), "full_outer")
    in_r, in_n = F.col("r._in_r").isNotNull(), F.col("n._in_n").isNotNull()
    return j.select(
        F.when(in_r, F.col("r.file_name")).otherwise(F.col("n.file_name")).alias("file_name"),
        F.when(in_n, F.col("n.file_hash")).otherwise(F.col("r.file_hash")).alias("file_hash"),
        F.coalesce(F.col("r.file_version_id"), F.col("n.file_version_id")).alias("file_version_id"),
        F.when(in_r, F.col("r.upload_date")).otherwise(ts).alias("upload_date"),
        F.when(in_n, ts).otherwise(F.col("r.processed_date")).alias("processed_date"),
        F.when(in_n, F.col("n.status")).otherwise(F.col("r.status")).alias("status"),
    )


def consolidate_outer(old: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Fold a processed frame into a consolidated one by a full outer
    join on the keys with NULL-equal matching.  The new row wins when it has a
    ``cost_usd`` and the old one has none or a strictly lower cost.  Both
    sides hold one row per key, so no key can be hot."""
    e = old.select(*keys, "cost", "cost_usd", F.lit(True).alias("_in_e")).alias("e")
    n = new.select(*keys, "cost", "cost_usd").alias("n")
    j = e.join(n, [F.col(f"e.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys], "full_outer")
    n_has_usd = F.col("n.cost_usd").isNotNull() & ~F.isnan("n.cost_usd")
    e_no_usd = F.col("e.cost_usd").isNull() | F.isnan("e.cost_usd")
    take_n = n_has_usd & (e_no_usd | F.coalesce(
        strictly_greater(F.col("n.cost"), F.col("e.cost")), F.lit(False)))
    in_e = F.col("e._in_e").isNotNull()
    key_cols = [F.when(in_e, F.col(f"e.{k}")).otherwise(F.col(f"n.{k}")).alias(k) for k in keys]
    return j.select(*key_cols,
                    F.when(take_n, F.col("n.cost")).otherwise(F.col("e.cost")).alias("cost"),
                    F.when(take_n, F.col("n.cost_usd")).otherwise(F.col("e.cost_usd")).alias("cost_usd"))


def fold_max_cost(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """All files folded to one row per key with the highest cost and
    its ``cost_usd``.  A hash aggregate with a map-side partial step, so a hot
    key is pre-aggregated before the shuffle."""
    c = nan_to_null("cost")
    return (df.groupBy(*keys)
              .agg(F.max(c).alias("cost"), F.max_by("cost_usd", c).alias("cost_usd")))


def fold_files(rows_with_rate: DataFrame, file_col: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """A4 over raw rows of many files (the consolidation of the dry run):
    per (key, file) the highest cost and its ``cost_usd``; a file whose top
    row converts to NULL/NaN drops out for that key, as its per-file result
    would be dropped; then the highest cost per key across files.

    Two hash aggregates with map-side partial steps instead of a sort-based
    window, so a hot key or a hot file is pre-aggregated before each shuffle.
    ``rows_with_rate`` carries ``_fx_rate`` (``attach_rate``)."""
    c = nan_to_null("cost")
    per_file = (rows_with_rate
                .groupBy(*keys, file_col)
                .agg(F.max(c).alias("cost"),
                     F.max_by(F.col("cost").cast("double") * F.col("_fx_rate"), c).alias("cost_usd")))
    ok = per_file.filter(F.col("cost_usd").isNotNull() & ~F.isnan("cost_usd"))
    return fold_max_cost(ok, keys)
