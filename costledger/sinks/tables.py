"""K1-K5 and publishing a run.

There is no row-level table format in a plain Spark install, so the pipeline
state is a sequence of immutable snapshots.  A run writes its target and
registry into new folders, then appends one line to the run log; readers
only trust runs in the log.  A run that dies before the log line is
invisible and is redone under the same run id (its version ids are
deterministic, so the redo writes the same data)."""
from __future__ import annotations

import datetime as _dt
import json
import re
import time
import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import KEYS, REGISTRY, TARGET, empty
from ..session import _remove, materialize

LOG_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("target_path", T.StringType()),
    T.StructField("registry_path", T.StringType()),
    T.StructField("committed_at", T.StringType()),
    T.StructField("listing_path", T.StringType()),
    T.StructField("carry_path", T.StringType()),
])


def append_rates(rates: DataFrame, path: str) -> None:
    """K1: append rate rows: one file per load in one folder, so reading the
    history lists one folder however many days it holds."""
    rates.select("date", "currency_code", "rate").coalesce(1).write.mode("append").parquet(path)


def write_ndjson(df: DataFrame, path: str) -> None:
    """K3: rows as newline-delimited JSON."""
    df.write.mode("overwrite").json(path)


def truncate_table(spark: SparkSession, name: str) -> None:
    """Empty a catalog table (works for Parquet tables)."""
    spark.sql(f"TRUNCATE TABLE {name}")


def preview(df: DataFrame, n: int = 20) -> None:
    """K5: print the first rows."""
    df.show(n, truncate=False)


def _log_path(root: str) -> str:
    return f"{root}/_runs"


def _json_or_none(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """A JSON folder, None where it does not exist yet.  Any other failure to
    read the state stops the run: it must not look like a first one."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def run_log(spark: SparkSession, root: str) -> DataFrame:
    log = _json_or_none(spark, _log_path(root), LOG_SCHEMA)
    return empty(spark, LOG_SCHEMA) if log is None else log


INTENT_SCHEMA = "seq long, run_id string, run_ts string, run_date string"


def begin_run(spark: SparkSession, root: str, run_id: str, run_ts: str, run_date: str
              ) -> tuple[str, str, str, bool]:
    """Write down that a run is about to change tables.  If the last run that
    did so never reached the run log, this run goes on under its id and clock,
    so it makes the same version ids: (run_id, run_ts, run_date, whether it
    is such a redo)."""
    intents = _json_or_none(spark, f"{root}/_intents", INTENT_SCHEMA)
    last = intents.orderBy(F.col("seq").desc()).first() if intents is not None else None
    if last and run_log(spark, root).filter(F.col("run_id") == last["run_id"]).isEmpty():
        return last["run_id"], last["run_ts"], last["run_date"], True
    row = ((last["seq"] if last else 0) + 1, run_id, run_ts, run_date)
    spark.createDataFrame([row], INTENT_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/_intents")
    return run_id, run_ts, run_date, False


def latest_run(spark: SparkSession, root: str):
    rows = run_log(spark, root).orderBy(F.col("seq").desc()).limit(1).collect()
    return rows[0] if rows else None


def read_state(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(target, registry) of the last committed run, empty before the first."""
    last = latest_run(spark, root)
    if last is None:
        return empty(spark, TARGET), empty(spark, REGISTRY)
    return (spark.read.schema(TARGET).parquet(last["target_path"]),
            spark.read.schema(REGISTRY).parquet(last["registry_path"]))


def read_listing(spark: SparkSession, root: str) -> DataFrame | None:
    """The listing stored by the last committed run, if any (its hashes let
    the next listing skip unchanged objects)."""
    last = latest_run(spark, root)
    if last is None or not last["listing_path"]:
        return None
    return spark.read.parquet(last["listing_path"])


def read_carry(spark: SparkSession, root: str) -> DataFrame | None:
    """What the last committed run left open for the next one, if it says."""
    last = latest_run(spark, root)
    if last is None or not last["carry_path"]:
        return None
    return spark.read.schema("file_name string, file_hash string").parquet(last["carry_path"])


def write_version_dates(dates: DataFrame, root: str, run_id: str) -> None:
    """The dates of the rows of each version that a run brings in, so that a
    later run finds them without the target.  Written before the target: a
    date too many does no harm."""
    dates.select("file_version_id", "dt").write.mode("overwrite").parquet(f"{root}/version_dates/run={run_id}")


def read_version_dates(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema("file_version_id string, dt date").option("recursiveFileLookup", "true") \
            .parquet(f"{root}/version_dates")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def publish(spark: SparkSession, root: str, run_id: str, target: DataFrame | None,
            registry: DataFrame | None, listing: DataFrame | None = None,
            untouched: DataFrame | None = None, carry: DataFrame | None = None) -> dict:
    """Write both tables of a run, then commit it with one log line.  The
    target is partitioned by ``dt``; the rebalance hint lets AQE split a hot
    date over several writers instead of one.  With ``untouched``, ``target``
    holds only the rows of the dates that the run touched.  ``None`` for both
    tables keeps the previous run's (a run that changed nothing rewrites
    nothing).  ``listing`` and ``carry`` are what the next run's change feed
    needs."""
    done = run_log(spark, root).filter(F.col("run_id") == run_id).limit(1).collect()
    if done:
        return done[0].asDict()
    last = latest_run(spark, root)
    if target is None or registry is None:     # a run without changes: keep both tables
        if last is None:
            target = target if target is not None else empty(spark, TARGET)
            registry = registry if registry is not None else empty(spark, REGISTRY)
    t_path = last["target_path"] if target is None else f"{root}/target/run={run_id}"
    r_path = last["registry_path"] if registry is None else f"{root}/registry/run={run_id}"
    if target is not None:
        whole = target.select(*TARGET.fieldNames())
        if untouched is None:
            whole = whole.hint("rebalance", "dt")
        else:           # rows of other dates are copied without a shuffle
            whole = whole.hint("rebalance", "dt").unionByName(untouched.select(*TARGET.fieldNames()))
        # Static: the whole folder is replaced if a dead attempt left files.
        (whole.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("dt").parquet(t_path))
    if registry is not None:
        registry.select(*REGISTRY.fieldNames()).write.mode("overwrite").parquet(r_path)
    l_path = None
    if listing is not None:
        l_path = f"{root}/listing/run={run_id}"
        listing.write.mode("overwrite").parquet(l_path)
    c_path = None
    if carry is not None:
        c_path = f"{root}/carry/run={run_id}"
        carry.select("file_name", "file_hash").write.mode("overwrite").parquet(c_path)
    entry = {"seq": (last["seq"] + 1) if last else 1, "run_id": run_id,
             "target_path": t_path, "registry_path": r_path,
             "committed_at": _dt.datetime.now(_dt.timezone.utc).isoformat(),
             "listing_path": l_path, "carry_path": c_path}
    spark.createDataFrame([entry], LOG_SCHEMA).coalesce(1).write.mode("append").json(_log_path(root))
    return entry


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A session setting for what runs inside only."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _dynamic_overwrite(spark: SparkSession):
    return _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic")


# Buckets of a new target table inside each date, by the rest of the upsert key.
TARGET_BUCKETS = 16
BUCKET_COLUMNS = KEYS[1:]


def co_located(spark: SparkSession):
    """Inside, a join on the whole upsert key takes a side that is bucketed by
    a part of it as it lies, and deals only the other side to its buckets."""
    return _setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


def bucket_count(spark: SparkSession, table: str) -> int | None:
    """Buckets of a target table; None if it has another layout."""
    found = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    columns = "[" + ", ".join(f"`{c}`" for c in BUCKET_COLUMNS) + "]"
    return int(found["Num Buckets"]) if found.get("Bucket Columns") == columns else None


def _save_rows(rows: DataFrame, table: str, buckets: int | None) -> None:
    """Target rows as a table partitioned by ``dt``.  Bucketed, each task
    writes the buckets it has; otherwise AQE splits a hot date over several
    writers."""
    if buckets is None:
        writer = rows.hint("rebalance", "dt").write
    else:
        writer = rows.write.bucketBy(buckets, *BUCKET_COLUMNS).sortBy(*BUCKET_COLUMNS)
    writer.partitionBy("dt").format("parquet").saveAsTable(table)


def _replace_dates(spark: SparkSession, target_table: str, rows: DataFrame, dates: DataFrame) -> None:
    """Replace the partitions of ``dates`` (and of rows without a date) by
    ``rows``; one that is left without rows is dropped."""
    with _dynamic_overwrite(spark):
        rows.write.insertInto(target_table, overwrite=True)
    present = rows.select("dt").distinct()
    emptied = [r["dt"] for r in dates.select("dt").distinct().join(present, "dt", "left_anti")
               .filter(F.col("dt").isNotNull()).collect()]     # days: at most as many as a calendar has
    parts = [f"PARTITION (dt = DATE'{d.isoformat()}')" for d in emptied]
    if rows.filter(F.col("dt").isNull()).isEmpty():
        parts.append("PARTITION (dt = null)")
    if parts:
        spark.sql(f"ALTER TABLE {target_table} DROP IF EXISTS {', '.join(parts)}")


UNDO_SCHEMA = "seq long, run_id string, path string"


def _keep_undo(spark: SparkSession, target_table: str, dates: DataFrame, root: str, run_id: str) -> None:
    """K2: the old rows of the partitions that a run is about to replace, kept
    until the run is in the log.  One line says that they are complete."""
    path = f"{root}/undo/run={run_id}/{uuid.uuid4().hex}"
    dates.write.parquet(f"{path}/dates")
    dates = spark.read.schema("dt date").parquet(f"{path}/dates")
    old = spark.table(target_table)
    hot = old.join(dates.filter(F.col("dt") >= F.lit("0001-01-01").cast("date")), "dt", "left_semi")
    hot.select(*old.columns).unionByName(old.filter(F.col("dt").isNull())).write.parquet(f"{path}/rows")
    lines = _json_or_none(spark, f"{root}/_undo", UNDO_SCHEMA)
    seq = lines.agg(F.max("seq")).first()[0] if lines is not None else 0
    spark.createDataFrame([(seq + 1, run_id, path)], UNDO_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/_undo")


def restore_undo(spark: SparkSession, target_table: str, root: str, run_id: str) -> bool:
    """Put back what the last attempt of a run that died had replaced; False
    if it had not come to that.  Done twice it does no harm."""
    lines = _json_or_none(spark, f"{root}/_undo", UNDO_SCHEMA)
    last = lines.filter(F.col("run_id") == run_id).orderBy(F.col("seq").desc()).first() if lines is not None else None
    if last is None:
        return False
    rows = spark.read.schema(spark.table(target_table).schema).parquet(f"{last['path']}/rows")
    _replace_dates(spark, target_table, rows, spark.read.schema("dt date").parquet(f"{last['path']}/dates"))
    return True


def drop_undo(spark: SparkSession, root: str, run_id: str) -> None:
    """Remove the old rows that a run kept; it is in the log now."""
    _remove(spark, [f"{root}/undo/run={run_id}"])


def publish_tables(spark: SparkSession, target_table: str, registry_table: str,
                   touched_dates: DataFrame, target_touched: DataFrame,
                   registry: DataFrame, changes: tuple | None = None, undo_root: str | None = None,
                   run_id: str = "", buckets: int = TARGET_BUCKETS) -> None:
    """Publish a run into the catalog without rewriting untouched data.

    The target is a table partitioned by ``dt`` and, inside a date, bucketed
    and sorted by the rest of the upsert key: the merge reads the touched
    dates bucket by bucket and shuffles only the run's own rows, and its
    result is staged and inserted bucket by bucket.  Only the partitions of
    the touched dates are replaced; one left without rows is dropped.  A target
    table of another layout keeps it.

    The registry lies in hash buckets of the version id: with ``changes``
    (versions that change, a function from old registry rows to new ones) only
    the buckets that hold such versions are written (``swap_registry``).

    Both are staged before anything changes.  With ``undo_root`` the old rows
    of the touched dates are kept there first, so an attempt that dies in
    between is undone (``restore_undo``) and the run starts from the target it
    had found, whatever files have vanished since."""
    cols = [c for c in TARGET.fieldNames() if c != "dt"] + ["dt"]
    if not spark.catalog.tableExists(target_table):
        _save_rows(empty(spark, TARGET).select(*cols), target_table, buckets)
    staged = f"{target_table}_staged_{uuid.uuid4().hex[:8]}"
    try:
        with co_located(spark):
            _save_rows(target_touched.select(*cols), staged, bucket_count(spark, target_table))
        reg, touched = _changed_registry(spark, registry_table, registry, changes)
        dates = materialize(touched_dates.select("dt").distinct())
        if undo_root:
            _keep_undo(spark, target_table, dates, undo_root, run_id)
        _replace_dates(spark, target_table, spark.table(staged), dates)
        swap_registry(spark, registry_table, reg, touched, run_id)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")


# Buckets of a new registry, and the most tables its view is put together from.
REGISTRY_BUCKETS, REGISTRY_PARTS = 64, 16
_PROPERTY = "costledger.registry"


def version_bucket(version="file_version_id", n: int = REGISTRY_BUCKETS):
    """The registry bucket of a version id (a NULL id: 0)."""
    head = F.conv(F.substring(F.md5(version), 1, 8), 16, 10).cast("long")
    return F.coalesce(head % n, F.lit(0)).cast("int")


def registry_layout(spark: SparkSession, registry_table: str) -> dict | None:
    """{"buckets": how many, "parts": {table: its current buckets}, "run": who
    wrote last}; None where there is no bucketed registry."""
    if not spark.catalog.tableExists(registry_table) or spark.catalog.getTable(registry_table).tableType != "VIEW":
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {registry_table}").collect()}
    return json.loads(found[_PROPERTY]) if _PROPERTY in found else None


def _changed_registry(spark: SparkSession, registry_table: str, registry: DataFrame, changes: tuple | None
                      ) -> tuple[DataFrame, list[int] | None]:
    """(rows, buckets) to write: the buckets that hold changed versions, or
    the whole registry and None."""
    layout = registry_layout(spark, registry_table)
    if changes is None or layout is None:
        return materialize(registry.select(*REGISTRY.fieldNames())), None
    versions, renewed = changes
    bucket = version_bucket(n=layout["buckets"])
    touched = sorted(r[0] for r in versions.select(bucket).distinct().collect())     # at most the buckets
    old = spark.table(registry_table).filter(F.col("version_bucket").isin(touched)) if touched \
        else empty(spark, REGISTRY)
    return materialize(renewed(old.select(*REGISTRY.fieldNames())).select(*REGISTRY.fieldNames())), touched


def swap_registry(spark: SparkSession, registry_table: str, registry: DataFrame, touched: list[int] | None = None,
                  run_id: str = "", buckets: int = REGISTRY_BUCKETS) -> None:
    """Write registry rows as a new table and point the view at it, so readers
    see the old or the new registry, never none.  With ``touched`` the rows are
    those buckets, whole; the view takes the other buckets from the tables
    that had them.  When it has come to be put together from more than
    ``REGISTRY_PARTS`` tables, all buckets are written.  Of the superseded
    tables the newest stays, for readers that have it open."""
    db, _, name = registry_table.rpartition(".")
    layout = registry_layout(spark, registry_table)
    n = layout["buckets"] if layout else buckets
    parts = {}
    if touched is not None and layout:
        parts = {t: sorted(set(b) - set(touched)) for t, b in layout["parts"].items()}
        parts = {t: b for t, b in parts.items() if b}
        if len(parts) >= REGISTRY_PARTS:
            rest = spark.table(registry_table).filter(~F.col("version_bucket").isin(touched))
            registry, touched, parts = registry.unionByName(rest.select(*registry.columns)), None, {}
    stamp = f"v{time.time_ns() // 1_000_000:013d}_{uuid.uuid4().hex[:8]}"     # names sort by age
    new = f"{registry_table}_{stamp}"
    if touched != []:
        (registry.withColumn("version_bucket", version_bucket(n=n)).hint("rebalance", "version_bucket")
         .write.partitionBy("version_bucket").format("parquet").saveAsTable(new))
        parts[new] = list(range(n)) if touched is None else touched
    if spark.catalog.tableExists(registry_table) and spark.catalog.getTable(registry_table).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {registry_table} RENAME TO {registry_table}_v{0:013d}_{uuid.uuid4().hex[:8]}")
    text = json.dumps({"buckets": n, "parts": parts, "run": run_id})
    columns = ", ".join(REGISTRY.fieldNames())
    branches = [f"SELECT {columns}, version_bucket FROM {t}"
                + ("" if len(b) == n else f" WHERE version_bucket IN ({', '.join(map(str, b))})") for t, b in parts.items()]
    spark.sql(f"CREATE OR REPLACE VIEW {registry_table} TBLPROPERTIES ('{_PROPERTY}' = '{text}') AS "
              + " UNION ALL ".join(branches))
    current = {t.rpartition(".")[2].lower() for t in parts}
    found = spark.catalog.listTables(db or None, f"{name.lower()}_v*")
    old = sorted(t.name for t in found if t.tableType != "VIEW" and re.fullmatch(r".*_v\d{13}_\w{8}", t.name)
                 and t.name.lower() not in current)
    for table in old[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {db + '.' if db else ''}{table}")


def read_tables(spark: SparkSession, target_table: str, registry_table: str
                ) -> tuple[DataFrame, DataFrame]:
    """(target, registry) from the catalog, empty before the first run."""
    t = (spark.table(target_table).select(*TARGET.fieldNames())
         if spark.catalog.tableExists(target_table) else empty(spark, TARGET))
    r = (spark.table(registry_table).select(*REGISTRY.fieldNames())
         if spark.catalog.tableExists(registry_table) else empty(spark, REGISTRY))
    return t, r
