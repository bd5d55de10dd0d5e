"""Catalog tables: bucketed target, registry buckets, undo of dead attempts."""
import datetime as dt
import os

from pyspark.sql import functions as F

from costledger.plans import jobs
from costledger.plans.run import merge_touched_dates
from costledger.schemas import REGISTRY, TARGET
from costledger.session import materialize
from costledger.sinks import append_rates, read_tables
from costledger.sinks import tables as sink

from .test_io import D1, D2, ad, put, rates_df

D0 = dt.date(2024, 1, 28)


def _target(spark, n, day=None):
    d = "date_add(DATE'2024-01-01', CAST(id % 6 AS INT))" if day is None else f"DATE'{day}'"
    return spark.range(n).selectExpr(f"{d} AS dt", "concat('n', id % 7) AS network", "concat('c', id % 11) AS currency",
                                     "concat('p', id) AS platform", "CAST(id AS DOUBLE) AS cost", "1D AS cost_usd",
                                     "'f' AS file_name", "concat('v', id % 3) AS file_version_id",
                                     "TIMESTAMP'2024-01-01 00:00:00' AS last_processed_timestamp")


def test_touched_dates_merge_without_shuffling_the_target(spark):
    name = "t_colocated"
    sink._save_rows(_target(spark, 3000), name, 8)
    assert sink.bucket_count(spark, name) == 8
    target = spark.table(name).select(*TARGET.fieldNames())
    source = materialize(_target(spark, 40, "2024-01-02").withColumn("cost", F.lit(1e6)))
    dead = materialize(spark.createDataFrame([("v2",)], "file_version_id string"))
    dates = materialize(spark.createDataFrame([("v2", dt.date(2024, 1, 3))], "file_version_id string, dt date"))
    touched, hot, cold = merge_touched_dates(target, source, dead, dates)
    with sink.co_located(spark):
        plan = hot._jdf.queryExecution().executedPlan().toString()
        got = hot.collect()
    to_scan = plan[plan.index("SortMergeJoin"):plan.index("FileScan parquet spark_catalog")]
    assert "Exchange" not in to_scan                            # from the join down to the target's files
    assert plan.count("Exchange hashpartitioning(network") == 1     # the run's own rows, into the target's buckets
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 8 out of 8" in plan
    plain = merge_touched_dates(_target(spark, 3000), source, dead, dates)[1]
    assert sorted(map(str, got)) == sorted(map(str, plain.select(*hot.columns).where("dt in ('2024-01-02', '2024-01-03')").collect()))


def test_one_new_file_rewrites_one_registry_bucket(spark, scratch):
    src, state, rt = f"{scratch}/src", f"{scratch}/state", f"{scratch}/rates"
    names = ("t_partial", "r_partial")
    append_rates(rates_df(spark, [(D1, "EUR", 2.0)]), rt)
    for k in range(3):
        put(src, "2024-01-29", f"a{k}.parquet", ad([(D1, f"n{k}", "EUR", "ios", 3.0)]))
    go = lambda day: jobs.run_ingest(spark, src, state, rt, tables=names,
                                     now=dt.datetime(2024, 2, day, 6, tzinfo=dt.timezone.utc))
    go(1)
    first = sink.registry_layout(spark, names[1])
    put(src, "2024-01-30", "b.parquet", ad([(D2, "k", "EUR", "ios", 2.0)]))
    go(2)
    layout = sink.registry_layout(spark, names[1])
    old, = first["parts"]
    new, = set(layout["parts"]) - {old}
    assert len(layout["parts"][new]) == 1 and len(layout["parts"][old]) == 63
    assert sorted(layout["parts"][new] + layout["parts"][old]) == list(range(64))
    written = {r[0] for r in spark.table(new).select("version_bucket").collect()}
    assert written == set(layout["parts"][new])
    live = [r.file_name for r in read_tables(spark, *names)[1].where("status = 'processed'").collect()]
    assert sorted(live) == ["a0.parquet", "a1.parquet", "a2.parquet", "b.parquet"]
    go(3)                                               # nothing new: the layout stays
    assert sink.registry_layout(spark, names[1]) == layout


def test_registry_parts_are_folded_and_superseded_tables_dropped(spark, monkeypatch):
    name = "r_folded"
    monkeypatch.setattr(sink, "REGISTRY_PARTS", 3)
    rows = spark.range(200).selectExpr("concat('f', id) AS file_name", "'h' AS file_hash", "concat('v', id) AS file_version_id",
                                       "CAST(NULL AS TIMESTAMP_NTZ) AS upload_date", "CAST(NULL AS TIMESTAMP_NTZ) AS processed_date",
                                       "'processed' AS status")
    sink.swap_registry(spark, name, rows)
    bucket = sink.version_bucket()
    for k in range(6):
        part = rows.where(bucket == k).withColumn("status", F.lit(f"round {k}"))
        sink.swap_registry(spark, name, part, [k], f"run{k}")
        got = {r.file_version_id: r.status for r in spark.table(name).collect()}
        want = {r.file_version_id: f"round {r.b}" if r.b <= k else "processed" for r in rows.select("*", bucket.alias("b")).collect()}
        assert got == want
        layout = sink.registry_layout(spark, name)
        assert len(layout["parts"]) <= 4 and layout["run"] == f"run{k}"
    tables = [t.name for t in spark.catalog.listTables(None, f"{name}_v*")]
    assert len(tables) <= len(layout["parts"]) + 1
    sink.swap_registry(spark, name, spark.createDataFrame([], REGISTRY))
    assert spark.table(name).count() == 0


def test_dead_attempt_is_undone_though_its_file_vanished(spark, scratch, monkeypatch):
    """A run dies after it replaced the target's partitions, and its file is
    gone before the next one: the overwritten rows are there again."""
    src, state, rt = f"{scratch}/src", f"{scratch}/state", f"{scratch}/rates"
    names = ("t_undo", "r_undo")
    append_rates(rates_df(spark, [(D1, "EUR", 2.0)]), rt)
    put(src, "2024-01-29", "a.parquet", ad([(D1, "n", "EUR", "ios", 3.0), (None, "z", "EUR", "ios", 1.0)]))
    go = lambda day: jobs.run_ingest(spark, src, state, rt, tables=names,
                                     now=dt.datetime(2024, 2, day, 6, tzinfo=dt.timezone.utc))
    go(1)
    read = lambda: sorted(map(str, read_tables(spark, *names)[0].collect()))
    before = read()
    put(src, "2024-01-30", "b.parquet", ad([(D1, "n", "EUR", "ios", 5.0), (D0, "k", "EUR", "ios", 2.0)]))
    for step in ("swap_registry", "_replace_dates"):        # after the overwrite, then while the second attempt restores
        with monkeypatch.context() as m:
            m.setattr(sink, step, lambda *a, **k: 1 / 0)
            try:
                go(2)
                raise AssertionError("the run should have died")
            except ZeroDivisionError:
                pass
        if step == "swap_registry":
            assert read() != before
    os.unlink(f"{src}/in/2024-01-30/b.parquet")
    go(3)
    assert read() == before
    kept = [d for d, _, files in os.walk(f"{state}/undo") if files]
    assert kept == []                                       # removed with the commit


def test_run_that_only_missed_its_log_line(spark, scratch, monkeypatch):
    src, state, rt = f"{scratch}/src", f"{scratch}/state", f"{scratch}/rates"
    names = ("t_logless", "r_logless")
    append_rates(rates_df(spark, [(D1, "EUR", 2.0)]), rt)
    put(src, "2024-01-29", "a.parquet", ad([(D1, "n", "EUR", "ios", 3.0)]))
    go = lambda day: jobs.run_ingest(spark, src, state, rt, tables=names,
                                     now=dt.datetime(2024, 2, day, 6, tzinfo=dt.timezone.utc))
    with monkeypatch.context() as m:
        m.setattr(jobs, "publish", lambda *a, **k: 1 / 0)
        try:
            go(1)
            raise AssertionError("the run should have died")
        except ZeroDivisionError:
            pass
    os.unlink(f"{src}/in/2024-01-29/a.parquet")
    put(src, "2024-01-30", "b.parquet", ad([(D1, "m", "EUR", "ios", 4.0)]))
    go(2)
    assert [(r.network, r.file_name) for r in read_tables(spark, *names)[0].collect()] == [("m", "b.parquet")]
    assert len([r for r in sink.run_log(spark, state).collect()]) == 2


def test_emptied_partition_without_date_is_dropped(spark, scratch):
    src, state, rt = f"{scratch}/src", f"{scratch}/state", f"{scratch}/rates"
    names = ("t_nodate", "r_nodate")
    append_rates(rates_df(spark, [(D1, "EUR", 2.0)]), rt)
    put(src, "2024-01-29", "a.parquet", ad([(None, "n", "EUR", "ios", 3.0)]))
    put(src, "2024-01-29", "b.parquet", ad([(D1, "n", "EUR", "ios", 3.0)]))
    go = lambda day: jobs.run_ingest(spark, src, state, rt, tables=names,
                                     now=dt.datetime(2024, 2, day, 6, tzinfo=dt.timezone.utc))
    go(1)
    assert read_tables(spark, *names)[0].count() == 2
    os.unlink(f"{src}/in/2024-01-29/a.parquet")
    go(2)
    assert [r.file_name for r in read_tables(spark, *names)[0].collect()] == ["b.parquet"]
