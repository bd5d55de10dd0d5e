"""Sources, sinks, a full run over real Parquet files, publishing and the
streaming front end."""
import datetime as dt
import decimal
import json
import os
import tempfile

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from costledger.plans.run import EmptyListing, apply_run, rebuild
from costledger.schemas import REGISTRY, TARGET
from costledger.sinks import append_rates, publish, read_state, run_log, write_ndjson
from costledger.sources import (list_objects, parquet_loader, read_ad_files, read_rates_ndjson,
                                read_rates_payloads, read_rates_table)
from costledger.streaming import start_ingest_stream

D1, D2 = dt.date(2024, 1, 29), dt.date(2024, 1, 30)


def put(root, folder, name, df):
    os.makedirs(f"{root}/in/{folder}", exist_ok=True)
    path = f"{root}/in/{folder}/{name}"
    if isinstance(df, pa.Table):
        pq.write_table(df, path)
    else:
        df.to_parquet(path, index=False)
    return path


def ad(rows, **extra):
    df = pd.DataFrame(rows, columns=["dt", "network", "currency", "platform", "cost"])
    for k, v in extra.items():
        df[k] = v
    return df


def rates_df(spark, rows):
    return spark.createDataFrame(rows, "date date, currency_code string, rate double")


def test_listing_and_reader_groups_schemas(spark, scratch):
    put(scratch, "2024-01-29", "a.parquet", ad([(D1, "n", "EUR", "ios", 1.5)], extra_col=1))
    put(scratch, "2024-01-30", "b.parquet", pa.table({
        "dt": ["2024-01-30"], "network": ["n"], "currency": ["EUR"], "platform": ["android"],
        "cost": pa.array([decimal.Decimal("2.25")], pa.decimal128(10, 2))}))
    put(scratch, "2024-01-30", "c.parquet", pd.DataFrame({"dt": [D2], "network": ["n"],
                                                         "currency": ["EUR"], "cost": [9.0]}))
    with open(f"{scratch}/in/2024-01-30/notes.csv", "w") as f:
        f.write("x\n")
    listing = list_objects(spark, scratch)
    got = {r["file_name"]: r for r in listing.collect()}
    assert set(got) == {"a.parquet", "b.parquet", "c.parquet", "notes.csv"}
    assert got["a.parquet"]["folder"] == "2024-01-29" and len(got["a.parquet"]["file_hash"]) == 32
    files = listing.filter(F.col("file_name").endswith(".parquet"))
    rows, rejected, read = read_ad_files(spark, files)
    assert sorted((r["n_rows"], r["cast_failures"]) for r in read.collect()) == [(1, 0), (1, 0)]
    out = sorted((r["object_key"].split("/")[-1], r["dt"], r["cost"]) for r in rows.collect())
    assert out == [("a.parquet", D1, 1.5), ("b.parquet", D2, 2.25)]
    assert [r["missing"] for r in rejected.collect()] == ["platform"]
    padded, none, _ = read_ad_files(spark, files, pad_missing=True)
    assert padded.count() == 3 and none.count() == 0
    put(scratch, "2024-01-30", "d.parquet", pd.DataFrame({"dt": [D2], "network": ["n"],
                                                         "currency": ["EUR"], "platform": ["ios"]}))
    files = list_objects(spark, scratch).filter(F.col("file_name").endswith(".parquet"))
    padded, rej, _ = read_ad_files(spark, files, pad_missing=True)
    assert padded.count() == 3 and [r["missing"] for r in rej.collect()] == ["cost"]


def _run(spark, root, state, rates, run_id, run_date="2024-01-30", allow_empty=False):
    target, registry = read_state(spark, state)
    listing = list_objects(spark, root)
    res = apply_run(listing, registry, target, rates, parquet_loader(spark), run_id,
                    f"{run_date} 01:00:00", run_date, allow_empty=allow_empty)
    publish(spark, state, run_id, res.target, res.registry)
    return res


def test_runs_over_files_rename_vanish_copy(spark, scratch):
    rates = rates_df(spark, [(D1, "EUR", 2.0)])
    state = f"{scratch}/state"
    a = ad([(D1, "n", "EUR", "ios", 10.0)])
    b = ad([(D1, "n", "EUR", "ios", 20.0), (D1, "m", "EUR", "ios", 1.0)])
    r1 = f"{scratch}/run1"
    put(r1, "2024-01-29", "A.parquet", a)
    put(r1, "2024-01-30", "B.parquet", b)
    res = _run(spark, r1, state, rates, "run1")
    s = res.summary.first()
    assert s["n_ingested"] == 2 and s["found_today_file"]
    target, registry = read_state(spark, state)
    assert {(r["network"], r["cost"], r["cost_usd"], r["file_name"]) for r in target.collect()} == \
        {("n", 20.0, 40.0, "B.parquet"), ("m", 1.0, 2.0, "B.parquet")}
    # run 2: B vanished (its rows go, A's lower cost is not restored), A copied as A2
    r2 = f"{scratch}/run2"
    put(r2, "2024-01-29", "A.parquet", a)
    put(r2, "2024-01-30", "A2.parquet", a)
    res = _run(spark, r2, state, rates, "run2", run_date="2024-01-31")
    assert res.summary.first()["found_today_file"] is False          # late file: flag only
    target, registry = read_state(spark, state)
    assert {(r["network"], r["cost"], r["file_name"]) for r in target.collect()} == \
        {("n", 10.0, "A2.parquet")}
    live = {(r["file_name"]) for r in registry.collect() if r["status"] == "processed"}
    assert live == {"A2.parquet"}
    deleted = [r for r in registry.collect() if r["status"] == "deleted"]
    assert all(r["file_hash"] is None for r in deleted) and len(deleted) == 2
    # rebuild from scratch gives the whole-history view: A's 10 for key n
    rb = rebuild(list_objects(spark, r2), rates, parquet_loader(spark), "latest").collect()
    assert [(r["network"], r["cost"]) for r in rb] == [("n", 10.0)]
    assert run_log(spark, state).count() == 2
    # publishing the same run id again is a no-op
    publish(spark, state, "run2", res.target, res.registry)
    assert run_log(spark, state).count() == 2


def test_incremental_listing_rehashes_only_changed(spark, scratch):
    put(scratch, "2024-01-29", "a.parquet", ad([(D1, "n", "EUR", "ios", 1.0)]))
    put(scratch, "2024-01-29", "b.parquet", ad([(D1, "n", "EUR", "ios", 2.0)]))
    first = list_objects(spark, scratch).collect()
    # a known hash that differs from the content proves it was reused, not recomputed
    known = spark.createDataFrame(first).withColumn(
        "file_hash", F.when(F.col("file_name") == "a.parquet", F.lit("cached")).otherwise(F.col("file_hash")))
    put(scratch, "2024-01-30", "c.parquet", ad([(D2, "n", "EUR", "ios", 3.0)]))
    again = {r["file_name"]: r["file_hash"] for r in list_objects(spark, scratch, known=known).collect()}
    full = {r["file_name"]: r["file_hash"] for r in list_objects(spark, scratch).collect()}
    assert again["a.parquet"] == "cached"
    assert again["b.parquet"] == full["b.parquet"] and again["c.parquet"] == full["c.parquet"]


def test_rejected_file_is_retried(spark, scratch):
    rates = rates_df(spark, [(D1, "EUR", 2.0)])
    state = f"{scratch}/state"
    put(scratch, "2024-01-30", "bad.parquet",
        pd.DataFrame({"dt": [D1], "network": ["n"], "currency": ["EUR"], "cost": [3.0]}))
    res = _run(spark, scratch, state, rates, "r1")
    assert [r["action"] for r in res.report.collect()] == ["rejected"]
    _, registry = read_state(spark, state)
    assert registry.count() == 0


def test_empty_listing_aborts(spark, scratch):
    empty = spark.createDataFrame([], "object_key string, folder string, file_name string, file_hash string")
    reg, tgt = spark.createDataFrame([], REGISTRY), spark.createDataFrame([], TARGET)
    with pytest.raises(EmptyListing):
        apply_run(empty, reg, tgt, rates_df(spark, []), parquet_loader(spark), "r", "2024-01-30 00:00:00",
                  "2024-01-30")


def test_rates_sources_and_sink(spark, scratch):
    os.makedirs(f"{scratch}/payloads")
    with open(f"{scratch}/payloads/p1.json", "w") as f:
        json.dump({"base": "USD", "rates": {"EUR": 0.9, "GBP": 0.8}}, f, indent=2)
    rows = read_rates_payloads(spark, f"{scratch}/payloads", fetch_date="2024-01-30")
    assert sorted((r["currency_code"], r["rate"], r["date"]) for r in rows.collect()) == \
        [("EUR", 0.9, D2), ("GBP", 0.8, D2)]
    write_ndjson(rows, f"{scratch}/ndjson")
    assert read_rates_ndjson(spark, f"{scratch}/ndjson").count() == 2
    append_rates(rows, f"{scratch}/rates")
    append_rates(rows, f"{scratch}/rates")
    assert read_rates_table(spark, f"{scratch}/rates").count() == 4
    with open(f"{scratch}/bad.json", "w") as f:
        f.write('{"date": "2024-01-30", "currency_code": null, "rate": 1.0}\n')
    with pytest.raises(Exception):
        read_rates_ndjson(spark, f"{scratch}/bad.json").collect()


def test_stream_available_now(spark, scratch):
    src, state = f"{scratch}/src", f"{scratch}/state"
    put(src, "2024-01-29", "a.parquet", ad([(D1, "n", "EUR", "ios", 4.0)]))
    put(src, "2024-01-30", "b.parquet", ad([(D1, "n", "EUR", "ios", 6.0), (D2, "n", "EUR", "ios", 1.0)]))
    rates = rates_df(spark, [(D1, "EUR", 2.0)])
    q = start_ingest_stream(spark, src, state, rates, "2024-01-30 00:00:00",
                            checkpoint=f"{scratch}/ckpt")
    q.awaitTermination(120)
    target, _ = read_state(spark, state)
    assert sorted((r["dt"], r["cost"], r["file_name"]) for r in target.collect()) == \
        [(D1, 6.0, "b.parquet"), (D2, 1.0, "b.parquet")]


def test_load_rates_job_and_empty_payload(spark, scratch):
    from costledger.plans.rates_job import NoRates, load_rates
    os.makedirs(f"{scratch}/p")
    with open(f"{scratch}/p/a.json", "w") as f:
        json.dump({"rates": {"EUR": 0.9}}, f)
    assert load_rates(spark, f"{scratch}/p", f"{scratch}/rates", "2024-01-30") == 1
    assert read_rates_table(spark, f"{scratch}/rates").count() == 1
    os.makedirs(f"{scratch}/empty")
    with open(f"{scratch}/empty/a.json", "w") as f:
        json.dump({"error": "quota"}, f)
    with pytest.raises(NoRates):
        load_rates(spark, f"{scratch}/empty", f"{scratch}/rates2", "2024-01-30")


def test_truncate_table(spark):
    from costledger.sinks import truncate_table
    spark.sql("DROP TABLE IF EXISTS costledger_truncate_probe")
    spark.range(3).write.format("parquet").saveAsTable("costledger_truncate_probe")
    truncate_table(spark, "costledger_truncate_probe")
    assert spark.table("costledger_truncate_probe").count() == 0
    spark.sql("DROP TABLE costledger_truncate_probe")


def test_run_clock():
    from costledger.plans.run import run_clock
    run_id, ts, day = run_clock(dt.datetime(2024, 1, 30, 12, 0, 5, tzinfo=dt.timezone.utc))
    assert (run_id[:19], ts, day) == ("run-20240130T120005", "2024-01-30 12:00:05", "2024-01-30")
    assert run_clock()[0] != run_clock()[0]          # also within one second


def test_jobs_ingest_twice_reuses_listing_and_reset(spark, scratch):
    from costledger.plans.jobs import reset_state, run_ingest
    from costledger.sinks import read_listing
    src, state, rt = f"{scratch}/src", f"{scratch}/state", f"{scratch}/rates"
    append_rates(rates_df(spark, [(D1, "EUR", 2.0)]), rt)
    put(src, "2024-01-30", "a.parquet", ad([(D1, "n", "EUR", "ios", 3.0)]))
    res = run_ingest(spark, src, state, rt, now=dt.datetime(2024, 1, 30, 6, tzinfo=dt.timezone.utc))
    assert res.summary.first()["n_ingested"] == 1
    assert read_listing(spark, state).count() == 1
    res = run_ingest(spark, src, state, rt, now=dt.datetime(2024, 1, 31, 6, tzinfo=dt.timezone.utc))
    s = res.summary.first()
    assert s["n_ingested"] == 0 and s["n_unchanged"] == 1 and s["found_today_file"] is False
    target, _ = read_state(spark, state)
    assert [(r["cost"], r["cost_usd"]) for r in target.collect()] == [(3.0, 6.0)]
    reset_state(spark, state, now=dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))
    target, registry = read_state(spark, state)
    assert target.count() == 0 and registry.count() == 0


def test_publish_tables_rewrites_only_touched_dates(spark, scratch):
    from costledger.sinks import publish_tables, read_tables
    rates = rates_df(spark, [(D1, "EUR", 2.0)])
    D0 = dt.date(2024, 1, 28)
    tt, rt = "t_target_probe", "t_registry_probe"

    def run(root, run_id, day):
        target, registry = read_tables(spark, tt, rt)
        res = apply_run(list_objects(spark, root), registry, target, rates, parquet_loader(spark),
                        run_id, f"{day} 01:00:00", day)
        publish_tables(spark, tt, rt, res.touched_dates, res.target_touched, res.registry)
        return res

    r1 = f"{scratch}/r1"
    a = ad([(D0, "n", "EUR", "ios", 1.0)])
    put(r1, "2024-01-28", "A.parquet", a)
    put(r1, "2024-01-29", "B.parquet", ad([(D1, "n", "EUR", "ios", 2.0)]))
    run(r1, "run1", "2024-01-29")
    files_a = {r[0] for r in spark.table(tt).filter(F.col("dt") == D0)
               .select(F.input_file_name()).collect()}
    r2 = f"{scratch}/r2"
    put(r2, "2024-01-28", "A.parquet", a)        # B vanished: its date becomes empty
    put(r2, "2024-01-30", "C.parquet", ad([(D2, "n", "EUR", "ios", 3.0)]))
    run(r2, "run2", "2024-01-30")
    got = sorted((r["dt"], r["cost"], r["file_name"]) for r in spark.table(tt).collect())
    assert got == [(D0, 1.0, "A.parquet"), (D2, 3.0, "C.parquet")]
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {tt}").collect()}
    assert parts == {"dt=2024-01-28", "dt=2024-01-30"}
    files_a2 = {r[0] for r in spark.table(tt).filter(F.col("dt") == D0)
                .select(F.input_file_name()).collect()}
    assert files_a == files_a2                    # the untouched date was not rewritten
    live = {r["file_name"] for r in spark.table(rt).collect() if r["status"] == "processed"}
    assert live == {"A.parquet", "C.parquet"}


def test_jobs_ingest_into_tables(spark, scratch):
    from costledger.plans.jobs import run_ingest
    from costledger.sinks import read_tables
    src, state, rt = f"{scratch}/src", f"{scratch}/state", f"{scratch}/rates"
    tables = ("t_job_target", "t_job_registry")
    append_rates(rates_df(spark, [(D1, "EUR", 2.0)]), rt)
    put(src, "2024-01-30", "a.parquet", ad([(D1, "n", "EUR", "ios", 3.0)]))
    run_ingest(spark, src, state, rt, now=dt.datetime(2024, 1, 30, 6, tzinfo=dt.timezone.utc), tables=tables)
    res = run_ingest(spark, src, state, rt, now=dt.datetime(2024, 1, 31, 6, tzinfo=dt.timezone.utc),
                     tables=tables)
    assert res.summary.first()["n_unchanged"] == 1
    target, registry = read_tables(spark, *tables)
    assert [(r["cost"], r["cost_usd"]) for r in target.collect()] == [(3.0, 6.0)]
    assert registry.count() == 1


def test_stream_into_tables(spark, scratch):
    from costledger.sinks import read_tables
    src = f"{scratch}/src"
    tables = ("t_stream_target", "t_stream_registry")
    put(src, "2024-01-29", "a.parquet", ad([(D1, "n", "EUR", "ios", 4.0), (D2, "m", "EUR", "ios", 1.0)]))
    rates = rates_df(spark, [(D1, "EUR", 2.0)])
    q = start_ingest_stream(spark, src, None, rates, "2024-01-30 00:00:00",
                            checkpoint=f"{scratch}/ckpt", tables=tables)
    q.awaitTermination(120)
    put(src, "2024-01-30", "b.parquet", ad([(D1, "n", "EUR", "ios", 6.0)]))   # a later file
    q = start_ingest_stream(spark, src, None, rates, "2024-01-31 00:00:00",
                            checkpoint=f"{scratch}/ckpt", tables=tables)
    q.awaitTermination(120)
    target, _ = read_tables(spark, *tables)
    assert sorted((r["dt"], r["cost"], r["file_name"]) for r in target.collect()) == \
        [(D1, 6.0, "b.parquet"), (D2, 1.0, "a.parquet")]


def test_md5_of_small_and_large_objects(spark, scratch):
    import hashlib
    put(scratch, "2024-01-29", "a.parquet", ad([(D1, "n", "EUR", "ios", 1.0)] * 50))
    with open(f"{scratch}/in/2024-01-29/big.bin", "wb") as f:
        f.write(os.urandom(20 << 20))                     # 20 MB: more than two chunks
    for r in list_objects(spark, scratch).collect():
        with open(r["object_key"].removeprefix("file:"), "rb") as f:
            assert r["file_hash"] == hashlib.md5(f.read()).hexdigest()
    assert list_objects(spark, scratch, glob="*.bin").count() == 1


ODD_NAMES = ["a b.parquet", "a%b.parquet", "a%20b.parquet", "a+b.parquet", "é日.parquet", "a[1].parquet", "a{x}*?.parquet",
             "_a.parquet", ".a.parquet", "a,b.parquet"]


def test_names_keep_their_rows(spark, scratch):
    """Any name a store allows: listed, read and recorded under one spelling,
    also below a folder with a space."""
    rates = rates_df(spark, [(D1, "EUR", 2.0)])
    src = f"{scratch}/my src"
    for k, name in enumerate(ODD_NAMES):
        put(src, "2024-01-30", name, ad([(D1, f"n{k}", "EUR", "ios", 1.0 + k)]))
    res = _run(spark, src, f"{scratch}/state", rates, "run1")
    assert {r["action"] for r in res.report.collect()} == {"ingested"}
    target, registry = read_state(spark, f"{scratch}/state")
    assert sorted((r["network"], r["file_name"]) for r in target.collect()) == \
        sorted((f"n{k}", name) for k, name in enumerate(ODD_NAMES))
    assert sorted(r["file_name"] for r in registry.collect()) == sorted(ODD_NAMES)
    again = _run(spark, src, f"{scratch}/state", rates, "run2")
    assert {r["action"] for r in again.report.collect()} == {"unchanged"}


def test_relative_roots_are_qualified(spark, scratch, monkeypatch):
    from costledger.sources.listing import qualified
    assert qualified(spark, "/a b/c%20d") == "file:/a b/c%20d"
    assert qualified(spark, "land/ads").startswith("file:/") and qualified(spark, "land/ads").endswith("/land/ads")
    put(scratch, "2024-01-30", "a.parquet", ad([(D1, "n", "EUR", "ios", 1.0)]))
    for root in (scratch, f"file:{scratch}", f"file://{scratch}"):
        assert [r["object_key"] for r in list_objects(spark, root, with_hash=False).collect()] == \
            [f"file:{scratch}/in/2024-01-30/a.parquet"]


def test_damaged_files_are_rejected_with_a_reason(spark, scratch):
    rates = rates_df(spark, [(D1, "EUR", 2.0)])
    good = put(scratch, "2024-01-30", "good.parquet", ad([(D1, "n", "EUR", "ios", 1.0)]))
    with open(good, "rb") as f:
        whole = f.read()
    with open(f"{scratch}/in/2024-01-30/cut.parquet", "wb") as f:
        f.write(whole[:len(whole) // 2])
    with open(f"{scratch}/in/2024-01-30/text.parquet", "wb") as f:
        f.write(b"not a file of columns")
    with open(f"{scratch}/in/2024-01-30/page.parquet", "wb") as f:
        f.write(whole[:4] + b"\xff" * 60 + whole[64:])              # the footer is fine, a page is not
    put(scratch, "2024-01-30", "odd.parquet", pa.table({
        "dt": ["2024-01-29", "no day"], "network": ["m", "k"], "currency": ["EUR", "EUR"], "platform": ["ios", "ios"],
        "cost": ["2.5", "much"]}))
    res = _run(spark, scratch, f"{scratch}/state", rates, "run1")
    got = {r["file_name"]: r for r in res.report.collect()}
    assert {n: r["action"] for n, r in got.items()} == {
        "good.parquet": "ingested", "odd.parquet": "ingested", "cut.parquet": "rejected", "text.parquet": "rejected",
        "page.parquet": "rejected"}
    assert all(got[n]["reason"] for n in ("cut.parquet", "text.parquet", "page.parquet"))
    assert got["odd.parquet"]["cast_failures"] == 2 and got["odd.parquet"]["n_rows"] == 2
    target, _ = read_state(spark, f"{scratch}/state")
    assert sorted((r["network"], r["cost"]) for r in target.collect()) == [("m", 2.5), ("n", 1.0)]


def test_state_that_cannot_be_read_is_no_first_run(spark, scratch):
    os.makedirs(f"{scratch}/state/_runs")
    assert run_log(spark, f"{scratch}/none").count() == 0
    with open(f"{scratch}/state/_runs/part.json.gz", "wb") as f:
        f.write(b"damaged")
    with pytest.raises(Exception):
        run_log(spark, f"{scratch}/state").collect()


def test_rates_payload_damage_and_session_zone(spark, scratch):
    os.makedirs(f"{scratch}/p")
    with open(f"{scratch}/p/a.json", "w") as f:
        json.dump({"rates": {"EUR": 0.9}}, f)
    at = dt.datetime(2024, 1, 30, 23, 30, tzinfo=dt.timezone.utc).timestamp()
    os.utime(f"{scratch}/p/a.json", (at, at))
    zone = spark.conf.get("spark.sql.session.timeZone")
    for z in ("Asia/Tokyo", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", z)
        try:
            assert [r["date"] for r in read_rates_payloads(spark, f"{scratch}/p").collect()] == [D2]
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
    with open(f"{scratch}/p/b.json", "w") as f:
        f.write('{"rates": {"EUR": 0.9, "GBP"')
    with pytest.raises(Exception, match="damaged rates payload"):
        read_rates_payloads(spark, f"{scratch}/p").collect()


def _stream(spark, src, state, day, **kw):
    q = start_ingest_stream(spark, src, state, rates_df(spark, [(D1, "EUR", 2.0)]), f"{day} 00:00:00", **kw)
    q.awaitTermination(120)
    assert q.exception() is None


def test_stream_loses_nothing(spark, scratch):
    """A later session, a new checkpoint, a second source, rows without a
    date; a batch run afterwards finds every file unchanged."""
    from costledger.plans.jobs import run_ingest
    src, other, state, rt = f"{scratch}/src", f"{scratch}/other", f"{scratch}/state", f"{scratch}/rates"
    append_rates(rates_df(spark, [(D1, "EUR", 2.0)]), rt)
    put(src, "2024-01-29", "a.parquet", ad([(D1, "n", "EUR", "ios", 4.0), (None, "z", "EUR", "ios", 1.0)]))
    _stream(spark, src, state, "2024-01-30")
    put(src, "2024-01-30", "b.parquet", ad([(D1, "m", "EUR", "ios", 5.0)]))
    _stream(spark, src, state, "2024-01-31")                                          # goes on where it stopped
    put(src, "2024-01-30", "c.parquet", ad([(D1, "k", "EUR", "ios", 6.0)]))
    _stream(spark, src, state, "2024-02-01", checkpoint=f"{scratch}/fresh")           # starts over: a and b again
    put(other, "2024-01-30", "d.parquet", ad([(None, "y", "EUR", "ios", 7.0)]))
    _stream(spark, other, state, "2024-02-02")
    want = [("k", 6.0), ("m", 5.0), ("n", 4.0), ("y", 7.0), ("z", 1.0)]
    target, registry = read_state(spark, state)
    assert sorted((r["network"], r["cost"]) for r in target.collect()) == want
    assert sorted(r["file_name"] for r in registry.where("status = 'processed'").collect()) == \
        ["a.parquet", "b.parquet", "c.parquet", "d.parquet"]
    os.makedirs(f"{src}/in/2024-02-03")
    with open(f"{other}/in/2024-01-30/d.parquet", "rb") as f, open(f"{src}/in/2024-02-03/d.parquet", "wb") as g:
        g.write(f.read())
    res = run_ingest(spark, src, state, rt, now=dt.datetime(2024, 2, 3, 6, tzinfo=dt.timezone.utc))
    assert {r["action"] for r in res.report.collect()} == {"unchanged"}
    assert sorted((r["network"], r["cost"]) for r in read_state(spark, state)[0].collect()) == want


def test_stream_into_tables_keeps_rows_without_date(spark, scratch):
    from costledger.sinks import read_tables
    tables = ("t_null_target", "t_null_registry")
    src = f"{scratch}/src"
    put(src, "2024-01-29", "a.parquet", ad([(None, "z", "EUR", "ios", 1.0), (D1, "n", "EUR", "ios", 4.0)]))
    _stream(spark, src, None, "2024-01-30", checkpoint=f"{scratch}/c", tables=tables)
    put(src, "2024-01-30", "b.parquet", ad([(None, "y", "EUR", "ios", 2.0)]))
    _stream(spark, src, None, "2024-01-31", checkpoint=f"{scratch}/c", tables=tables)
    target, _ = read_tables(spark, *tables)
    assert sorted((r["network"], r["cost"]) for r in target.collect()) == [("n", 4.0), ("y", 2.0), ("z", 1.0)]


class Dead(Exception):
    pass


def _history(spark, scratch, monkeypatch, label, dies_after=None):
    """A file, a second one (the run over it may die after a write step and
    is redone later), the second one vanishes: the state, comparable."""
    from costledger.plans import jobs
    from costledger.sinks import read_tables
    from costledger.sinks import tables as sink

    src, state, rt = f"{scratch}/src_{label}", f"{scratch}/state_{label}", f"{scratch}/rates_{label}"
    tables = (f"t_crash_{label}", f"r_crash_{label}")
    append_rates(rates_df(spark, [(D1, "EUR", 2.0)]), rt)
    put(src, "2024-01-29", "a.parquet", ad([(D1, "n", "EUR", "ios", 3.0), (D2, "m", "EUR", "ios", 1.0)]))
    go = lambda day: jobs.run_ingest(spark, src, state, rt, tables=tables,
                                     now=dt.datetime(2024, 2, day, 6, tzinfo=dt.timezone.utc))
    go(1)
    put(src, "2024-01-30", "b.parquet", ad([(D1, "n", "EUR", "ios", 5.0), (D2, "k", "EUR", "ios", 2.0)]))
    if dies_after:
        def dying(f):
            def g(*a, **k):
                f(*a, **k)
                raise Dead
            return g
        with monkeypatch.context() as m:
            if dies_after == "intent":
                m.setattr(jobs, "list_objects", dying(lambda *a, **k: None))
            elif dies_after == "target":
                m.setattr(sink, "swap_registry", dying(lambda *a, **k: None))
            else:
                m.setattr(sink, "swap_registry", dying(sink.swap_registry))
            with pytest.raises(Dead):
                go(2)
    go(3 if dies_after else 2)
    os.unlink(f"{src}/in/2024-01-30/b.parquet")
    go(4)
    target, registry = read_tables(spark, *tables)
    rows = target.collect()
    versions = {r["file_version_id"] for r in registry.where("status = 'processed'").collect()}
    assert {r["file_version_id"] for r in rows} <= versions
    return (sorted((r["dt"], r["network"], r["cost"], r["file_name"]) for r in rows),
            sorted((r["file_name"], r["file_hash"] or "", r["status"]) for r in registry.collect()))


@pytest.fixture(scope="module")
def calm(spark):
    return _history(spark, tempfile.mkdtemp(prefix="costledger-test-"), None, "calm")


@pytest.mark.parametrize("dies_after", ["intent", "target", "registry"])
def test_run_that_dies_is_redone(spark, scratch, monkeypatch, calm, dies_after):
    """Killed after each write step, redone later, then a file vanishes:
    target and registry equal those of an undisturbed history."""
    assert _history(spark, scratch, monkeypatch, dies_after, dies_after) == calm


def test_file_that_vanishes_between_attempts(spark, scratch, monkeypatch):
    """Rows that a dead attempt wrote don't outlive their file."""
    from costledger.plans import jobs
    from costledger.sinks import read_tables
    from costledger.sinks import tables as sink
    src, state, rt = f"{scratch}/src", f"{scratch}/state", f"{scratch}/rates"
    tables = ("t_orphan", "r_orphan")
    append_rates(rates_df(spark, [(D1, "EUR", 2.0)]), rt)
    put(src, "2024-01-29", "a.parquet", ad([(D1, "n", "EUR", "ios", 3.0)]))
    go = lambda day: jobs.run_ingest(spark, src, state, rt, tables=tables,
                                     now=dt.datetime(2024, 2, day, 6, tzinfo=dt.timezone.utc))
    go(1)
    put(src, "2024-01-30", "b.parquet", ad([(D2, "k", "EUR", "ios", 2.0)]))
    with monkeypatch.context() as m:
        m.setattr(sink, "swap_registry", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            go(2)
    os.unlink(f"{src}/in/2024-01-30/b.parquet")
    go(3)
    target, registry = read_tables(spark, *tables)
    assert [(r["network"], r["file_name"]) for r in target.collect()] == [("n", "a.parquet")]
    assert [r["file_name"] for r in registry.where("status = 'processed'").collect()] == ["a.parquet"]
    jobs.reset_state(spark, state, tables=tables)
    assert [t.count() for t in read_tables(spark, *tables)] == [0, 0]


def test_preview_prints_rows(spark, capsys):
    from costledger.sinks import preview
    preview(spark.range(3), 2)
    assert "|0" in capsys.readouterr().out
