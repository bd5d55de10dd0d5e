"""apply_run (set-based, all files at once) against the file-by-file model
over random histories of listings: new, unchanged, re-uploaded, renamed,
copied, vanished and rejected files, currencies without a rate."""
import copy
import random

from pyspark.sql import functions as F

from costledger.plans.feed import change_feed, listing_changes
from costledger.plans.run import apply_run, frame_loader
from costledger.schemas import REGISTRY, TARGET

from .model import model_run

CURRENCIES = ["EUR", "GBP", "JPY"]          # JPY has no rate
RATES = {"EUR": 1.1, "GBP": 1.25}
NAMES = [f"f{i}.parquet" for i in range(5)] + ["notes.csv"]


def _contents(rng, n, costs):
    out = {}
    for i in range(n):
        rows = []
        for _ in range(rng.randint(1, 6)):
            key = (f"2024-01-0{rng.randint(1, 2)}", rng.choice(["net_a", "net_b"]),
                   rng.choice(CURRENCIES), rng.choice(["ios", "android"]))
            c = round(rng.uniform(1, 100), 6)
            while c in costs:
                c = round(rng.uniform(1, 100), 6)
            costs.add(c)
            rows.append((key, c))
        out[f"h{i:02d}"] = None if rng.random() < 0.15 else rows
    return out


def _listing(rng, contents, current):
    """Next listing from the current name -> hash map: names vanish, change
    content, appear, get copies of another file's content, or show up in
    two date folders with the same content."""
    hashes = sorted(contents)
    nxt = {}
    for name in NAMES:
        if name in current and rng.random() < 0.6:
            nxt[name] = current[name]
        elif rng.random() < 0.5:
            nxt[name] = rng.choice(hashes)
    if len(nxt) >= 2 and rng.random() < 0.5:
        a, b = rng.sample(sorted(nxt), 2)
        nxt[b] = nxt[a]
    if not nxt:
        nxt[NAMES[0]] = hashes[0]
    out = [(f"s3a://b/in/2024-01-{rng.choice([29, 30])}/{n}", n, h) for n, h in nxt.items()]
    if rng.random() < 0.3:
        k, n, h = out[0]
        out.append((k.replace("/in/", "/re/"), n, h))
    current.clear()
    current.update(nxt)
    return out


def _frames(spark, listing, contents, rates):
    lrows = [(k, k.split("/")[-2], n, h) for k, n, h in listing]
    ldf = spark.createDataFrame(lrows, "object_key string, folder string, file_name string, file_hash string")
    rrows, rej = [], []
    for k, n, h in listing:
        if contents.get(h) is None:
            rej.append((k,))
            continue
        for key, cost in contents[h]:
            rrows.append((k, *key, cost))
    rows = spark.createDataFrame(
        rrows or [("x", "2024-01-01", "n", "EUR", "ios", 0.0)],
        "object_key string, dt string, network string, currency string, platform string, cost double"
    ).withColumn("dt", F.col("dt").cast("date"))
    if not rrows:
        rows = rows.limit(0)
    rejected = spark.createDataFrame(rej or [("none",)], "object_key string")
    if not rej:
        rejected = rejected.limit(0)
    rates_df = spark.createDataFrame([("2024-01-01", c, r) for c, r in rates.items()],
                                     "date string, currency_code string, rate double") \
        .withColumn("date", F.col("date").cast("date"))
    return ldf, rows, rejected, rates_df


def _target_dict(rows):
    return {(str(r["dt"]), r["network"], r["currency"], r["platform"]):
            (r["cost"], round(r["cost_usd"], 9), r["file_name"], r["file_version_id"]) for r in rows}


def _model_target(target):
    return {k: (v["cost"], round(v["cost_usd"], 9), v["file_name"], v["file_version_id"])
            for k, v in target.items()}


def _reg_set(rows):
    return sorted((r["file_name"], r["file_hash"] or "", r["file_version_id"], r["status"])
                  for r in rows)


def test_apply_run_matches_file_by_file_model(spark):
    checked = 0
    for seed in range(5):
        rng = random.Random(seed)
        contents = _contents(rng, 9, set())
        m_reg, m_tgt, current = [], {}, {}
        s_reg = spark.createDataFrame([], REGISTRY)
        s_tgt = spark.createDataFrame([], TARGET)
        for run in range(4):
            listing = _listing(rng, contents, current)
            run_id, run_ts = f"r{seed}-{run}", f"2024-02-0{run + 1} 00:00:00"
            m_reg, m_tgt = model_run(m_reg, m_tgt, listing, contents, RATES, run_id)
            ldf, rows, rejected, rates_df = _frames(spark, listing, contents, RATES)
            res = apply_run(ldf, s_reg, s_tgt, rates_df, frame_loader(rows, rejected),
                            run_id, run_ts, "2024-01-30")
            t_rows, r_rows = res.target.collect(), res.registry.collect()
            assert _target_dict(t_rows) == _model_target(m_tgt), (seed, run, listing)
            assert len(t_rows) == len(m_tgt)
            assert _reg_set(r_rows) == _reg_set(m_reg), (seed, run, listing)
            s_tgt = spark.createDataFrame(t_rows, TARGET)
            s_reg = spark.createDataFrame(r_rows, REGISTRY)
            m_reg = copy.deepcopy(m_reg)
            checked += 1
    assert checked == 20


def test_runs_over_the_change_feed_match_the_model(spark):
    """Every run but the first sees only what its feed names."""
    seen = 0
    for seed in (11, 12, 13):
        rng = random.Random(seed)
        contents = _contents(rng, 9, set())
        m_reg, m_tgt, current = [], {}, {}
        s_reg, s_tgt = spark.createDataFrame([], REGISTRY), spark.createDataFrame([], TARGET)
        before = carry = listing = None
        for run in range(5):
            if run != 3:                    # the fourth run finds the listing of the third
                listing = _listing(rng, contents, current)
            run_id, run_ts = f"r{seed}-{run}", f"2024-02-0{run + 1} 00:00:00"
            m_reg, m_tgt = model_run(m_reg, m_tgt, listing, contents, RATES, run_id)
            ldf, rows, rejected, rates_df = _frames(spark, listing, contents, RATES)
            feed = change_feed(before, ldf, carry) if run else None
            res = apply_run(ldf, s_reg, s_tgt, rates_df, frame_loader(rows, rejected), run_id, run_ts, "2024-01-30",
                            feed=feed)
            t_rows, r_rows = res.target.collect(), res.registry.collect()
            assert _target_dict(t_rows) == _model_target(m_tgt), (seed, run, listing)
            assert _reg_set(r_rows) == _reg_set(m_reg), (seed, run, listing)
            assert res.report.count() == len(listing)
            left = res.carry.collect()
            carry = spark.createDataFrame(left, "file_name string, file_hash string")
            s_tgt, s_reg = spark.createDataFrame(t_rows, TARGET), spark.createDataFrame(r_rows, REGISTRY)
            before, m_reg = ldf, copy.deepcopy(m_reg)
            seen += 1
    assert seen == 15


def test_quiet_run_reads_no_registry_row(spark):
    """An unchanged listing with nothing left open: a registry that fails
    when it is read is not read."""
    listing = spark.createDataFrame([("in/a.parquet", "in", "a.parquet", "h1"), ("in/n.csv", "in", "n.csv", None)],
                                    "object_key string, folder string, file_name string, file_hash string")
    names = F.when(F.lit(True), F.raise_error(F.lit("the registry was read"))).cast("string")
    registry = spark.createDataFrame([("x",) * 4], "file_name string, file_hash string, file_version_id string, status string") \
        .select(names.alias("file_name"), "file_hash", "file_version_id",
                F.lit(None).cast("timestamp_ntz").alias("upload_date"),
                F.lit(None).cast("timestamp_ntz").alias("processed_date"), "status")
    none = spark.createDataFrame([], "file_name string, file_hash string")
    rows = spark.createDataFrame([], "object_key string, dt date, network string, currency string, platform string, cost double")
    rates = spark.createDataFrame([], "currency_code string, date date, rate double")
    res = apply_run(listing, registry, spark.createDataFrame([], TARGET), rates, frame_loader(rows), "r", "2024-02-01 00:00:00",
                    "2024-02-01", feed=change_feed(listing, listing, none))
    s = res.summary.first()
    assert (s["n_unchanged"], s["n_skipped"], s["n_dead_versions"]) == (1, 1, 0)
    assert res.target.count() == 0 and res.carry.count() == 0


def test_listing_changes_with_nulls(spark):
    schema = "object_key string, file_name string, file_hash string"
    b = spark.createDataFrame([("k1", "a", "1"), ("k2", "b", None), ("k3", "c", "3"), ("k4", "d", None)], schema)
    n = spark.createDataFrame([("k1", "a", "2"), ("k2", "b", None), ("k4", "d", "4"), ("k5", "e", None)], schema)
    assert sorted(listing_changes(b, n).collect(), key=str) == sorted(
        [("k1", "a", "1", "before"), ("k1", "a", "2", "after"), ("k3", "c", "3", "gone"), ("k4", "d", None, "before"),
         ("k4", "d", "4", "after"), ("k5", "e", None, "added")], key=str)
