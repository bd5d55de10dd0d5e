"""Skewed inputs: a third of all rows on one key, a third of the listing as
copies of one content.  Results must equal brute force."""
import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from costledger import operators as ops
from costledger.plans.run import apply_run, frame_loader
from costledger.schemas import REGISTRY, TARGET

from .model import model_run


def test_hot_key_dedup_and_fold_match_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for i in range(30_000):
        if i % 3 == 0:
            key = (dt.date(2024, 1, 30), "hot", "EUR", "ios")
        else:
            key = (dt.date(2024, 1, 1 + rng.randint(0, 9)), f"net{rng.randint(0, 40)}",
                   rng.choice(["EUR", "GBP"]), rng.choice(["ios", "android", None]))
        rows.append((*key, rng.random() * 1000, f"f{i % 17}.parquet", i))
    pdf = pd.DataFrame(rows, columns=["dt", "network", "currency", "platform", "cost", "file_name", "event_id"])
    df = spark.createDataFrame(pdf).repartition(16)
    got = ops.keep_highest_cost(df, tie_breakers=("file_name", "event_id")).toPandas()
    want = (pdf.sort_values(["cost", "file_name", "event_id"], ascending=[False, True, True])
               .drop_duplicates(["dt", "network", "currency", "platform"]))
    assert len(got) == len(want)
    assert sorted(got["event_id"]) == sorted(want["event_id"])
    folded = ops.fold_max_cost(df.withColumn("cost_usd", F.col("cost") * 2)).toPandas()
    assert len(folded) == len(want)
    hot = folded[folded["network"] == "hot"].iloc[0]
    assert hot["cost"] == pdf[pdf["network"] == "hot"]["cost"].max()
    assert abs(hot["cost_usd"] - 2 * hot["cost"]) < 1e-9


def test_hot_copy_group_matches_model(spark):
    rng = random.Random(3)
    contents = {f"h{i}": [((dt.date(2024, 1, 1 + i % 5).isoformat(), "n", "EUR", "ios"), 1.0 + i)]
                for i in range(200)}
    listing = []
    for i in range(600):
        h = "h0" if i % 3 == 0 else f"h{rng.randint(1, 199)}"
        listing.append((f"s3a://b/in/2024-01-{10 + i % 20}/f{i:04d}.parquet", f"f{i:04d}.parquet", h))
    reg, tgt = model_run([], {}, listing, contents, {"EUR": 2.0}, "r1")
    ldf = spark.createDataFrame([(k, k.split("/")[-2], n, h) for k, n, h in listing],
                                "object_key string, folder string, file_name string, file_hash string")
    rows = spark.createDataFrame(
        [(k, key[0], key[1], key[2], key[3], c) for k, n, h in listing for key, c in contents[h]],
        "object_key string, dt string, network string, currency string, platform string, cost double"
    ).withColumn("dt", F.col("dt").cast("date"))
    rates = spark.createDataFrame([(dt.date(2024, 1, 1), "EUR", 2.0)], "date date, currency_code string, rate double")
    res = apply_run(ldf, spark.createDataFrame([], REGISTRY), spark.createDataFrame([], TARGET), rates,
                    frame_loader(rows), "r1", "2024-02-01 00:00:00", "2024-01-30")
    got_t = {(str(r["dt"]), r["network"], r["currency"], r["platform"]): (r["cost"], r["file_version_id"])
             for r in res.target.collect()}
    want_t = {k: (v["cost"], v["file_version_id"]) for k, v in tgt.items()}
    assert got_t == want_t
    got_r = sorted((r["file_name"], r["file_hash"] or "", r["status"]) for r in res.registry.collect())
    want_r = sorted((r["file_name"], r["file_hash"] or "", r["status"]) for r in reg)
    assert got_r == want_r


def test_hot_hash_meets_in_no_task(spark):
    """A third of the versions and of the listed files share one content, with
    AQE off: every other-name lookup equals brute force, and no shuffled row
    of the join belongs to the hot hash."""
    versions = [(f"f{i:05d}.parquet", "hot" if i % 3 == 0 else f"h{i % 400}", f"v{i}", None, None, "processed")
                for i in range(6000)]
    listed = [(f"f{i:05d}.parquet", "hot" if i % 3 == 0 else f"h{(i + 1) % 400}" if i % 5 else None) for i in range(0, 9000, 2)]
    registry, listing = spark.createDataFrame(versions, REGISTRY), spark.createDataFrame(listed, "file_name string, file_hash string")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = ops.previous_version_other_name(listing, registry)
        got = sorted(tuple(r) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    by_hash = {}
    for name, h, v, *_ in versions:
        by_hash.setdefault(h, []).append((name, v))
    want = []
    for name, h in listed:
        others = [x for x in by_hash.get(h, []) if x[0] != name]
        if others:
            want.append((name, h, *min(others)))
    assert got == sorted(want) and len(got) > 2000
    assert plan.count("BroadcastHashJoin") >= 4          # marks and candidates of hot hashes, on both sides
