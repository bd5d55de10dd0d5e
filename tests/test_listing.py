"""Listing level by level, dealing by bytes, and copies per thread."""
import os
import threading

import pytest
from pyspark.sql import functions as F

from costledger.session import materialize, own_copies, settled
from costledger.sources import list_objects, listing
from costledger.sources.listing import spread


def test_one_top_folder_is_listed_by_many_tasks(spark, scratch, monkeypatch):
    want = set()
    for k in range(300):
        os.makedirs(f"{scratch}/ads/day{k:03d}/deep" if k % 50 == 0 else f"{scratch}/ads/day{k:03d}")
        for path in [f"ads/day{k:03d}/f.parquet"] + ([f"ads/day{k:03d}/deep/_g.parquet"] if k % 50 == 0 else []):
            with open(f"{scratch}/{path}", "w") as f:
                f.write("x" * (k % 7))
            want.add((f"file:{scratch}/{path}", k % 7))
    levels = []
    real = listing.materialize

    def noted(df):
        levels.append(df.rdd.getNumPartitions())
        return real(df)

    monkeypatch.setattr(listing, "_TASK_FOLDERS", 20)
    monkeypatch.setattr(listing, "materialize", noted)
    rows = list_objects(spark, scratch, with_hash=False).collect()
    assert {(r.object_key, r.length) for r in rows} == want and len(rows) == len(want)
    assert levels[:4] == [1, 1, 16, 4]      # root, ads, 300 days by twenties, 6 deep folders over 4 cores


def test_empty_root_and_vanished_folder(spark, scratch):
    assert list_objects(spark, scratch).collect() == []
    gone = spark.createDataFrame([(f"file:{scratch}/gone",)], "object_key string")
    assert gone.mapInPandas(listing._lister(False), listing._ENTRY).collect() == []
    with pytest.raises(Exception, match="gone"):
        list_objects(spark, f"{scratch}/gone").collect()


@pytest.mark.parametrize("big", [1, 20])
def test_no_task_holds_more_than_its_share_and_one_object(spark, big):
    """Sizes 1 : 10,000, the big ones side by side in name order."""
    small, large = 100_000, 1_000_000_000
    rows = [(f"a{k:04d}", large) for k in range(big)] + [(f"b{k:04d}", small) for k in range(2000)]
    df = materialize(spark.createDataFrame(rows, "object_key string, length long"))
    out = spread(df, ["object_key"], "length", task_bytes=50_000_000)
    cost = F.col("length") + listing._OPEN_BYTES
    per = out.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(cost).alias("b"), F.max(cost).alias("top"),
                                                              F.count("*").alias("n")).collect()
    total = sum(s + listing._OPEN_BYTES for _, s in rows)
    share = -(-total // min(len(rows), total // 50_000_000 + 1))
    assert sum(r.n for r in per) == len(rows) and out.columns == ["object_key", "length"]
    assert all(r.b <= share + r.top for r in per)
    assert max(r.n for r in per if r.top > small + listing._OPEN_BYTES) <= share // small + 2


def test_spread_of_nothing_and_of_empty_objects(spark):
    df = spark.createDataFrame([("a", 0), ("b", None), ("c", 0)], "object_key string, length long")
    assert sorted(r[0] for r in spread(materialize(df), ["object_key"], "length").collect()) == ["a", "b", "c"]
    assert spread(materialize(df.limit(0)), ["object_key"], "length").collect() == []


def test_copies_belong_to_the_thread_that_writes_them(spark):
    """A job that ends in one thread removes nothing of another's."""
    inside, done = threading.Event(), threading.Event()

    def other():
        with own_copies(spark):
            materialize(spark.range(3))
            inside.set()
            done.wait(60)
        settled(spark, lambda: materialize(spark.range(4)))

    t = threading.Thread(target=other)
    t.start()
    assert inside.wait(60)
    mine = materialize(spark.range(5))
    kept = settled(spark, lambda: materialize(spark.range(6)))
    done.set()
    t.join(60)
    assert (mine.count(), kept.count()) == (5, 6)


def test_stream_beside_a_query_loses_no_table(spark, scratch):
    src = f"{scratch}/src"
    spark.range(1).write.parquet(src)
    begun, go_on = threading.Event(), threading.Event()

    def each(batch, _):
        with own_copies(spark):
            materialize(batch)
            begun.set()
            go_on.wait(60)

    q = (spark.readStream.schema("id long").parquet(src).writeStream.foreachBatch(each)
         .option("checkpointLocation", f"{scratch}/c").trigger(availableNow=True).start())
    assert begun.wait(60)
    with own_copies(spark):
        mine = materialize(spark.range(7))
        go_on.set()
        q.awaitTermination(60)
        assert q.exception() is None and mine.count() == 7
