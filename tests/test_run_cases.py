"""Named file histories of the ingest run (FIXTURES.md section 3)."""
import datetime as dt

from pyspark.sql import functions as F

from costledger.plans.run import apply_run, frame_loader
from costledger.schemas import REGISTRY, TARGET

D = dt.date(2024, 1, 30)
KEY = (D, "net", "EUR", "ios")


class History:
    def __init__(self, spark):
        self.spark = spark
        self.target = spark.createDataFrame([], TARGET)
        self.registry = spark.createDataFrame([], REGISTRY)
        self.rates = spark.createDataFrame([(D, "EUR", 2.0)], "date date, currency_code string, rate double")
        self.n = 0

    def run(self, files, rejected=()):
        """files: list of (object_key, file_hash, cost)."""
        self.n += 1
        listing = self.spark.createDataFrame(
            [(k, k.split("/")[-2], k.split("/")[-1], h) for k, h, _ in files],
            "object_key string, folder string, file_name string, file_hash string")
        rows = self.spark.createDataFrame([(k, *KEY, c) for k, _, c in files if k not in rejected],
                                          "object_key string, dt date, network string, currency string, "
                                          "platform string, cost double")
        rej = self.spark.createDataFrame([(k,) for k in rejected] or [("-",)], "object_key string")
        rej = rej if rejected else rej.limit(0)
        res = apply_run(listing, self.registry, self.target, self.rates, frame_loader(rows, rej),
                        f"run{self.n}", f"2024-02-{self.n:02d} 00:00:00", "2024-01-30")
        self.target = self.spark.createDataFrame(res.target.collect(), TARGET)
        self.registry = self.spark.createDataFrame(res.registry.collect(), REGISTRY)
        return res

    def row(self):
        rows = self.target.collect()
        return [(r["cost"], r["file_name"]) for r in rows]

    def live(self):
        return sorted((r["file_name"], r["file_hash"]) for r in
                      self.registry.filter(F.col("status") == "processed").collect())


def test_lower_cost_reupload_keeps_higher_and_both_versions(spark):
    h = History(spark)
    h.run([("in/2024-01-30/a.parquet", "h1", 10.0)])
    h.run([("in/2024-01-30/a.parquet", "h2", 8.0)])
    assert h.row() == [(10.0, "a.parquet")]
    assert h.live() == [("a.parquet", "h1"), ("a.parquet", "h2")]


def test_moved_file_is_tombstoned_and_reloaded(spark):
    h = History(spark)
    h.run([("in/2024-01-29/a.parquet", "h1", 10.0)])
    h.run([("in/2024-01-30/b.parquet", "h1", 10.0)])
    assert h.row() == [(10.0, "b.parquet")]
    assert h.live() == [("b.parquet", "h1")]
    dead = [r for r in h.registry.collect() if r["status"] == "deleted"]
    assert [(r["file_name"], r["file_hash"]) for r in dead] == [("a.parquet", None)]


def test_rejected_file_retried_then_ingested(spark):
    h = History(spark)
    res = h.run([("in/2024-01-30/a.parquet", "h1", 5.0)], rejected=("in/2024-01-30/a.parquet",))
    assert [r["action"] for r in res.report.collect()] == ["rejected"]
    assert h.row() == [] and h.live() == []
    res = h.run([("in/2024-01-30/a.parquet", "h1", 5.0)])
    assert [r["action"] for r in res.report.collect()] == ["ingested"]
    assert h.row() == [(5.0, "a.parquet")]


def test_vanished_winner_does_not_restore_loser(spark):
    h = History(spark)
    h.run([("in/2024-01-30/a.parquet", "ha", 10.0), ("in/2024-01-30/b.parquet", "hb", 20.0)])
    assert h.row() == [(20.0, "b.parquet")]
    h.run([("in/2024-01-30/a.parquet", "ha", 10.0)])
    assert h.row() == []                       # A is unchanged, so it is not re-read
    assert h.live() == [("a.parquet", "ha")]


def test_same_name_in_two_folders_same_content_is_one_file(spark):
    h = History(spark)
    res = h.run([("in/2024-01-29/a.parquet", "h1", 4.0), ("in/2024-01-30/a.parquet", "h1", 4.0)])
    assert sorted(r["action"] for r in res.report.collect()) == ["ingested", "unchanged"]
    assert h.live() == [("a.parquet", "h1")]
