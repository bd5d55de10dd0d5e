"""Hand-made edge frames (NULL/NaN costs, NULL keys, missing and zero rates,
ties, strict upsert) for the operators."""
import datetime as dt
import math

from pyspark.sql import functions as F

from costledger import operators as ops
from costledger.schemas import KEYS, TARGET

D = dt.date(2024, 1, 30)
AD = "dt date, network string, currency string, platform string, cost double, file_name string"


def ads(spark, rows):
    return spark.createDataFrame(rows, AD)


def rates(spark, rows):
    return spark.createDataFrame(rows, "date date, currency_code string, rate double")


def test_nan_cost_loses_to_a_number(spark):
    df = ads(spark, [(D, "n", "EUR", "ios", 1.0, "a"), (D, "n", "EUR", "ios", float("nan"), "b")])
    out = ops.keep_highest_cost(df).collect()
    assert len(out) == 1 and out[0]["cost"] == 1.0


def test_nan_only_key_dropped_after_conversion_and_null_in_legacy(spark):
    df = ads(spark, [(D, "n", "EUR", "ios", float("nan"), "a")])
    lk = ops.latest_rate_per_currency(rates(spark, [(D, "EUR", 2.0)]))
    assert ops.process_ad_rows(df, lk).count() == 0
    legacy = ops.process_ad_rows(df, lk, policy="legacy").collect()
    assert len(legacy) == 1 and legacy[0]["cost_usd"] is None


def test_null_platform_groups_together(spark):
    df = ads(spark, [(D, "n", "EUR", None, 2.0, "a"), (D, "n", "EUR", None, 3.0, "b")])
    out = ops.keep_highest_cost(df).collect()
    assert [r["cost"] for r in out] == [3.0]


def _target_rows(spark, df):
    return (df.withColumn("cost_usd", F.col("cost"))
              .withColumn("file_version_id", F.col("file_name"))
              .withColumn("last_processed_timestamp", F.current_timestamp())
              .select(*TARGET.fieldNames()))


def test_null_key_never_matches_in_merge(spark):
    src = _target_rows(spark, ads(spark, [(D, "n", "EUR", None, 2.0, "a")]))
    empty = spark.createDataFrame([], TARGET)
    once = ops.merge_max_cost(empty, src)
    twice = ops.merge_max_cost(once, src)
    assert twice.count() == 2


def test_null_key_matches_in_consolidation(spark):
    a = ads(spark, [(D, "n", "EUR", None, 1.0, "a")]).withColumn("cost_usd", F.col("cost"))
    b = ads(spark, [(D, "n", "EUR", None, 2.0, "b")]).withColumn("cost_usd", F.col("cost"))
    out = ops.consolidate_outer(a, b, KEYS).collect()
    assert len(out) == 1 and out[0]["cost"] == 2.0


def test_missing_or_null_currency(spark):
    df = ads(spark, [(D, "n", None, "ios", 5.0, "a"), (D, "n", "XXX", "ios", 5.0, "a")])
    lk = ops.latest_rate_per_currency(rates(spark, [(D, "EUR", 2.0)]))
    assert ops.process_ad_rows(df, lk).count() == 0
    legacy = ops.process_ad_rows(df, lk, policy="legacy").collect()
    assert len(legacy) == 2 and all(r["cost_usd"] is None for r in legacy)


def test_zero_rate(spark):
    df = ads(spark, [(D, "n", "EUR", "ios", 5.0, "a")])
    lk = ops.latest_rate_per_currency(rates(spark, [(D, "EUR", 0.0)]))
    assert ops.process_ad_rows(df, lk).collect()[0]["cost_usd"] == 0.0
    assert ops.process_ad_rows(df, lk, policy="legacy").collect()[0]["cost_usd"] is None


def test_currency_absent_on_newest_date(spark):
    df = ads(spark, [(D, "n", "EUR", "ios", 5.0, "a")])
    r = rates(spark, [(dt.date(2024, 1, 1), "EUR", 2.0), (D, "USD", 1.0)])
    assert ops.process_ad_rows(df, ops.rate_lookup(r, "latest")).collect()[0]["cost_usd"] == 10.0
    assert ops.process_ad_rows(df, ops.rate_lookup(r, "snapshot")).count() == 0


def test_duplicate_rates_same_day_take_highest(spark):
    r = rates(spark, [(D, "EUR", 1.5), (D, "EUR", 1.7), (dt.date(2024, 1, 1), "EUR", 9.0)])
    out = ops.latest_rate_per_currency(r).collect()
    assert [(x["currency_code"], x["rate"]) for x in out] == [("EUR", 1.7)]


def test_equal_cost_keeps_target(spark):
    t = _target_rows(spark, ads(spark, [(D, "n", "EUR", "ios", 5.0, "old")]))
    s = _target_rows(spark, ads(spark, [(D, "n", "EUR", "ios", 5.0, "new")]))
    out = ops.merge_max_cost(t, s, with_action=True).collect()
    assert [(r["file_name"], r["merge_action"]) for r in out] == [("old", "keep")]


def test_higher_cost_updates_lower_does_not(spark):
    t = _target_rows(spark, ads(spark, [(D, "n", "EUR", "ios", 5.0, "old"),
                                        (D, "m", "EUR", "ios", 5.0, "old")]))
    s = _target_rows(spark, ads(spark, [(D, "n", "EUR", "ios", 6.0, "new"),
                                        (D, "m", "EUR", "ios", 4.0, "new")]))
    got = {r["network"]: (r["cost"], r["merge_action"])
           for r in ops.merge_max_cost(t, s, with_action=True).collect()}
    assert got == {"n": (6.0, "update"), "m": (5.0, "keep")}


def test_nan_source_never_wins(spark):
    t = _target_rows(spark, ads(spark, [(D, "n", "EUR", "ios", 5.0, "old")]))
    s = _target_rows(spark, ads(spark, [(D, "n", "EUR", "ios", float("nan"), "new")]))
    out = ops.merge_max_cost(t, s).collect()
    assert out[0]["file_name"] == "old"


def test_fold_max_cost_ignores_nan(spark):
    df = ads(spark, [(D, "n", "EUR", "ios", float("nan"), "a"), (D, "n", "EUR", "ios", 3.0, "b")]) \
        .withColumn("cost_usd", F.col("cost") * 2)
    out = ops.fold_max_cost(df).collect()
    assert out[0]["cost"] == 3.0 and out[0]["cost_usd"] == 6.0


def test_rates_payload_parse_and_explode(spark):
    df = spark.createDataFrame([('{"rates": {"EUR": 0.9, "GBP": 0.8}}',), ('{"other": 1}',),
                                ("not json",)], "value string")
    out = ops.explode_rates(df.withColumn("m", ops.parse_rates_payload("value")), "m",
                            F.lit("2024-01-30")).collect()
    assert sorted((r["currency_code"], r["rate"]) for r in out) == [("EUR", 0.9), ("GBP", 0.8)]


def test_try_cast_counts_failures(spark):
    from costledger.functions.columns import try_cast_columns
    df = spark.createDataFrame([("1.5", "x"), (None, "2")], "a string, b string")
    out = try_cast_columns(df, {"a": "double", "b": "double"}).collect()
    assert [(r["a"], r["b"], r["cast_failures"]) for r in out] == [(1.5, None, 1), (None, 2.0, 0)]


def test_version_id_is_deterministic(spark):
    from costledger.functions import version_id
    df = spark.createDataFrame([("f.parquet", "abc")], "n string, h string")
    a = df.select(version_id("r1", "n", "h")).first()[0]
    b = df.select(version_id("r1", "n", "h")).first()[0]
    assert a == b and len(a) == 64


def test_md5_base64(spark):
    from costledger.functions import md5_base64
    out = spark.range(1).select(md5_base64(F.md5(F.lit("abc")))).first()[0]
    assert out == "kAFQmDzST7DWlj99KOF/cg=="
    assert not math.isnan(0.0)


def test_fold_files_drops_a_file_whose_top_row_is_nan(spark):
    # infinite cost at rate 0 gives NaN: that file's result for the key is dropped
    # (its lower finite row does not come back), the other file still counts
    df = ads(spark, [(D, "n", "EUR", "ios", float("inf"), "a"), (D, "n", "EUR", "ios", 1.0, "a"),
                     (D, "n", "EUR", "ios", 0.5, "b")])
    lk = ops.latest_rate_per_currency(rates(spark, [(D, "EUR", 0.0)]))
    out = ops.fold_files(ops.attach_rate(df, lk), "file_name").collect()
    assert [(r["cost"], r["cost_usd"]) for r in out] == [(0.5, 0.0)]
