"""Plan regressions: the physical plans keep the properties that matter at
scale (partial limits before shuffles, broadcast rate lookups, pruned scans,
no cartesian products or Python row UDFs)."""
import contextlib
import io

import pytest

from costledger.plans.catalog import QUERIES

from .conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()




def test_flagship_plan(spark):
    df = QUERIES["flagship_ad_spend"](spark, SF_SMALL)
    p = plan(df)
    assert p.count("WindowGroupLimit") == 2          # partial + final around the shuffle
    assert "BroadcastHashJoin" in p
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    formatted = buf.getvalue()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in formatted


def test_fold_is_partially_aggregated(spark):
    p = plan(QUERIES["consolidate_max"](spark, SF_SMALL))
    assert p.count("HashAggregate") >= 2             # map-side partial + final


def test_owner_per_hash_has_no_pair_join(spark):
    p = plan(QUERIES["files_renamed"](spark, SF_SMALL))
    assert "Window" not in p and "CartesianProduct" not in p and "NestedLoop" not in p


FACT_TABLES = ("lineitem.parquet", "events.parquet", "documents.parquet", "orders.parquet")


def broadcast_subtrees(plan_text):
    """The text of every subtree under a BroadcastExchange."""
    lines = plan_text.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            indent = len(line) - len(line.lstrip(" :+-"))
            sub = []
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= indent:
                    break
                sub.append(nxt)
            out.append("\n".join(sub))
    return out


#: Reads real files: through Arrow in tasks.
OVER_FILES = {"file_ingest_end_state"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OVER_FILES))
def test_plan_scales(spark, name):
    """No cartesian product, nested-loop join or Python worker (every
    registered query stays in the JVM), and no broadcast of a subtree that
    scans a fact table."""
    p = plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "MapInPandas", "PythonMapInArrow"):
        assert bad not in p, (name, bad)
    for sub in broadcast_subtrees(p):
        for fact in FACT_TABLES:
            assert fact not in sub, (name, fact)


def test_touched_dates_prune_target_partitions(spark, scratch):
    import datetime as dt
    import re

    from costledger.plans.run import merge_touched_dates
    from costledger.schemas import TARGET
    rows = [(dt.date(2024, 1, 1 + i % 20), "n", "EUR", "ios", float(i), float(i), "f", f"v{i % 3}",
             dt.datetime(2024, 1, 1)) for i in range(200)]
    spark.createDataFrame(rows, TARGET).write.partitionBy("dt").parquet(f"{scratch}/t")
    target = spark.read.schema(TARGET).parquet(f"{scratch}/t")
    source = spark.createDataFrame([rows[0]], TARGET)
    dead = spark.createDataFrame([("none",)], "file_version_id string")
    _, hot, cold = merge_touched_dates(target, source, dead)
    # The written dates prune the partitions of the target while it runs.
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan(hot)), plan(hot)
    assert hot.count() == 10 and cold.count() == 190


def test_new_rows_are_shuffled_once(spark, scratch):
    """Without broadcasts: the rows of new files move for the dedup only, and
    the report needs none of them."""
    import datetime as dt

    from costledger.plans.run import apply_run, frame_loader
    from costledger.schemas import KEYS, REGISTRY, TARGET
    day = dt.date(2024, 1, 30)
    (spark.range(1000).selectExpr("'in/2024-01-30/a.parquet' object_key", "DATE'2024-01-30' dt", "cast(id % 50 as string) network",
                                  "'EUR' currency", "'ios' platform", "cast(id as double) cost").write.parquet(f"{scratch}/rows"))
    rows = spark.read.parquet(f"{scratch}/rows")
    listing = spark.createDataFrame([("in/2024-01-30/a.parquet", "2024-01-30", "a.parquet", "h")],
                                    "object_key string, folder string, file_name string, file_hash string")
    rates = spark.createDataFrame([(day, "EUR", 2.0)], "date date, currency_code string, rate double")
    best = ops_plan(spark, rows, rates)
    assert best.count("Exchange hashpartitioning") == 1 and best.count("WindowGroupLimit") == 2
    res = apply_run(listing, spark.createDataFrame([], REGISTRY), spark.createDataFrame([], TARGET), rates,
                    frame_loader(rows), "r", "2024-01-30 00:00:00", "2024-01-30")
    assert f"{scratch}/rows" not in plan(res.report)
    assert res.target.count() == 50 and set(KEYS) <= set(res.target.columns)


def test_dates_of_dead_versions_need_no_target(spark, scratch):
    """Known versions come from the side table, others from the target."""
    import datetime as dt

    from costledger.plans.run import dates_of_versions
    from costledger.schemas import TARGET
    days = [dt.date(2024, 1, 1 + k) for k in range(4)]
    rows = [(d, "n", "EUR", "ios", 1.0, 1.0, "f", f"v{k}", dt.datetime(2024, 1, 1)) for k, d in enumerate(days)]
    spark.createDataFrame(rows, TARGET).write.partitionBy("dt").parquet(f"{scratch}/t")
    target = spark.read.schema(TARGET).parquet(f"{scratch}/t")
    known = spark.createDataFrame([("v0", days[0]), ("v1", days[1]), ("v1", days[3])], "file_version_id string, dt date")
    dead = lambda *v: spark.createDataFrame([(x,) for x in v], "file_version_id string")
    got = dates_of_versions(target, dead("v0", "v1"), known)
    assert f"{scratch}/t" not in plan(got) and sorted(r.dt for r in got.collect()) == [days[0], days[1], days[3]]
    got = dates_of_versions(target, dead("v0", "v2"), known)
    assert sorted(r.dt for r in got.collect()) == [days[0], days[2]]
    assert [r.dt for r in dates_of_versions(target, dead("v3"), None).collect()] == [days[3]]


def ops_plan(spark, rows, rates):
    from costledger import operators as ops
    return plan(ops.process_ad_rows(rows, rates, tie_breakers=("object_key",)))
