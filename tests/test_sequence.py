"""lag_in_order against pandas, with a hot group spread over many partitions."""
import random

import pandas as pd

from costledger.operators.sequence import lag_in_order


def test_lag_in_order_matches_pandas(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else f"g{rng.randint(0, 300)}"
        rows.append((g, f"k{i:05d}", rng.choice(["a", "b", "c"])))
    pdf = pd.DataFrame(rows, columns=["g", "o", "v"]).sort_values(["g", "o"])
    pdf["want"] = pdf.groupby("g")["v"].shift(1)
    df = spark.createDataFrame(rows, "g string, o string, v string")
    for parts in (1, 7, 64):                 # 64 partitions: some empty, the hot group spans many
        got = lag_in_order(df, "g", "o", "v", "prev", partitions=parts).toPandas()
        merged = pdf.merge(got, on=["g", "o", "v"])
        assert len(merged) == len(pdf)
        assert (merged["want"].fillna("<none>") == merged["prev"].fillna("<none>")).all(), parts


def test_rank_in_order_matches_pandas(spark):
    from costledger.operators import rank_by_cost
    rng = random.Random(9)
    rows = [(i, float(rng.choice([1.0, 2.0, 3.0, float("nan")])) if i % 50 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "event_id long, cost double")
    got = rank_by_cost(df, "r", "cost", ("event_id",)).toPandas().set_index("event_id")["r"]
    pdf = pd.DataFrame(rows, columns=["event_id", "cost"])
    pdf["c"] = pdf["cost"].where(pdf["cost"].notna(), None)
    order = pdf.assign(null=pdf["c"].isna()).sort_values(["null", "c", "event_id"],
                                                       ascending=[True, False, True])
    want = pd.Series(range(1, len(order) + 1), index=order["event_id"].values)
    assert (got.sort_index() == want.sort_index()).all()
