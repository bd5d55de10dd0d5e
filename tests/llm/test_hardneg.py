"""Hard negatives: cover trees against plain loops and SQL."""
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from costledger.llm import hardneg
from costledger.llm.hardneg import CoverTree, hard_negatives, search
from costledger.llm.queries import QUERIES, SQL

SCHEMA = "vec_id long, label int, embedding array<double>, row string, `_ROW` int, shard string"


def brute(rows, positives=5, negatives=10, low=30, high=90, scale=256):
    """Anchors are ids divisible by 10."""
    good = [(i, lab, [int(np.floor(scale * x)) for x in v]) for i, lab, v in rows
            if None not in (i, lab, v) and all(x is not None and np.isfinite(x) for x in v)]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for n, (i, lab, v) in enumerate(good):
        if i % 10:
            continue
        scored = [(-score(v, w), j, other) for m, (j, other, w) in enumerate(good) if m != n]
        for s, j, _ in sorted(x for x in scored if x[2] == lab)[:positives]:
            fits = sorted(x for x in scored if x[2] != lab and low * -s <= 100 * -x[0] <= high * -s)[:negatives]
            out += [(i, j, r + 1, f[1], -s, -f[0]) for r, f in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r[:2], r[2], "x", 1, "y") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hard_negatives(df, "vec_id", "label", "embedding", lambda i: i % 10 == 0, **kw).collect())


@pytest.fixture
def small_trees(monkeypatch):
    monkeypatch.setattr(hardneg, "LEAF", 4)
    monkeypatch.setattr(hardneg, "CHILDREN", 5)
    monkeypatch.setattr(hardneg, "TREES", (3, 3))
    monkeypatch.setattr(hardneg, "GROUP_ROWS", 9)


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    got = sorted(tuple(r) for r in QUERIES["op11_hard_negatives"](spark, sf).collect())
    assert got and got == sorted(con.execute(SQL["op11_hard_negatives"]).fetchall())


def test_ties_nulls_repeats_and_clashing_names(spark, small_trees):
    rng = np.random.default_rng(3)
    rows = [(int(i), int(rng.integers(3)), (rng.integers(-2, 3, 4) / 4).tolist()) for i in range(120)]
    rows += [(10, 1, [0.5, 0.25, 0.0, 0.25]), (10, 1, [0.5, 0.25, 0.0, 0.25]), (20, 2, [0.5, 0.25, 0.0, 0.25])]
    rows += [(130 + k, k % 2, [0.25, 0.5, 0.25, 0.25]) for k in range(60)]  # one vector, many rows
    rows += [(None, 1, [1.0] * 4), (400, None, [1.0] * 4), (410, 1, None), (420, 1, [1.0, None, 1.0, 1.0]),
             (430, 1, [1.0, float("nan"), 1.0, 1.0]), (440, 1, [float("inf")] * 4), (450, 1, []),
             (460, 2, [0.5, 0.5]), (470, 1, [0.25] * 6)]
    got = mined(spark, rows)
    assert got == brute(rows) and len(got) > 500


def test_very_large_components_are_exact(spark, small_trees):
    rng = np.random.default_rng(4)
    rows = [(int(i), int(rng.integers(2)), rng.integers(2 ** 18, 2 ** 19, 3).astype(float).tolist()) for i in range(60)]
    assert mined(spark, rows, scale=1 << 9, high=100) == brute(rows, scale=1 << 9, high=100)


def test_empty_tables_and_no_anchor(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []
    assert mined(spark, [(10, 1, [1.0]), (2, 2, [1.0])]) == []


def test_radii_cover_and_every_point_is_in_one_leaf(monkeypatch):
    monkeypatch.setattr(hardneg, "LEAF", 8)
    rng = np.random.default_rng(5)
    points = np.concatenate((rng.integers(-9, 9, (400, 5)), np.tile([1, 2, 3, 4, 5], (100, 1))))
    tree, order = CoverTree.build(points)
    assert sorted(order) == list(range(500)) and (tree.points == points[order]).all()
    aug = np.column_stack((tree.points, np.sqrt(tree.top - (tree.points ** 2).sum(1))))

    def below(k):
        if tree.child[k, 1]:
            return [p for c in range(*tree.child[k]) for p in below(c)]
        return list(range(*tree.span[k]))

    for k in range(len(tree.centre)):
        far = np.sqrt(((aug[below(k)] - aug[tree.centre[k]]) ** 2).sum(1)).max()
        assert far <= tree.radius[k] + 1e-6
    assert sorted(below(0)) == list(range(500))


def test_nodes_outside_the_window_are_skipped():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16)) * 1000
    points = np.floor(np.concatenate([c + rng.normal(size=(300, 16)) for c in centres])).astype(np.int64)
    tree, order = CoverTree.build(points)
    seen = []
    real = hardneg.products

    def counted(p, q):
        seen.append(len(p))
        return real(p, q)

    hardneg.products = counted
    try:
        ids = np.arange(len(points))[order]
        q = tree.points[0]
        best, = search(tree, ids, ids, ids % 2, q, int(ids[0]), int(ids[0]) % 2, [(-hardneg.FAR, hardneg.FAR)], 5, True)
    finally:
        hardneg.products = real
    want = sorted((-int(points[i] @ q), i) for i in range(len(points)) if i % 2 == ids[0] % 2 and i != ids[0])[:5]
    assert [(-s, i) for s, i in zip(best.scores, best.ids)] == want
    assert sum(seen) < len(points) / 5


def test_whole_result_does_not_depend_on_the_dealing(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(int(i), int(rng.integers(4)), rng.normal(size=6).tolist()) for i in range(300)]
    plain = mined(spark, rows)
    monkeypatch.setattr(hardneg, "TREES", (1, 1))
    assert mined(spark, rows) == plain == brute(rows)


def test_hundredths(spark):
    df = spark.range(-250, 250).select("id", hardneg.hundredths(F.col("id"), 90).alias("q"))
    assert all(r.q == r.id * 90 // 100 for r in df.collect())
