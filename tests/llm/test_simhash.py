"""SimHash groups against a brute-force version."""
from collections import Counter

import pytest
import xxhash

from costledger.llm.queries import QUERIES
from costledger.llm.simhash import links, near_duplicates
from costledger.llm.common import components


def brute_fp(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(fps, radius=4):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for x in range(len(ids)):
        for y in range(x):
            if bin(fps[ids[x]] ^ fps[ids[y]]).count("1") <= radius:
                a, b = sorted((find(ids[x]), find(ids[y])))
                root[b] = a
    return {i: find(i) for i in ids}


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {i: brute_fp(t) for i, t in docs.items()}
    want = brute_groups(fps)
    got = QUERIES["op1_simhash"](spark, sf).collect()
    assert len(got) == len(docs)
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {r.doc_id: r.component_id for r in got} == want
    assert max(Counter(want.values()).values()) > 1


def test_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "One two", "x"), (4, "one TWO", "x"),
            (5, "a b c d e f g " * 3000, "x"), (None, "lonely words here", "x"), (7, "É é", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = {(r.id, r.fp): r.component for r in near_duplicates(df).collect()}
    assert {k[0] for k, v in got.items() if v == 1} == {1, 2, 3}
    assert [v for k, v in got.items() if k[0] == 4] == [4]
    assert near_duplicates(df).count() == len(rows)
    assert near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [3, 50])
def test_links_tiles_and_signs(spark, tile):
    """Few bits apart, in small tiles, with fingerprints that are negative longs."""
    import random
    rnd = random.Random(5)
    fps = set()
    for _ in range(30):
        base = rnd.getrandbits(64)
        for _ in range(6):
            fps.add(base)
            for _ in range(rnd.randint(1, 6)):
                base ^= 1 << rnd.randrange(64)
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    got = {r.node: r.root for r in components(links(df, 4, tile)).collect()}
    unsigned = {f: f & (1 << 64) - 1 for f in signed}
    want = brute_groups(unsigned)
    assert {f: got.get(f, f) for f in signed} == want


def test_dense_group_is_linear(spark):
    """All pairs of a dense group are within the radius; links stay linear."""
    dense = [(1 << a) | (1 << b) for a in range(40) for b in range(a)]
    df = spark.createDataFrame([(f,) for f in dense], "fp long")
    out = links(df, 4)
    assert out.count() < 200 * len(dense)
    assert components(out).select("root").distinct().count() == 1


def test_components_path(spark):
    n = 300
    e = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(e).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}
