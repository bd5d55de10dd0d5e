"""Exact duplicates against a brute-force version, also with colliding
fingerprints."""
import hashlib
import random
import re

import duckdb
import pytest

from costledger.llm.exactdup import OP10_SQL, exact_duplicates, fingerprinter
from costledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def norm(t):
    return re.sub("[\x20\x09-\x0D]", "", t or "")


def brute(rows):
    """{position: (keep position, size)} of (id, text) rows."""
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, k))
    return {m[3]: (min(g)[2], len(g), hashlib.sha256(n.encode()).hexdigest()) for n, g in groups.items() for m in g}


def test_query_matches_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(duckdb.sql(OP10_SQL).fetchall())
    got = sorted(tuple(r) for r in QUERIES["op10_exact_dedup"](spark, SF).collect())
    assert got == want


def test_combine_is_the_whole():
    whole, part, combine = fingerprinter(chunk=50)
    rnd = random.Random(1)
    data = rnd.randbytes(1234)
    for cut in (0, 1, 49, 777, 1234):
        a, b = data[:cut], data[cut:]
        big, pa_, _ = fingerprinter(chunk=2000)
        both = combine(pa_(a), len(a), pa_(b))
        assert whole(data) == big(data) == both[0] << 31 | both[1]


@pytest.mark.parametrize("primes", [(2_147_483_647, 2_147_483_629), (3, 2)])
def test_edges_and_collisions(spark, primes):
    """Tiny primes make most fingerprints of one length collide."""
    rnd = random.Random(2)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "\x0b\x0c\r"), (5, "a b"), (5, "a b"), (4, "ab "), (6, "a\xa0b"),
            (7, "x" * 300), (8, "x" * 299 + "y"), (9, "x" * 150 + " " + "x" * 150), (10, "É  é")]
    rows += [(100 + k, "".join(rnd.choice("ab ") for _ in range(6))) for k in range(200)]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, rid long")
    want = brute(rows)
    got = exact_duplicates(df.repartition(3, "rid"), primes=primes, chunk=100).collect()
    assert sorted((r.id or 0, r.keep_id or 0, r.group_size, r.sha256) for r in got) == \
        sorted((rows[k][0] or 0, *want[k]) for k in want)
    assert sum(r.kept for r in got) == len({norm(t) for _, t in rows})
    assert exact_duplicates(df.limit(0)).count() == 0


def test_hot_group_is_split(spark):
    """A third of all rows are copies: they are dealt over many tasks."""
    rows = [(k, "same text" if k % 3 == 0 else f"text {k}") for k in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_duplicates(df)
    assert got.where("group_size = 2000 and keep_id = 0").count() == 2000
    assert got.where("group_size = 1").count() == 4000
