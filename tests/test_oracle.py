"""Every catalog query against its DuckDB oracle on the smallest scale."""
import duckdb
import pytest

from __spark_entry__ import QUERIES, entry, oracle_sql
from scripts.check_oracle import TABLES, digest

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) >= set(QUERIES)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["dt", "network", "currency", "platform", "cost", "cost_usd",
                          "file_name", "event_id"]
    assert df.count() == 63          # FIXTURES.md: 63 deduped rows with a rate at sf0.001


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
