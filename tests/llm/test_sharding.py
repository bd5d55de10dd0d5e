"""Shards by bytes: balance, order, copies, edges."""
import zlib
from collections import defaultdict

import pytest

from costledger.llm.queries import QUERIES
from costledger.llm.sharding import sharded, write_shards

SF = "/root/testdata/sf0.01"


def check_slots(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op6_balances_bytes(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op6_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    check_slots(got)
    size, sizes = defaultdict(int), {}
    for r in got:
        t = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(t) + 8, zlib.crc32(t), "bytes", None)
        size[r.shard] += r.size
        sizes[r.doc_id] = r.size
    ideal = sum(sizes.values()) / 24
    assert set(size) == set(range(24))
    assert max(abs(s - ideal) for s in size.values()) <= max(sizes.values())


@pytest.mark.parametrize("shards", [1, 4])
def test_hot_group_and_edges(spark, scratch, shards):
    """A third of the rows are one text, which must be cut; small groups stay whole."""
    rows = [(1, "hot text " * 5, "x", 0, 1)] * 700 + [(k, f"text {k // 2}", "y", 0, 1) for k in range(1400)]
    rows += [(None, None, "z", 0, 1), (5, "", "z", 0, 1), (6, "long " * 50, "z", 0, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int, h int").repartition(5)
    df.write.parquet(f"{scratch}/d")
    docs = spark.read.parquet(f"{scratch}/d")
    out = sharded(docs, shards)
    assert out.columns == ["doc_id", "text", "shard_", "slot_", "h", "shard", "slot"]
    got = out.collect()
    assert len(got) == len(rows)
    check_slots(got)
    size, places = defaultdict(int), defaultdict(set)
    for r in got:
        size[r.shard] += len(r.text or "") + 8
        places[r.text or ""].add(r.shard)
    ideal = sum(size.values()) / shards
    assert max(abs(s - ideal) for s in size.values()) <= 300 and len(size) == shards
    assert all(len(p) == 1 for t, p in places.items() if not t.startswith("hot"))
    write_shards(docs, f"{scratch}/s", shards)
    assert spark.read.parquet(f"{scratch}/s").count() == len(rows)
    assert sharded(docs.limit(0), shards).count() == 0


def test_fewer_rows_than_shards(spark, scratch):
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "doc_id long, text string").write.parquet(f"{scratch}/d")
    got = sharded(spark.read.parquet(f"{scratch}/d"), 24).collect()
    assert len(got) == 3 and all(0 <= r.shard < 24 for r in got)
    check_slots(got)


def test_columns_with_the_new_names(spark, scratch):
    rows = [(k, f"t{k}", k, -k, 2 * k, 0) for k in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string, shard int, shard_ int, Slot int, _rid int").write.parquet(f"{scratch}/d")
    out = sharded(spark.read.parquet(f"{scratch}/d"), 3)
    assert out.columns == ["doc_id", "text", "shard__", "shard_", "Slot_", "_rid_", "shard", "slot"]
    assert all((r.shard__, r.shard_, r.Slot_) == (r.doc_id, -r.doc_id, 2 * r.doc_id) for r in out.collect())
