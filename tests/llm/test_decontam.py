"""Decontamination against SQL and a brute-force version."""
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from costledger.llm.decontam import OP9_SQL, contamination, decontaminated, is_contaminated
from costledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def words(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(text, items, n=13):
    w, hit, names, longest = words(text), set(), set(), 0
    for name, t in items:
        v = words(t)
        size = min(n, len(v))
        for s in range(max(1, len(v) - n + 1)) if v else ():
            for i in range(len(w) - size + 1):
                if w[i:i + size] == v[s:s + size]:
                    hit |= set(range(i, i + size))
                    names.add(str(name))
                    m = size
                    while i + m < len(w) and s + m < len(v) and w[i + m] == v[s + m]:
                        m += 1
                    longest = max(longest, m)
    return len(w), len(hit), sorted(names), longest


def test_query_matches_sql(spark):
    for t in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = sorted(duckdb.sql(OP9_SQL).fetchall())
    got = sorted(tuple(r) for r in QUERIES["op9_decontamination"](spark, SF).collect())
    assert got == want
    assert sum(r[5] for r in got) > 0


@pytest.mark.parametrize("block_bytes,part_bytes", [(400, 1 << 20), (1 << 20, 20)])
def test_small_alphabet(spark, block_bytes, part_bytes):
    """Few words, so many overlapping windows, items shorter than a window, and
    texts that end and begin with words."""
    rnd = random.Random(4)
    text = lambda n: " ".join(rnd.choice(["a", "B", "cé", "日本", "d-e"]) for _ in range(n))
    items = [(k, text(rnd.randint(0, 9))) for k in range(12)] + [(3, None), (50, ""), (51, "!!"), (52, "a")]
    docs = [(k, text(rnd.randint(0, 30)), "x") for k in range(60)]
    docs += [(60, None, "x"), (61, "", "x"), (62, "...", "x"), (5, docs[5][1], "x"), (None, text(9), "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, items string").repartition(3)
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, n_words string")
    got = contamination(df, bench, window=4, block_bytes=block_bytes, part_bytes=part_bytes).collect()
    want = {}
    for i, t, _ in docs:
        want.setdefault(i, brute(t, items, 4))
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_hit, r["items"], r.longest) == want[r.id], r


def test_hashes_only_propose(spark, monkeypatch):
    """With a hash that takes every word for the same one, nothing false is found."""
    import numpy as np

    from costledger.llm import decontam
    spans = decontam.word_spans

    def blind(data, offsets):
        first, end, owner, h = spans(data, offsets)
        return first, end, owner, h % np.uint64(3)
    monkeypatch.setattr(decontam, "word_spans", blind)
    rnd = random.Random(9)
    items = [(k, " ".join(rnd.choice("abcdefgh") for _ in range(6))) for k in range(6)]
    docs = [" ".join(rnd.choice("abcdefgh") for _ in range(200)) for _ in range(5)] + [items[2][1] + " x " + items[4][1]]
    import pyarrow as pa
    block = decontam.compile_items([(str(i), t) for i, t in items], 3)
    n, text, first, length, item, longest, _ = decontam.search(block, pa.array(docs), 3)
    got = {t: set() for t in range(len(docs))}
    names = {t: set() for t in range(len(docs))}
    for t, f, m, i in zip(text.tolist(), first.tolist(), length.tolist(), item.tolist(), strict=True):
        got[t] |= set(range(f, f + m))
        names[t].add(str(i))
    for t, d in enumerate(docs):
        want = brute(d, items, 3)
        assert (len(got[t]), sorted(names[t])) == want[1:3]


@pytest.mark.parametrize("size", [1, 7, 30, 200])
def test_long_texts_in_parts(size):
    """Parts of any size find what one search finds; matches over several parts are joined."""
    import numpy as np
    import pyarrow as pa

    from costledger.llm import decontam
    rnd = random.Random(size)
    item = " ".join(rnd.choice("abc") for _ in range(60))
    items = [("x", item), ("y", "b a"), ("z", "Äb c b a c"), ("x", item)]
    text = f"..A b {item} ÄB c b a c,{item} " + " ".join(rnd.choice("abc") for _ in range(300)) + " " + item
    block = decontam.compile_items(items, 4)
    whole = decontam.search(block, pa.array([text]), 4)
    parts = decontam.search_long(block, pa.array([text]), 4, size)
    assert whole[0].tolist() == parts[0].tolist()

    def found(m):
        return sorted(zip(*(np.asarray(x).tolist() for x in (m[2], m[3], m[4], m[6])), strict=True))
    assert found(whole) == found(parts)
    assert whole[5].max() == parts[5].max() >= 60


def test_items_without_ids_are_dealt_over_blocks(spark, scratch):
    """Null and equal item ids share no block, and a long item is cut; no window is lost."""
    from costledger.llm import decontam
    names = [None] * 700 + ["same"] * 300
    rows = [(n, " ".join(f"w{k}x{j}" for j in range(14))) for k, n in enumerate(names)]
    spark.createDataFrame(rows, "item_id string, text string").write.parquet(f"{scratch}/b")
    bench = spark.read.parquet(f"{scratch}/b")
    blocks = [b.value for b in decontam._blocks(bench, 13, "item_id", "text", 16 << 10)]
    sizes = [len(b["names"]) for b in blocks]
    assert sum(sizes) == 1000 and len(sizes) > 5 and max(sizes) < 2.5 * 1000 / len(sizes)
    long = " ".join(f"v{j}" for j in range(400))
    parts = [r["text"] for r in decontam.item_parts(
        spark.createDataFrame([(None, long), (None, "a b")], "item string, text string").coalesce(1), 13, 200).collect()]
    assert len(parts) > 8 and max(map(len, parts)) < 300
    windows = {tuple(words(long)[k:k + 13]) for k in range(388)}
    assert windows == {tuple(words(t)[k:k + 13]) for t in parts for k in range(len(words(t)) - 12)}


def test_empty_tables_and_removal(spark, scratch):
    spark.read.parquet(f"{SF}/documents.parquet").write.parquet(f"{scratch}/d")
    docs, bench = spark.read.parquet(f"{scratch}/d"), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert contamination(docs.limit(0), bench).count() == 0
    assert contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    bad = [r.id for r in contamination(docs, bench).where(is_contaminated()).collect()]
    kept = decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - len(bad)
    assert kept.where(F.col("doc_id").isin(bad)).count() == 0
