"""Fill-in-middle against a plain version, SQL and exact round trips."""
import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from costledger.llm import fim
from costledger.llm.fim import MARKS, fill_in_middle, restore, restored, transformed
from costledger.llm.queries import QUERIES, SQL


def plain(text, h, rate=90, spm=20):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:first], units[first:last], units[last:]))
    if not text or any(k in text for k in MARKS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def hashes(i):
    d = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    return [int(d[8 * k:8 * k + 8], 16) for k in range(4)]


def test_query_matches_sql_and_restores(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    df = QUERIES["op12_fill_in_middle"](spark, sf)
    want = con.execute(SQL["op12_fill_in_middle"])
    names = [c[0] for c in want.description]
    rows = sorted(df.select(*names).collect())
    assert [tuple(r) for r in rows] == sorted(want.fetchall())
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    assert all(r.restored_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in rows)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("part", [1, 5, 64, 1 << 20])
def test_any_text_in_any_parts(part):
    r = random.Random(part)
    signs = "ab Z9\n\0<PSM>é中😀\x7f'ÿ"
    texts = ["", "<P>", "x<S>y", "abc", "<", "P>", "<<S", "é" * 9] + [
        "".join(r.choice(signs) for _ in range(r.randrange(60))) for _ in range(800)]
    h = [np.array([r.randrange(2 ** 32) for _ in texts]) for _ in range(4)]
    got = [x.to_pylist() for x in transformed(pa.array(texts), h, 90, 20, part)]
    for k, t in enumerate(texts):
        assert tuple(g[k] for g in got) == plain(t, [int(x[k]) for x in h])
    assert restored(pa.array(got[4]), pa.array(got[1])).to_pylist() == texts


def test_frames(spark):
    rows = [(1, "one two three"), (1, "one two three"), (1, "other text, same id"), (None, "no id"), (5, None), (6, ""),
            (7, "has <M> in it"), (8, "word " * 300_000 + "é" * 1000)]
    df = spark.createDataFrame([(i, t, "f", 1, "o", "p") for i, t in rows],
                               "doc_id long, text string, form string, n int, output string, h1 string")
    out = fill_in_middle(df)
    assert out.columns == ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
    want = sorted((str(i), *plain(t or "", hashes(i))) for i, t in rows)
    assert sorted((str(r[0]), *r[1:]) for r in out.collect()) == want
    back = sorted((str(r.id), r.text) for r in restore(out).collect())
    assert back == sorted((str(i), t or "") for i, t in rows)
    assert fill_in_middle(df.limit(0)).collect() == [] and restore(out.limit(0)).collect() == []


def test_rates_and_seed(spark):
    df = spark.range(2000).selectExpr("id AS doc_id", "'some words to cut here' AS text")
    forms = [r.form for r in fill_in_middle(df).collect()]
    assert abs(forms.count("plain") / 2000 - 0.1) < 0.03 and abs(forms.count("spm") / 2000 - 0.18) < 0.03
    assert {r.form for r in fill_in_middle(df, rate=0).collect()} == {"plain"}
    assert {r.form for r in fill_in_middle(df, rate=100, spm=100).collect()} == {"spm"}
    assert fill_in_middle(df, seed="2").collect() != fill_in_middle(df).collect()


def test_long_texts_hold_one_part_of_units(monkeypatch):
    """The arrays of units never see more than about a part."""
    seen = []
    real = fim.split_units
    monkeypatch.setattr(fim, "split_units", lambda parts: seen.append(sum(map(len, parts.to_pylist()))) or real(parts))
    text = "some words, then more; " * 200_000
    h = [np.array([k]) for k in (123_456_789, 987_654_321, 5, 50)]
    got = [x.to_pylist()[0] for x in transformed(pa.array([text]), h, 90, 20)]
    assert tuple(got) == plain(text, [int(x[0]) for x in h])
    assert len(seen) <= 2 and max(seen) <= fim.PART_BYTES + 10
