"""The corpus pipeline, stage by stage, against brute-force versions."""
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from costledger.llm.langid import fit, identify

from .test_decontam import brute as hits
from .test_exactdup import brute as copies
from .test_simhash import brute_fp, brute_groups
from .test_tokens import check_packing

SF = "/root/testdata/sf0.001"


def key(r):
    return (r.doc_id is None, r.doc_id or 0, r.text or "")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The test table with rows that have nulls, repeat, are long, or clash."""
    base = spark.read.parquet(f"{SF}/documents.parquet")
    one = base.orderBy("doc_id").first()
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    odd = [(None, one.text, None, None, None), (900, None, "en", "s", 0), (901, "", "en", None, 0), (902, "12 34 !!", "en", "s", 8),
           (903, one.text, "fr", "s", 1), (903, one.text, "fr", "s", 1), (904, one.text + " ", "fr", "s", 1),
           (905, passage, "en", "s", 1), (906, "\u041f\u0440\u0438\u0432\u0435\u0442 \u043c\u0438\u0440 " * 50, None, "s", 1),
           (907, "The and of the that is " * 4000, "en", "s", 1), (None, "of that is the and in on re", "en", "s", 1),
           (None, "of that is the and in on re er", "en", "s", 1)]
    out = str(tmp_path_factory.mktemp("pipeline"))
    more = spark.createDataFrame(odd, base.schema)
    for name in ("_rid", "rid", "_place"):
        base, more = base.selectExpr("*", f"doc_id AS {name}"), more.selectExpr("*", f"doc_id AS {name}")
    base.unionByName(more).repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages_match_brute_force(spark, folder, scratch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    judged = identify(docs, fit(docs)).collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        rows = sorted(docs.collect(), key=key)
        got = stage(spark, docs, folder)
        if name != "packing":
            assert got.columns == docs.columns, name
        got.write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
        left = sorted(docs.collect(), key=key) if name != "packing" else docs.collect()
        if name == "language_id":
            gone = [r.id for r in judged if r.rejected]
            assert set(gone) >= {900, 901, 902, 906} and 907 not in gone
            assert len(left) == len(rows) - len(gone)
        elif name == "exact_dedup":
            want = copies([(r.doc_id, r.text) for r in rows])
            keep = {place for place, _, _ in want.values()}
            assert len(left) == len({w[2] for w in want.values()})
            assert sorted(str(r.doc_id) for r in left) == sorted(str(rows[k].doc_id) for k in _kept(rows))
        elif name == "simhash_near_dedup":
            fps = {k: brute_fp(r.text) for k, r in enumerate(rows)}
            groups = brute_groups(fps)
            assert [key(r) for r in left] == [key(rows[k]) for k in sorted(set(groups.values()))]
        elif name == "decontamination":
            keep = [r for r in rows if not (lambda n, h: h > 0 and 20 * h >= n)(*hits(r.text, items)[:2])]
            assert [key(r) for r in left] == [key(r) for r in keep]
            assert len(keep) < len(rows)
        else:
            check_packing(left, [tok.encode(r.text, add_special_tokens=False).ids for r in rows], 0, 2048)


def _kept(rows):
    from .test_exactdup import norm
    best = {}
    for k, r in enumerate(rows):
        rank = (-len(r.text or ""), r.doc_id is None, r.doc_id or 0, k)
        best[norm(r.text)] = min(best.get(norm(r.text), rank), rank)
    return [b[3] for b in best.values()]


def test_run_and_empty_table(spark, folder, scratch):
    assert corpus_pipeline.run(spark, folder).count() > 50
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{scratch}/e/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{scratch}/e/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{scratch}/e").count() == 0
