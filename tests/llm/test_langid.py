"""Language identification: held-out accuracy, rejection and edges."""
import math
import zlib

import pyarrow as pa
import pytest

from costledger.llm import langid
from costledger.llm.decontam import flat_texts
from costledger.llm.langid import accepted, fit, identify, vectors
from costledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    want = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op3_language_id"](spark, SF).collect()
    assert len(got) == len(want)
    tested = [r for r in got if r.held_out]
    assert {r.doc_id for r in tested} == {i for i in want if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum(r.lang_pred == want[r.doc_id].lang for r in tested)
    assert right >= 0.97 * len(tested), f"{right} of {len(tested)}"
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.rejected for r in got) == 0


def test_grams_stay_inside_a_text():
    one, _ = vectors(pa.array(["Ab c"]))
    both, letters = vectors(pa.array(["Ab c", "", "x-y", "12", "Ж", "«»"]))
    assert (one[0] == both[0]).all() and letters.tolist() == [True, False, True, False, True, False]
    assert one.sum() == 5 + 4 and both[1].sum() == 0  # " ab c ": five 2-grams, four 3-grams


def test_edges_and_rejection(spark, scratch):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit(base)
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 !! 34", "x"), (4, "Привет мир, это русский текст. " * 9, "x"),
            (5, "zq xv kjq wxz qqz vvx kzx " * 20, "x"), (6, "The and of the that is", "x"), (None, "de la les des", "x"),
            (7, "der die und " * 20000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, rid string")
    got = {r.id: r for r in identify(df, model).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3
    assert all(got[k].rejected for k in (1, 2, 3, 4, 5))
    assert not got[6].rejected and got[6].lang_pred == "en" and got[None].lang_pred == "fr" and got[7].lang_pred == "de"
    none = {r.id: r for r in identify(df, None).collect()}
    assert none[6].lang_pred == "und" and not none[6].rejected and none[1].rejected
    assert identify(df.limit(0), model).count() == 0
    assert fit(base.limit(0)) is None
    (base.selectExpr("doc_id", "text", "lang", "source", "n_chars").unionByName(
        df.selectExpr("doc_id", "text", "cast(null as string) lang", "'s' source", "1L n_chars"))
     .write.parquet(f"{scratch}/d"))
    docs = spark.read.parquet(f"{scratch}/d")
    kept = accepted(docs)
    assert kept.columns == docs.columns
    assert kept.count() == base.count() + 3


def plain_counts(text):
    """Hashed n-grams of one text, sign by sign."""
    signs = [0x20]
    for b in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode():
        s = b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
        if s != 0x20 or signs[-1] != 0x20:
            signs.append(s)
    if signs[-1] != 0x20:
        signs.append(0x20)
    out = {}
    for n, salt in langid.GRAMS:
        for k in range(len(signs) - n + 1):
            gram = 0
            for s in signs[k:k + n]:
                gram = gram << 8 | s
            bucket = gram * salt >> 13 & (langid.BUCKETS - 1)
            out[bucket] = out.get(bucket, 0) + 1
    return out


def test_against_a_plain_nearest_centroid(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 4000")
    model = fit(base)
    got = {r.id: r for r in identify(base, model).collect()}
    for r in base.limit(150).collect():
        counts = plain_counts(r.text)
        v = {k: (1 + math.log(n)) * float(model["idf"][k]) for k, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        near = [sum(x * float(c[k]) for k, x in v.items()) / norm for c in model["centres"]]
        best = max(near)
        assert abs(got[r.doc_id].score - best) < 1e-4
        close = {lang for lang, x in zip(model["langs"], near, strict=True) if x > best - 1e-5}
        assert got[r.doc_id].lang_pred in close


@pytest.mark.parametrize("text", ["", "a", "...", "Ab c", "x " * 500, "é--é, Zoë  12 naïve", "日本語" * 300, " lead and trail. "])
@pytest.mark.parametrize("step", [1, 2, 7, 1 << 20])
def test_steps_of_a_long_text_count_like_the_whole(text, step):
    data, _ = flat_texts(pa.array([text]))
    want = plain_counts(text) if any(c.isalpha() for c in text) else {}
    got = langid.long_counts(data, step)
    assert {k: int(n) for k, n in enumerate(got) if n} == want
    one, _ = vectors(pa.array([text]))
    assert (one[0] == got).all()


def test_a_text_of_many_slices(monkeypatch):
    text = "Zoë said: the cat, the DOG and 12 birds... " * 50
    whole, ok = vectors(pa.array([text]))
    monkeypatch.setattr(langid, "SLICE_BYTES", 100)
    steps, found = vectors(pa.array([text]))
    assert (whole == steps).all() and ok.tolist() == found.tolist() == [True]
    assert vectors(pa.array(["1 2 " * 200]))[1].tolist() == [False]


@pytest.mark.parametrize("gone", ["de", "en", "es", "fr"])
def test_a_language_that_was_not_learned_is_rejected(spark, gone):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit(base.where(f"lang != '{gone}'"))
    got = identify(base, model).join(base.selectExpr("doc_id id", "lang"), "id").collect()
    mine = [r.rejected for r in got if r.lang == gone]
    rest = [r.rejected for r in got if r.lang != gone]
    assert sum(mine) >= 0.9 * len(mine), f"{sum(mine)} of {len(mine)}"
    assert sum(rest) <= 0.01 * len(rest)


def test_many_languages_and_a_hot_id(spark, scratch):
    """Ten thousand labels are no chain of conditions; an id on many rows is sampled like others."""
    (spark.range(10_000).selectExpr("id doc_id", "concat('text of ', id) text", "concat('l', id) lang")
     .unionByName(spark.range(6000).selectExpr("7L doc_id", "concat('the same id ', id) text", "'hot' lang"))
     .repartition(3).write.parquet(f"{scratch}/d"))
    docs = spark.read.parquet(f"{scratch}/d")
    model = fit(docs, sample=200, languages=30)
    assert len(set(model["langs"])) == 30 and "hot" in model["langs"]
    assert identify(docs, model).count() == 16_000
    assert len(set(fit(docs)["langs"])) == langid.LANGUAGES
    n = (langid.identified(docs, "place").where("lang = 'hot'")
         .where("pmod(xxhash64(doc_id, substring_index(place, '-', -1)), 1 << 30) < 200 / 6000 * (1 << 30)").count())
    assert 100 < n < 320
