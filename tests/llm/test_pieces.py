"""SentencePiece ids and texts against the library."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from costledger.llm import pieces
from costledger.llm.pieces import Codec, MergeModel, encode_pieces, stretches
from costledger.llm.queries import QUERIES

FILE = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=FILE)
CODEC = Codec(FILE)


def agree(texts):
    array = pa.array(texts, pa.string())
    ids, per = CODEC.encode(array)
    back = CODEC.decode(ids, per)
    ends = np.concatenate(([0], np.cumsum(per)))
    for k, t in enumerate(texts):
        want = LIB.encode(t)
        assert ids[ends[k]:ends[k + 1]].tolist() == want, t
        assert back[k].as_py() == LIB.decode(want), t
    CODEC.check(array, ids, per, back)


def test_query_matches_library(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op13_sentencepiece"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = LIB.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIB.decode(ids).encode()).hexdigest()


def test_odd_texts():
    agree(["", " ", "   ", "▁", " ▁a", "a ", "a  ", "<0x0A>", "<s>", "</s>", "<unk>", "\0", "\n\t\r", "�", "é", "é",
           "a" * 3000, "中文字" * 500, "😀😀", "x▁y", "ẞß", "1234567890"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list("ab  theron▁\n<>0x")), st.characters(exclude_categories=["Cs"])),
                        max_size=60), max_size=5))
def test_any_text(texts):
    agree(texts)


def test_stretches_give_the_ids_of_the_text(monkeypatch):
    monkeypatch.setattr(pieces, "STRETCH", 15)
    r = random.Random(1)
    for _ in range(300):
        t = "".join(r.choice("ab  ▁é中\n") for _ in range(r.randrange(200)))
        assert [i for s in stretches(t) for i in LIB.encode(s)] == LIB.encode(t)
        agree([t])


def test_parts_and_merges_alone():
    m = MergeModel(FILE)
    for t in ("▁the▁other", "▁zzzzqxjk", "▁中文", "▁" * 40):
        assert "".join(m.parts(t)) == t
        assert m.encode(t) == LIB.encode(t.replace("▁", " ").removeprefix(" "))


def test_equal_scores_merge_from_the_left():
    m = MergeModel.__new__(MergeModel)
    m.level = {"aa": 0, "ab": 0, "aab": 1}
    assert m.merged("aaab") == ["aa", "ab"]
    m.level = {"ab": 0, "aa": 1, "aab": 2}
    assert m.merged("aaab") == ["aa", "ab"]
    m.level = {"ab": 0, "aab": 1}
    assert m.merged("aaab") == ["a", "aab"]


def test_unknown_runs_without_byte_pieces():
    m = MergeModel.__new__(MergeModel)
    m.level, m.ids, m.neighbours, m.fallback, m.unknown = {}, {"a": 5}, set(), False, 0
    assert m.encode("xxaxa") == [0, 5, 0, 5]


def test_frames(spark):
    rows = [(1, "one two"), (1, "one two"), (None, "no id"), (3, None), (4, ""), (5, "wörter " * 50_000),
            (6, "字" * 200_000), (7, "x" * 20_000)]
    df = spark.createDataFrame([(i, t, 1, "d", "p") for i, t in rows],
                               "doc_id long, text string, ids int, decoded string, id string")
    out = encode_pieces(df, FILE)
    assert out.columns == ["id", "ids", "decoded"]
    want = sorted((str(i), LIB.encode(t or ""), LIB.decode(LIB.encode(t or ""))) for i, t in rows)
    assert sorted((str(r.id), list(r.ids), r.decoded) for r in out.collect()) == want
    assert encode_pieces(df.limit(0), FILE).collect() == []


def test_a_difference_stops_the_job(spark, monkeypatch):
    texts = pa.array(["some words here"])
    ids, per = CODEC.encode(texts)
    with pytest.raises(ValueError, match="ids differ"):
        CODEC.check(texts, np.roll(ids, 1), per, CODEC.decode(ids, per))
    with pytest.raises(ValueError, match="decoded text differs"):
        CODEC.check(texts, ids, per, pa.array(["other words here"]))
    with pytest.raises(ValueError, match="another number"):
        CODEC.check(texts, np.append(ids, 5), per + 1, CODEC.decode(ids, per))


def test_other_models_are_refused(tmp_path):
    with open(FILE, "rb") as f:
        proto = f.read()
    other = tmp_path / "unigram.model"
    other.write_bytes(proto.replace(b"\x12\x06tok_v0\x18\x02", b"\x12\x06tok_v0\x18\x01"))
    with pytest.raises(ValueError, match="merge-type"):
        MergeModel(str(other))


def test_rows_and_heap_agree():
    r = random.Random(2)
    words = ["▁" + "".join(r.choice("aabcdeno中é😀xq") for _ in range(r.randrange(1, 70))) for _ in range(400)]
    ids, per = CODEC.model.encode_words(pa.array([w.replace("▁", " ").encode() for w in words], pa.large_binary()))
    ends = np.concatenate(([0], np.cumsum(per)))
    for k, w in enumerate(words):
        assert ids[ends[k]:ends[k + 1]].tolist() == CODEC.model.encode(w)


def test_a_model_whose_words_are_no_parts(monkeypatch):
    codec = Codec(FILE)
    codec.model.by_word = False
    array = pa.array(["", "some words", "中 é"])
    ids, per = codec.encode(array)
    codec.check(array, ids, per, codec.decode(ids, per))
