"""Encoding by words, token files and packing against plain versions."""
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from costledger.llm.encode import word_encoder
from costledger.llm.packing import best_fit, packed_digests, pieces, plan
from costledger.llm.queries import QUERIES
from costledger.llm.tokenfile import code_lengths, decoder, read_tokens, write_tokens

FILE = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
ODD = ["", " ", None, "don't  can't\x0b'LL", "a\u0301b \u0301x", "x<|endoftext|>y <|startoftext|>", "a\0b \0 c",
       "\u03a3\u03b1\u03c2 \u039f\u0394\u039f\u03a3", "\x85a\x1cb", "\ufb01 \u00bd \ud55c\uae00", "<| endoftext|>", "word " * 9000]


def plain(text):
    return Tokenizer.from_file(FILE).encode(text, add_special_tokens=False).ids if text else []


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def docs(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tok = Tokenizer.from_file(FILE)
    return {i: tok.encode(t, add_special_tokens=False).ids for i, t in rows.items()}


def test_words_encode_like_whole_texts():
    ids, n = word_encoder(FILE)(pa.array(ODD))
    want = [plain(t) for t in ODD]
    assert n.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_op7_matches_plain_encoding(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op7_token_file"](spark, SF).collect()}
    start = 0
    for i in sorted(docs):
        ids = [*docs[i], 1]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    assert len(got) == len(docs)


def test_token_file_round_trip_edges(spark, scratch):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "no id", "x"), (3, "again", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, file string").repartition(4)
    write_tokens(df, f"{scratch}/t", FILE, file_ids=2000)
    got = read_tokens(spark, f"{scratch}/t").collect()
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: -1 if i is None else i)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == \
        Counter((i, (*plain(t), 1)) for i, t, _ in rows)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    write_tokens(df.limit(0), f"{scratch}/none", FILE)
    assert read_tokens(spark, f"{scratch}/none").count() == 0


def test_code_lengths_are_optimal_and_limited():
    import heapq
    rnd = np.random.default_rng(3)
    counts = rnd.integers(1, 1000, 200)
    heap = [(int(c), k, [k]) for k, c in enumerate(counts)]
    depth = np.zeros(200, int)
    heapq.heapify(heap)
    k = 200
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for x in a[2] + b[2]:
            depth[x] += 1
        heapq.heappush(heap, (a[0] + b[0], k, a[2] + b[2]))
        k += 1
    assert (code_lengths(counts) * counts).sum() == (depth * counts).sum()
    steep = code_lengths(np.array([1 << k for k in range(40)]))
    assert steep.max() <= 16 and abs(sum(2.0 ** -steep) - 1) < 1e-9
    assert code_lengths(np.array([5])).tolist() == [1]


def test_blocks_decode_alone(spark, scratch):
    write_tokens(spark.read.parquet(f"{SF}/documents.parquet"), f"{scratch}/t", FILE)
    book = [(r.id, r.length) for r in spark.read.parquet(f"{scratch}/t/codebook").collect()]
    rows = spark.read.parquet(f"{scratch}/t/blocks").collect()
    decode = decoder(book)
    one = rows[len(rows) // 2]
    ids = decode([(bytes(one.bits), bytes(one.checkpoints), sum(one.tokens))])
    assert len(ids) == sum(one.tokens) and (ids == 1).sum() >= len(one.docs)


def check_packing(got, want, end_id, capacity):
    """``want``: ids of each document, in any order of documents."""
    whole = Counter()
    for ids in want:
        ids = [*ids, end_id]
        for k in range(0, len(ids), capacity):
            whole[(k // capacity, k, len(ids[k:k + capacity]), crc(ids[k:k + capacity]))] += 1
    assert Counter((r.piece, r.start, r.length, r.ids_crc32) for r in got) == whole
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by)


def test_op5_packs_every_piece(spark, docs):
    got = QUERIES["op5_packing"](spark, SF).collect()
    n = check_packing(got, docs.values(), 0, 2048)
    assert n <= 1.02 * sum(len(d) + 1 for d in docs.values()) / 2048 + 1


def test_packing_edges(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "no id", "x"), (3, "again", "x"), (3, "again", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(3)
    check_packing(packed_digests(df, FILE, 64).collect(), [plain(t) for _, t, _ in rows], 0, 64)
    assert packed_digests(df.limit(0), FILE, 64).count() == 0
    assert pieces(df, FILE, 64).where("length > 64 or length < 1").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_exact_and_close_to_the_bound(seed):
    rnd = np.random.default_rng(seed)
    h = Counter(rnd.integers(1, 257, 500 * 4 ** seed).tolist())
    made = plan(dict(h), 256)
    again = Counter()
    for config, times in made:
        assert sum(config) <= 256 and times > 0
        for n in config:
            again[n] += times
    assert again == h
    assert sum(t for _, t in made) <= 1.05 * max(sum(n * c for n, c in h.items()) / 256, 1) + 2
    assert sum(t for _, t in best_fit({n: c * 10 ** 6 for n, c in h.items()}, 256)) > 0


def test_pieces_without_ids_are_spread(spark, scratch):
    """Pieces of one length and null ids are numbered in several tasks, AQE or not."""
    from pyspark.sql import functions as F

    from costledger.llm.packing import pack
    spark.range(0, 40_000, 1, 4).selectExpr(
        "cast(null as long) id", "0 piece", "0L start", "if(id < 39000, 700L, 3L) length", "id _rank").write.parquet(f"{scratch}/p")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = pack(spark.read.parquet(f"{scratch}/p"), 40_000).withColumn("task", F.spark_partition_id()).toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(got) == 40_000 and got["_rank"].nunique() == 40_000
    assert got["task"].nunique() > 1 and got.groupby("task").size().max() < 36_000
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert (s["offset"].to_numpy() == np.cumsum(s["length"]) - s["length"]).all() and s["length"].sum() <= 2048
    assert got["sequence_id"].nunique() == 19_500
