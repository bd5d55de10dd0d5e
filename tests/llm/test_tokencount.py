"""Unigram token counts against the tokenizers library and a plain lattice."""
import random

import public_tokenizers
import sentencepiece
from tokenizers import models

from costledger.llm.queries import QUERIES
from costledger.llm.tokencount import MARK, Trie, token_counts, vocabulary

FILE = public_tokenizers.path("piece_bpe_32k.model")


def library():
    """The same vocabulary and scores as a unigram model of the tokenizers library."""
    m = sentencepiece.SentencePieceProcessor(model_file=FILE)
    return models.Unigram([(m.id_to_piece(k), m.get_score(k)) for k in range(m.get_piece_size())],
                          unk_id=0, byte_fallback=True)


def test_query_matches_library(spark):
    sf, lib = "/root/testdata/sf0.001", library()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op2_token_counts"](spark, sf).collect()}
    assert set(got) == set(docs)
    for i, t in docs.items():
        words = t.split()
        assert got[i].n_words == len(words)
        assert got[i].n_tokens == sum(len(lib.tokenize(MARK + w)) for w in words)


def lattice(word, scores, unknown):
    """All segmentations, kept plainly; ties go to the longest last piece."""
    best = [(0.0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            piece = word[start:end]
            step = (scores[piece], 1) if piece in scores else (
                (unknown, len(piece.encode())) if end - start == 1 else None)
            if step and (best[end] is None or best[start][0] + step[0] > best[end][0]):
                best[end] = (best[start][0] + step[0], best[start][1] + step[1])
    return best[-1][1]


def test_trie_matches_lattice():
    rnd = random.Random(7)
    scores = {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 4))): float(-rnd.randint(1, 9)) for _ in range(30)}
    scores.pop("c", None)
    trie = Trie(scores)
    for k in range(3000):
        if k == 1500:
            trie.clear()
        word = "".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 12)))
        assert trie.count(word) == trie.count_long(word) == lattice(word, scores, trie.unknown)
    assert len(trie.best) == len(trie.children) + 1


def test_edges(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \t\x0b ", 0), (4, "a  b", 0), (4, "a  b", 0), (None, "x", 0),
            (5, "\U0001F9FF" * 3, 0), (6, "word " * 50000 + "w" * 3000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = token_counts(df, FILE).collect()
    assert len(got) == len(rows)
    by = {r.id: (r.n_words, r.n_tokens) for r in got}
    assert by[1] == by[2] == by[3] == (0, 0) and by[4] == (2, 2) and by[None] == (1, 1)
    assert by[5] == (1, 1 + 3 * 4) and by[6][0] == 50001
    assert token_counts(df.limit(0), FILE).count() == 0
    assert MARK == "▁"


def test_a_page_without_a_space(spark):
    """It makes no nodes, and counts like any other word."""
    trie = Trie(vocabulary(FILE))
    page = "".join(chr(0x4E00 + k * k % 20_000) for k in range(60_000))
    nodes, lib = len(trie.best), library()
    assert trie.count_long(MARK + page[:3000]) == len(lib.tokenize(MARK + page[:3000])) == trie.count(MARK + page[:3000])
    trie.clear()
    n = trie.count_long(MARK + page)
    assert len(trie.best) == nodes
    got = token_counts(spark.createDataFrame([(1, page + " ab " + page), (2, "ab")], "doc_id long, text string"), FILE).collect()
    by = {r.id: (r.n_words, r.n_tokens) for r in got}
    assert by[1] == (3, 2 * n + by[2][1])
