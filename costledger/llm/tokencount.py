"""Token counts under a unigram vocabulary (operator 2).

A pre-token is a word with the mark of the space before it.  The distinct
pre-tokens of a worker go into one trie; the forward score of a trie node, the
best segmentation of the characters on its path, is computed once when the node
is made, from the nodes above it, so words share the work of their prefixes.
Each node also holds the number of tokens of its best segmentation: at a
word's last node, that is the word's count.

Vocabulary and scores are read from the tokenizer's file.  Of equal scores the
one with the longest last piece wins.  A character without a piece of its own
costs the least score less 10 and counts as its UTF-8 bytes.

Defined results: white space is [\\x20\\x09-\\x0D]; a null text has no tokens;
repeated rows are counted each for itself; a null id is carried; a word of more
than LONG_WORD characters (a page without a space) is scored character by
character without nodes and is not remembered; an empty table gives no rows;
other columns are ignored."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UNIGRAM_WORDS, map_arrow, slices

MARK, UNKNOWN_COST = "▁", 10.0
#: A trie of so many nodes, and a list of so many words, starts anew.
MOST_NODES, MOST_WORDS = 400_000, 800_000
#: Characters of a word up to which it has nodes in the trie.
LONG_WORD = 1000


class Trie:
    """Pre-tokens with shared forward scores."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_COST
        # Ends of pieces: a run of characters that is none ends the search for longer pieces.
        self.tails = {p[k:] for p in scores for k in range(len(p))}
        self.reach = max(map(len, scores), default=1)
        self.clear()

    def clear(self) -> None:
        self.children: dict[tuple[int, str], int] = {}
        self.best, self.tokens = [0.0], [0]

    def count(self, word: str) -> int:
        """Insert ``word``; tokens of its best segmentation."""
        children, best, tokens, scores, tails = self.children, self.best, self.tokens, self.scores, self.tails
        path = [0]
        for end, char in enumerate(word, 1):
            node = children.get((path[-1], char))
            if node is None:
                top, n = None, 0
                if char not in scores:
                    top, n = best[path[-1]] + self.unknown, tokens[path[-1]] + len(char.encode())
                start = end - 1
                while start >= 0 and (piece := word[start:end]) in tails:
                    score = scores.get(piece)
                    if score is not None and (top is None or best[path[start]] + score >= top):
                        top, n = best[path[start]] + score, tokens[path[start]] + 1
                    start -= 1
                node = children[path[-1], char] = len(best)
                best.append(top)
                tokens.append(n)
            path.append(node)
        return tokens[path[-1]]


    def count_long(self, word: str) -> int:
        """What ``count`` gives, with the scores of the last ``reach``
        characters only: no piece begins farther back."""
        scores, tails, ring = self.scores, self.tails, self.reach + 1
        best, tokens = [0.0] * ring, [0] * ring
        for end, char in enumerate(word, 1):
            top, n, before = None, 0, (end - 1) % ring
            if char not in scores:
                top, n = best[before] + self.unknown, tokens[before] + len(char.encode())
            start = end - 1
            while start >= 0 and (piece := word[start:end]) in tails:
                score, at = scores.get(piece), start % ring
                if score is not None and (top is None or best[at] + score >= top):
                    top, n = best[at] + score, tokens[at] + 1
                start -= 1
            best[end % ring], tokens[end % ring] = top, n
        return tokens[len(word) % ring]


def vocabulary(model_file: str) -> dict[str, float]:
    """Pieces of text and their scores."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return {m.id_to_piece(k): m.get_score(k) for k in range(m.get_piece_size())
            if not (m.is_control(k) or m.is_unknown(k) or m.is_byte(k) or m.is_unused(k))}


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_tokens) of every row."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    kind = dict(src.dtypes)["id"]

    def run(batches):
        import sys
        import types
        from collections import ChainMap

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        shared = sys.modules.setdefault(UNIGRAM_WORDS, types.ModuleType(UNIGRAM_WORDS)).__dict__
        if shared.get("file") != model_file:
            shared.update(file=model_file, trie=Trie(vocabulary(model_file)), counts={"": 0})
        trie, counts = shared["trie"], shared["counts"]
        for b in slices(batches):
            lists = pc.ascii_split_whitespace(b.column(1).cast(pa.large_string()))
            per = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            coded = lists.flatten().dictionary_encode()
            words = coded.dictionary.to_pylist()
            if len(counts) > MOST_WORDS:
                counts.clear()
                counts[""] = 0
            longs = {w: trie.count_long(MARK + w) for w in words if len(w) > LONG_WORD}
            for w in words:
                if w not in counts and w not in longs:
                    if len(trie.best) > MOST_NODES:
                        trie.clear()
                    counts[w] = trie.count(MARK + w)
            known = ChainMap(longs, counts) if longs else counts
            size = np.fromiter((known[w] for w in words), np.int64, len(words))
            real = np.fromiter((w != "" for w in words), np.int64, len(words))
            at = coded.indices.to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(per)))
            sums = [np.diff(np.concatenate(([0], np.cumsum(x[at])))[ends]) for x in (real, size)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(s, pa.int64()) for s in sums)],
                                             ["id", "n_words", "n_tokens"])

    return map_arrow(src, run, f"id {kind}, n_words long, n_tokens long", keeps=UNIGRAM_WORDS)


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from .common import table
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")).select(
        F.col("id").alias("doc_id"), "n_words", "n_tokens")
