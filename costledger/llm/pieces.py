"""SentencePiece encoding and decoding (operator 13) for merge-type models.

An agenda holds every pair of adjacent symbols whose join is a piece, ordered
by the piece's score, then from the left.  The best pair is merged and the
pairs with its new neighbours join the agenda, until none is left; symbols
that are no piece become the pieces of their bytes, or the unknown id.

Spaces count as U+2581, and one stands before a text.  Two characters that are
neighbours in no piece are never merged across, so a text is cut between such
pairs and each part has an agenda of its own.  In a model whose pieces hold no
U+2581 after another character (looked up when the model is loaded) words are
such parts, and each distinct word of a batch is encoded once.  The agendas of
short words are rows of a numpy table, with the level of the pair that begins
at each symbol: in every round each word merges its best pair, the leftmost
of the best, until no word has one.  Longer words have a heap.

Every Arrow batch is checked against the sentencepiece library, ids and decoded
text; a difference stops the job.  The library gets the texts in stretches of
``STRETCH`` bytes, cut before a space after another character: it puts a space
before each stretch itself, so the ids of the stretches are those of the text.

Memory: a batch holds about 1 MB of text, or one longer text (a text is one
row) as bytes and ids; what is encoded at once is a stretch, or one word if
that is longer, and of it a part.  A part costs about 60 bytes a character in
its heap, which only counts for millions of characters without a neighbour
pair that no piece has.

Models that normalise otherwise, or have user-defined pieces, are refused.
Defined results: a null or empty text has no ids and an empty decoded text;
U+2581 in a text is a space; ids repeat for repeated rows; equal scores are
merged from the left; an empty table gives no rows; other columns, whatever
their names, are ignored."""
from __future__ import annotations

from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PIECE_WORDS, map_arrow, slices, table

SPACE = "▁"
#: Characters of words whose agendas are rows of a table, by the table's width.
WIDTHS = (8, 16, 32, 64)
#: Bytes of text that the library encodes at once in the check, about.
STRETCH = 1 << 16


def fields(data: bytes):
    """(number, value) of each field of a protocol buffer message: the model's
    file format."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at:at + size]
        at += size


class MergeModel:
    """Scores of the pieces that merges can make, ids, and the pairs of
    characters that are neighbours in a piece."""

    MERGES, NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 2, 1, 2, 3, 4, 5, 6

    def __init__(self, model_file: str):
        import struct

        self.ids: dict[str, int] = {}
        scores, self.bytes, self.surface, self.unknown = [], {}, [], 0
        kinds, trainer, normal = set(), {}, {}
        with open(model_file, "rb") as f:
            proto = f.read()
        for number, value in fields(proto):
            if number == 1:
                entry = dict(fields(value))
                k, piece, kind = len(self.surface), entry[1].decode(), entry.get(3, self.NORMAL)
                kinds.add(kind)
                self.surface.append(b"" if kind == self.CONTROL else piece.replace(SPACE, " ").encode())
                if kind == self.NORMAL:
                    self.ids[piece] = k
                    scores.append((struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0, piece))
                elif kind == self.BYTE:
                    self.bytes[int(piece[3:5], 16)] = k
                    self.surface[k] = bytes([int(piece[3:5], 16)])
                elif kind == self.UNKNOWN:
                    self.unknown = k
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normal = dict(fields(value))
        self.surface[self.unknown] = trainer.get(44, " ⁇ ".encode())
        if (trainer.get(3, 1) != self.MERGES or kinds & {self.USER_DEFINED, self.UNUSED} or normal.get(2)
                or not normal.get(3, 1) or normal.get(4, 1) or not normal.get(5, 1) or trainer.get(24, 0)):
            raise ValueError("not a plain merge-type model: another type, other pieces or another normaliser")
        levels = {s: n for n, s in enumerate(sorted({s for s, _ in scores}, reverse=True))}
        self.level = {piece: levels[s] for s, piece in scores}  # 0: the best score; equal scores share one
        self.neighbours = {p[k:k + 2] for p in self.level for k in range(len(p) - 1)}
        self.by_word = not any(p[1] == SPACE != p[0] for p in self.neighbours)
        self.fallback = len(self.bytes) == 256
        self._tables()

    def symbol(self, s: str) -> int | None:
        """Number of a symbol in the tables: a piece's id; characters that are
        no piece come after all pieces."""
        if (k := self.ids.get(s)) is not None:
            return k
        return len(self.surface) + ord(s) if len(s) == 1 else None

    def _tables(self) -> None:
        """Pairs of symbols (as sorted numbers) with the piece they make and
        its level; the symbol of each character."""
        import numpy as np

        made = [(left << 32 | right, self.ids[p], at) for p, at in self.level.items() for k in range(1, len(p))
                if (left := self.symbol(p[:k])) is not None and (right := self.symbol(p[k:])) is not None]
        made.append((-1, 0, self.NONE))  # found for none
        made.sort()
        self.pairs, self.makes, self.levels = (np.array(c, np.int64) for c in zip(*made))
        self.characters = np.arange(0x110000, dtype=np.int64) + len(self.surface)
        for c, k in self.ids.items():
            if len(c) == 1:
                self.characters[ord(c)] = k

    #: Level of a pair that makes no piece.
    NONE = 1 << 30

    def pair(self, left, right):
        """(piece, level) that pairs of symbols make."""
        import numpy as np

        key = left << 32 | right
        at = np.searchsorted(self.pairs, key)
        at[at == len(self.pairs)] = 0
        at[self.pairs[at] != key] = 0
        return self.makes[at], self.levels[at]

    def merged_rows(self, symbols, size):
        """The symbols that merges leave of many words, one per row of
        ``symbols`` (``size`` of each row count): (all in a row, how many each
        has).  A row is a word's agenda: each round takes the best of it."""
        import numpy as np

        n, width = symbols.shape
        here = np.arange(width)
        live = here < size[:, None]
        piece, level = np.zeros((n, width), np.int64), np.full((n, width), self.NONE, np.int64)
        joint = live[:, 1:]
        piece[:, :-1][joint], level[:, :-1][joint] = self.pair(symbols[:, :-1][joint], symbols[:, 1:][joint])
        after, before = np.tile(here + 1, (n, 1)), np.tile(here - 1, (n, 1))
        todo = np.arange(n)
        while len(todo):
            best = level[todo].argmin(axis=1)  # the leftmost of the best
            some = level[todo, best] < self.NONE
            todo, at = todo[some], best[some]
            gone = after[todo, at]
            symbols[todo, at] = piece[todo, at]
            live[todo, gone], level[todo, gone] = False, self.NONE
            after[todo, at] = nxt = after[todo, gone]
            more = nxt < size[todo]
            row, mid, nxt = todo[more], at[more], nxt[more]
            before[row, nxt] = mid
            level[todo[~more], at[~more]] = self.NONE
            piece[row, mid], level[row, mid] = self.pair(symbols[row, mid], symbols[row, nxt])
            prior = before[todo, at]
            row, mid, prior = todo[prior >= 0], at[prior >= 0], prior[prior >= 0]
            piece[row, prior], level[row, prior] = self.pair(symbols[row, prior], symbols[row, mid])
        return symbols[live], live.sum(axis=1)

    def encode_words(self, words):
        """(ids of all words in a row, how many each has) of a large binary
        array of non-empty words, spaces as such."""
        import numpy as np

        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        begun = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        ends = begun[offsets - offsets[0]]
        size = np.diff(ends)
        points = np.frombuffer(data.tobytes().decode().replace(" ", SPACE).encode("utf-32-le"), np.uint32)
        widths = WIDTHS if self.fallback else ()  # runs of unknown characters become one id: left to the heap
        parts = []
        for low, width in zip((0, *widths), widths):
            mine = np.flatnonzero((size > low) & (size <= width))
            symbols, column = np.zeros((len(mine), width), np.int64), np.arange(width)
            inside = column < size[mine, None]
            symbols[inside] = self.characters[points[(ends[mine, None] + column)[inside]]]
            parts.append((mine, *self.spelled(*self.merged_rows(symbols, size[mine]))))
        mine = np.flatnonzero(size > (widths[-1] if widths else 0))
        found = [self.encode(words[int(k)].as_py().decode().replace(" ", SPACE)) for k in mine]
        parts.append((mine, np.fromiter((i for f in found for i in f), np.int64), np.fromiter(map(len, found), np.int64, len(found))))
        rows, ids, per = (np.concatenate(p) for p in zip(*parts))
        back = np.empty(len(words), np.int64)
        back[rows] = np.arange(len(rows))
        return gather(ids, per, back)

    def spelled(self, symbols, per):
        """Symbols (``per`` of each word) as ids: those that are no piece
        become the pieces of their bytes."""
        import numpy as np

        first = len(self.surface)
        odd = np.unique(symbols[symbols >= first])
        spelt = [[self.bytes[b] for b in chr(int(s) - first).encode()] for s in odd]
        known = np.minimum(symbols, first)
        known[symbols >= first] = first + np.searchsorted(odd, symbols[symbols >= first])
        ids = np.concatenate([np.arange(first), *spelt]).astype(np.int64)
        size = np.concatenate((np.ones(first, np.int64), np.array([len(x) for x in spelt], np.int64)))
        out, each = gather(ids, size, known)
        ends = np.concatenate(([0], np.cumsum(each)))
        return out, np.diff(ends[np.concatenate(([0], np.cumsum(per)))])

    def parts(self, text: str):
        """``text`` cut between characters that no piece has side by side."""
        start = 0
        for k in range(1, len(text)):
            if text[k - 1:k + 1] not in self.neighbours:
                yield text[start:k]
                start = k
        if text:
            yield text[start:]

    def merged(self, part: str):
        """The symbols that merges leave of ``part``."""
        from array import array

        if len(part) == 1:
            return [part]
        n, level = len(part), self.level
        names = list(dict.fromkeys(part))
        number = {c: k for k, c in enumerate(names)}
        symbol = array("i", [number[c] for c in part])  # -1: merged into one on its left
        after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        agenda = [level[p] << 32 | k for k in range(n - 1) if (p := part[k:k + 2]) in level]
        heapify(agenda)
        while agenda:
            top = heappop(agenda)
            at, best = top & 0xFFFFFFFF, top >> 32
            if symbol[at] < 0 or (right := after[at]) == n:
                continue
            joined = names[symbol[at]] + names[symbol[right]]
            if level.get(joined) != best:
                continue  # one of the two has been merged since
            if joined not in number:
                number[joined] = len(names)
                names.append(joined)
            symbol[at], symbol[right] = number[joined], -1
            after[at] = last = after[right]
            if last < n:
                before[last] = at
                if (found := level.get(joined + names[symbol[last]])) is not None:
                    heappush(agenda, found << 32 | at)
            if (first := before[at]) >= 0 and (found := level.get(names[symbol[first]] + joined)) is not None:
                heappush(agenda, found << 32 | first)
        return [names[s] for s in symbol if s >= 0]

    def encode(self, word: str) -> list[int]:
        """Ids of a text whose spaces are U+2581, without the one before it."""
        out: list[int] = []
        for part in self.parts(word):
            for s in self.merged(part):
                if (k := self.ids.get(s)) is not None:
                    out.append(k)
                elif self.fallback:
                    out.extend(self.bytes[b] for b in s.encode())
                elif not out or out[-1] != self.unknown:
                    out.append(self.unknown)
        return out


def gather(values, size, chosen):
    """(values of the chosen groups in a row, how many each has): group k is
    the ``size[k]`` values after those of the groups before it."""
    import numpy as np

    first = np.cumsum(size) - size
    per = size[chosen]
    ends = np.concatenate(([0], np.cumsum(per)))
    return values[np.repeat(first[chosen] - ends[:-1], per) + np.arange(ends[-1])], per


def words_of(texts):
    """(words as a large binary array, words of each text) of non-null texts:
    each begins with its spaces, of which the first text's first is put there.
    An empty text has none."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.replace_substring(texts, SPACE, " ")
    some = pc.greater(pc.binary_length(texts), 0)
    led = pc.if_else(some, pc.binary_join_element_wise(" ", texts, ""), "").cast(pa.large_binary())
    offsets = np.frombuffer(led.buffers()[1], np.int64)[led.offset:led.offset + len(led) + 1]
    data = np.frombuffer(led.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    start = data == 0x20
    start[1:] &= data[:-1] != 0x20
    start[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(start)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)])
    return words, np.diff(np.searchsorted(starts, offsets))


class Codec:
    """Encoder and decoder of Arrow arrays; a worker keeps one."""

    def __init__(self, model_file: str):
        import numpy as np
        import sentencepiece

        self.model = MergeModel(model_file)
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.lengths = np.array([len(s) for s in self.model.surface])
        self.data = np.frombuffer(b"".join(self.model.surface), np.uint8)

    def encode(self, texts):
        """(ids of all texts in a row, number of ids of each)."""
        import numpy as np

        if not self.model.by_word:
            found = [self.model.encode(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts.to_pylist()]
            return (np.fromiter((i for f in found for i in f), np.int64), np.fromiter(map(len, found), np.int64, len(found)))
        words, per = words_of(texts)
        coded = words.dictionary_encode()
        ids, size = self.model.encode_words(coded.dictionary)
        ids, each = gather(ids, size, coded.indices.to_numpy(zero_copy_only=False))
        ends = np.concatenate(([0], np.cumsum(each)))
        return ids, np.diff(ends[np.concatenate(([0], np.cumsum(per)))])

    def decode(self, ids, per):
        """Texts of the ids: ``per`` of them each, without the space before a
        text; bytes that are no UTF-8 become U+FFFD."""
        import numpy as np
        import pyarrow as pa

        data, size = gather(self.data, self.lengths, ids)
        ends = np.concatenate(([0], np.cumsum(size)))
        cuts = ends[np.concatenate(([0], np.cumsum(per)))]
        out = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            out.append(data[a:b].tobytes().removeprefix(b" ").decode(errors="replace"))
        return pa.array(out, pa.string())

    def check(self, texts, ids, per, decoded) -> None:
        """Compare a batch with the library, stretch by stretch."""
        import numpy as np

        ends = np.concatenate(([0], np.cumsum(per)))
        for k, (text, back) in enumerate(zip(texts.to_pylist(), decoded.to_pylist())):
            at, whole = int(ends[k]), 0
            for piece in stretches(text):
                want = self.library.encode(piece)
                if ids[at:at + len(want)].tolist() != want:
                    raise ValueError(f"ids differ from the library's from id {at - int(ends[k])} of a text on")
                said = self.library.decode(want)
                if not back.startswith(said, whole):
                    raise ValueError(f"the decoded text differs from the library's from character {whole} on")
                at, whole = at + len(want), whole + len(said) + 1  # the space between two stretches
            if at != ends[k + 1] or max(whole - 1, 0) != len(back):
                raise ValueError("the library has another number of ids or characters")


def stretches(text: str):
    """Parts of ``text`` whose ids are the text's: each but the first begins
    after a space, which the library puts back, that follows no space."""
    import re

    gap, start = re.compile(f"(?<=[^ {SPACE}])[ {SPACE}](?=.)", re.DOTALL), 0
    while len(text) - start > STRETCH and (hit := gap.search(text, start + STRETCH)):
        yield text[start:hit.start()]
        start = hit.end()
    yield text[start:]


def encode_pieces(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
                  checked: bool = True) -> DataFrame:
    """(id, ids, decoded) of every row: the ids as an array, and the text that
    they stand for; ``checked`` compares each batch with the library."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    kind = dict(src.dtypes)["id"]

    def run(batches):
        import sys
        import types

        import numpy as np
        import pyarrow as pa

        shared = sys.modules.setdefault(PIECE_WORDS, types.ModuleType(PIECE_WORDS)).__dict__
        if shared.get("file") != model_file:
            shared.update(file=model_file, codec=Codec(model_file))
        codec = shared["codec"]
        for b in slices(batches, limit=1 << 20):
            texts = b.column(1).cast(pa.string())
            ids, per = codec.encode(texts)
            decoded = codec.decode(ids, per)
            if checked:
                codec.check(texts, ids, per, decoded)
            ends = np.concatenate(([0], np.cumsum(per)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids).cast(pa.int32())), decoded],
                ["id", "ids", "decoded"])

    return map_arrow(src, run, f"id {kind}, ids array<int>, decoded string", keeps=PIECE_WORDS)


def op13_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
