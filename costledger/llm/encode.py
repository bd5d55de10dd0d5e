"""Token ids of whole texts, piece by piece.

The tokenizer lower-cases, drops white space, and never joins characters
across white space or between runs of letters, single digits and runs of other
signs.  So the ids of a text are those of such pieces, one after the other.
Words made only of ASCII letters, digits and signs and of the letters of
Latin-1 are cut into pieces with numpy; any other word, and any with an
apostrophe or "<", is one piece, left as it is.  Each distinct piece is encoded
by the tokenizers library once per worker (a bounded cache) and the ids of a
batch are gathered with numpy."""
from __future__ import annotations

from .common import TOKEN_PIECES

#: Pieces that a worker remembers; a full cache starts anew.
CACHE_PIECES = 1_500_000
#: Bytes of text encoded at once: distinct pieces are looked up once in them.
ENCODE_BYTES = 4 << 20


def _lower():
    """Each byte, A-Z as a-z."""
    import numpy as np

    out = np.arange(256, dtype=np.uint8)
    out[0x41:0x5B] += 32
    return out


def _classes():
    """Class of each byte: 0 white space, 1 letter, 2 digit, 3 sign, 4 other."""
    import numpy as np

    out = np.full(256, 4, np.uint8)
    for first, last, kind in ((0x21, 0x7E, 3), (0x30, 0x39, 2), (0x41, 0x5A, 1), (0x61, 0x7A, 1), (9, 13, 0)):
        out[first:last + 1] = kind
    out[0x20] = 0
    out[[ord("'"), ord("<")]] = 4
    return out


def cut(texts):
    """(pieces as a binary array, pieces of each text) of an Arrow array of
    strings without nulls."""
    import numpy as np
    import pyarrow as pa

    flat = texts.cast(pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        return pa.array([], pa.binary()), np.zeros(len(texts), np.int64)
    kind = _classes()[data]
    text = _lower()[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    tail = data[lead + 1]
    lead, tail = lead[(tail != 0x97) & (tail != 0xB7)], tail[(tail != 0x97) & (tail != 0xB7)]
    kind[lead] = kind[lead + 1] = 1
    text[lead + 1] += np.where(tail <= 0x9E, 32, 0).astype(np.uint8)
    solid = kind != 0
    first = solid.copy()  # first byte of a word
    first[1:] &= ~solid[:-1]
    at = offsets[:-1][offsets[:-1] < len(data)]
    first[at] = solid[at]
    start = np.empty_like(first)  # first byte of a piece
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= first | (kind == 2)
    start &= solid
    if (odd := np.flatnonzero(kind == 4)).size:
        word = np.cumsum(first, dtype=np.int32)
        keep = np.zeros(int(word[-1]) + 1, bool)
        keep[word[odd]] = True
        keep = keep[word]  # bytes of words that stay whole
        start &= ~keep | first
        text[keep] = data[keep]
    starts = np.flatnonzero(start)
    body = text[solid]
    places = np.cumsum(solid, dtype=np.int32)
    ends = np.append(places[starts] - 1, len(body)).astype(np.int32)
    pieces = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(body)])
    return pieces, np.diff(np.searchsorted(starts, offsets))


class PieceTable:
    """Numbers of known pieces.  Pieces of up to 16 bytes are two 64-bit words
    and a length in an open-addressing table that is probed for many pieces at
    once; longer ones are in a dictionary."""

    def __init__(self, slots: int = 1 << 12):
        import numpy as np
        self.words = np.zeros((2, slots), np.uint64)
        self.sizes = np.zeros(slots, np.uint8)
        self.numbers = np.full(slots, -1, np.int32)
        self.n, self.long = 0, {}

    def _home(self, words, sizes):
        import numpy as np
        h = (words[0] * np.uint64(0x9E3779B97F4A7C15)) ^ (words[1] + sizes.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(32)
        return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (len(self.numbers).bit_length() - 1))).astype(np.int64)

    @staticmethod
    def keys(pieces):
        """(words, lengths) of the pieces; only right for up to 16 bytes."""
        import numpy as np
        offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset:pieces.offset + len(pieces) + 1].astype(np.int64)
        data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
        data = np.append(data, np.zeros(16, np.uint8))
        sizes = np.diff(offsets)
        block = data[offsets[:-1, None] + np.arange(16)]
        block[np.arange(16) >= sizes[:, None]] = 0
        return np.ascontiguousarray(block.view("<u8").T), sizes

    def find(self, words, sizes):
        """Numbers of short pieces, -1 where unknown."""
        import numpy as np
        out = np.full(len(sizes), -1, np.int32)
        live, at = np.arange(len(sizes)), self._home(words, sizes)
        while len(live):
            got = self.numbers[at]
            same = (got >= 0) & (self.words[0, at] == words[0, live]) & (self.words[1, at] == words[1, live]) \
                & (self.sizes[at] == sizes[live])
            out[live[same]] = got[same]
            on = (got >= 0) & ~same
            live, at = live[on], (at[on] + 1) & (len(self.numbers) - 1)
        return out

    def add(self, words, sizes, numbers) -> None:
        """Short pieces that are not in the table, all different."""
        import numpy as np
        self.n += len(sizes)
        if 4 * self.n > 3 * len(self.numbers):
            old = np.flatnonzero(self.numbers >= 0)
            words = np.concatenate((self.words[:, old], words), axis=1)
            sizes = np.concatenate((self.sizes[old], sizes))
            numbers = np.concatenate((self.numbers[old], numbers))
            slots = 1 << int(2 * self.n - 1).bit_length()
            self.words, self.sizes = np.zeros((2, slots), np.uint64), np.zeros(slots, np.uint8)
            self.numbers = np.full(slots, -1, np.int32)
        live, at = np.arange(len(sizes)), self._home(words, sizes)
        while len(live):
            free = self.numbers[at] < 0
            self.numbers[at[free]] = numbers[live[free]]  # of several the last one stays
            won = free & (self.numbers[at] == numbers[live])
            self.words[:, at[won]] = words[:, live[won]]
            self.sizes[at[won]] = sizes[live[won]]
            live, at = live[~won], (at[~won] + 1) & (len(self.numbers) - 1)


def word_encoder(tokenizer_file: str):
    """A function from an Arrow string array to (ids, counts): the ids of all
    texts in a row as int32, and how many each has (null: none).  Its
    ``counted`` gives how often each id occurs instead."""
    import os
    import sys
    import types

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    shared = sys.modules.setdefault(TOKEN_PIECES, types.ModuleType(TOKEN_PIECES)).__dict__

    def reset():
        shared.update(table=PieceTable(), flat=np.empty(1 << 16, np.int32), ends=np.zeros(1 << 16, np.int32), n=0)

    if shared.get("file") != tokenizer_file:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(tokenizer_file)
        nul = tok.encode("\0", add_special_tokens=False).ids
        shared.update(file=tokenizer_file, tok=tok, nul=nul[0] if len(nul) == 1 else None)
        reset()

    def remember(ids, ends):
        """Add pieces whose ids end at ``ends`` in ``ids``."""
        n, used = shared["n"], int(shared["ends"][shared["n"]])
        for name, need in (("flat", used + len(ids)), ("ends", n + len(ends) + 1)):
            if need > len(shared[name]):
                shared[name] = np.resize(shared[name], max(need, len(shared[name]) * 3 // 2))
        shared["flat"][used:used + len(ids)] = ids
        shared["ends"][n + 1:n + 1 + len(ends)] = used + np.asarray(ends)
        shared["n"] = n + len(ends)

    def learn(pieces):
        """Number the pieces on from shared["n"], in order."""
        tok, nul = shared["tok"], shared["nul"]

        def flush(group):
            if not group:
                return
            ids = np.array(tok.encode_batch_fast([b" \0 ".join(group).decode()], add_special_tokens=False)[0].ids,
                           np.int32)
            marks = np.flatnonzero(ids == nul)
            if len(marks) != len(group) - 1:
                raise ValueError("the separator is part of a piece")
            remember(np.delete(ids, marks), np.append(marks, len(ids)) - np.arange(len(group)))

        group = []
        for p in pieces:
            if nul is None or b"\0" in p or b"<|" in p:
                flush(group)
                group, ids = [], tok.encode(p.decode(), add_special_tokens=False).ids
                remember(ids, [len(ids)])
            else:
                group.append(p)
                if len(group) == 2000:
                    flush(group)
                    group = []
        flush(group)

    def numbers_of(distinct):
        table = shared["table"]
        words, sizes = table.keys(distinct)
        short = np.flatnonzero(sizes <= 16)
        at = np.full(len(sizes), -1, np.int32)
        at[short] = table.find(words[:, short], sizes[short])
        for k in np.flatnonzero(sizes > 16):
            at[k] = table.long.get(distinct[int(k)].as_py(), -1)
        if (new := np.flatnonzero(at < 0)).size:
            first = shared["n"]
            pieces = distinct.take(pa.array(new)).to_pylist()
            learn(pieces)
            at[new] = np.arange(first, first + len(new))
            fits = sizes[new] <= 16
            table.add(words[:, new[fits]], sizes[new[fits]], at[new[fits]])
            table.long.update((pieces[k], first + int(k)) for k in np.flatnonzero(~fits))
        return at

    def entries(texts):
        """(number of each distinct piece, which of them each piece is,
        pieces of each text)."""
        pieces, per = cut(pc.fill_null(texts, ""))
        coded = pieces.dictionary_encode()
        if shared["n"] > CACHE_PIECES:
            reset()
        at = numbers_of(coded.dictionary) if len(pieces) else np.empty(0, np.int32)
        return at, coded.indices.to_numpy(zero_copy_only=False), per

    def gather(first, size):
        """The ids of pieces that begin at ``first`` and have ``size`` ids;
        where each piece's ids end."""
        total = np.zeros(len(size) + 1, np.int32)
        np.cumsum(size, out=total[1:])
        place = np.repeat(first - total[:-1], size)
        place += np.arange(total[-1], dtype=np.int32)
        return shared["flat"][place], total

    def encode(texts):
        at, entry, per = entries(texts)
        first, size = shared["ends"][at], shared["ends"][at + 1] - shared["ends"][at]
        ids, total = gather(first[entry], size[entry])
        return ids, np.diff(total[np.concatenate(([0], np.cumsum(per)))]).astype(np.int64)

    def counted(texts):
        """How often each id occurs: every distinct piece is looked at once."""
        at, entry, _ = entries(texts)
        first, size = shared["ends"][at], shared["ends"][at + 1] - shared["ends"][at]
        ids, _ = gather(first, size)
        times = np.repeat(np.bincount(entry, minlength=len(at)), size)
        return np.bincount(ids, times).astype(np.int64)  # sums far below 2^53: exact

    encode.counted = counted
    return encode
