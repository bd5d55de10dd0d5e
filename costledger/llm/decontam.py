"""Benchmark decontamination by suffix arrays of the training text (operator 9).

A shard is a slice of documents.  Its words become numbers, and a suffix array
sorts its suffixes.  Every test suffix (each start of a window in a benchmark
item) is binary-searched in it; the range found gives all places of the
window, which are extended word by word to the longest verbatim match.  The
array is sparse: a test suffix can only match where the first words agree, so
only those suffixes are sorted.  Words are matched by a 64-bit hash and every
match is compared byte by byte before it counts.

The benchmark is the query set; its items are dealt by their place in the
files into blocks of about BLOCK_BYTES, each against all documents.  An item of
more than PART_BYTES is cut into parts that share window - 1 words, and a
document of more than two shards is searched in parts that share window words;
matches over the ends of a document's parts are joined.  A word is never cut, so
one word of many megabytes is held whole.

Defined results: a null or wordless text has no words and is clean; a null or
wordless item has no window; a null item id is left out of the lists but its
windows hit; repeated rows are judged each for itself and repeated items once;
an item of more than PART_BYTES has all its windows, but its longest match is
counted inside a part; empty tables give no rows, or clean documents; other
columns are ignored."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import own_copies
from .common import identified, map_arrow, placed, rows_of, slices, without, written

#: Bytes of benchmark text compared at once, about, and of an item's part.
BLOCK_BYTES, PART_BYTES = 16 << 20, 1 << 20
#: What an item takes besides its text.
ROW_BYTES = 64
#: Bytes of training text in a shard, about: its arrays are some forty times that.
SHARD_BYTES = 1 << 20


def solid_bytes(data):
    """Whether each byte of a lower-cased text belongs to a word."""
    import numpy as np

    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x61:0x7B] = table[0x80:] = True
    return table[data]


def word_spans(data, offsets):
    """Words of concatenated lower-cased texts: (first byte, end, text of each
    word, 64-bit hash).  A word is a run of ASCII letters or digits and of any
    characters beyond ASCII."""
    import numpy as np

    solid = solid_bytes(data)
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = len(data) > 0 and solid[0], False
    edge[1:-1] = solid[1:] != solid[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    joined = cuts[solid[cuts] & solid[cuts - 1]] if len(data) else cuts
    bounds = np.flatnonzero(edge)
    if len(data) and solid[-1]:
        bounds = np.append(bounds, len(data))
    first, end = bounds[::2], bounds[1::2]
    if len(joined):  # a word at the end of one text and one at the start of the next
        joined = np.unique(joined)
        first, end = np.sort(np.append(first, joined)), np.sort(np.append(end, joined))
    size = end - first
    owner = np.searchsorted(offsets, first, "right") - 1
    if not len(first):
        return first, end, owner, np.empty(0, np.uint64)
    # Polynomial in the bytes, place counted within the word.
    place = np.ones(len(data), np.int32)
    place[first[1:]] = 1 - (first[1:] - first[:-1])
    place[:first[0] + 1] = 0
    place = np.cumsum(place, dtype=np.int32)
    powers = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64))
    term = np.where(solid, data.astype(np.uint64) + np.uint64(1), np.uint64(0))
    term *= powers[np.minimum(place, len(powers) - 1)]
    return first, end, owner, np.add.reduceat(term, first)


def flat_texts(column):
    """(bytes of all texts in a row, ASCII lower-cased; offsets)."""
    import numpy as np
    import pyarrow as pa

    flat = column.cast(pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    upper = (data >= 0x41) & (data <= 0x5A)
    return data + upper.astype(np.uint8) * np.uint8(32), offsets - offsets[0]


def _word_end(data, at: int, words: int) -> int:
    """Where the ``words``-th word that ends behind byte ``at`` ends."""
    import numpy as np

    span = 1 << 12
    while True:
        part = solid_bytes(data[at:at + span])
        ends = np.flatnonzero(part[:-1] & ~part[1:]) + 1
        if len(ends) >= words:
            return at + int(ends[words - 1])
        if at + span >= len(data):
            return len(data)
        span *= 4


def text_parts(data, size: int, shared: int):
    """(first byte, end of its own bytes, end) of parts of a lower-cased text.
    A part's own bytes are about ``size`` and end behind a word; ``shared``
    words more, which the next part has too, follow."""
    first = 0
    while True:
        own = _word_end(data, first + size, 1) if first + size < len(data) else len(data)
        yield first, own, _word_end(data, own, shared) if own < len(data) else own
        if own == len(data):
            return
        first = own


def compile_items(items: list[tuple[str | None, str | None]], window: int) -> dict:
    """The test suffixes of a block of items: numbered words, the start, item
    and length of each window, and what tells quickly that no window starts."""
    import numpy as np
    import pyarrow as pa

    data, offsets = flat_texts(pa.array([t or "" for _, t in items], pa.string()))
    first, end, owner, hashed = word_spans(data, offsets)
    vocabulary, word = np.unique(hashed, return_inverse=True)
    word = (word + 1).astype(np.uint32)
    counts = np.bincount(owner, minlength=len(items))
    begin = np.cumsum(counts) - counts
    starts, item, length = [], [], []
    for k, n in enumerate(counts.tolist()):
        if n:
            m = max(1, n - window + 1)
            starts.append(begin[k] + np.arange(m))
            item.append(np.full(m, k))
            length.append(np.full(m, min(n, window)))
    if not starts:
        return {"starts": np.empty(0, np.int64)}
    starts, item, length = map(np.concatenate, (starts, item, length))
    lead = int(min(4, length.min()))
    word = np.concatenate((word, np.zeros(window, np.uint32)))
    # The windows by their first words.
    gram = _gram(word, starts, lead)
    order = np.argsort(gram, kind="stable")
    grams, before = np.unique(gram[order], return_index=True)
    small = np.zeros(1 << 20, bool)
    small[(vocabulary & np.uint64(0xFFFFF)).astype(np.int64)] = True
    return {"starts": starts[order].astype(np.int32), "item": item[order].astype(np.int32),
            "length": length[order].astype(np.int32), "lead": lead, "grams": grams,
            "gram_ends": np.append(before, len(order)).astype(np.int32), "vocabulary": vocabulary, "small": small,
            "names": [i for i, _ in items], "spans": (data, first.astype(np.int32), end.astype(np.int32)), "word": word,
            "item_ends": (begin + counts).astype(np.int32)}


def _gram(word, at, n):
    """One number for the ``n`` words from each place on."""
    import numpy as np

    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + word[at + k]
    return out


def _as_keys(rows, window):
    import numpy as np
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * window}").ravel()


def search(block: dict, column, window: int):
    """Matches of a block of items in a shard (Arrow strings without nulls):
    (words of each text, text, first word, words, item, longest match, first
    word in the items) of each place of each window."""
    import numpy as np

    data, offsets = flat_texts(column)
    first, end, owner, hashed = word_spans(data, offsets)
    n_words = np.bincount(owner, minlength=len(column))
    none = np.empty(0, np.int64)
    if not len(block["starts"]) or not len(first):
        return n_words, *[none] * 6
    begin = np.cumsum(n_words) - n_words
    maybe = np.flatnonzero(block["small"][(hashed & np.uint64(0xFFFFF)).astype(np.int64)])
    place = np.minimum(np.searchsorted(block["vocabulary"], hashed[maybe]), len(block["vocabulary"]) - 1)
    known = block["vocabulary"][place] == hashed[maybe]
    word = np.zeros(len(first) + window, np.uint32)
    word[maybe[known]] = place[known] + 1
    # Suffixes whose first words begin a test suffix, inside one text.
    text_end = (begin + n_words)[owner]
    lead = block["lead"]
    ok = word[:len(first)] > 0
    for k in range(1, lead):
        ok &= word[k:len(first) + k] > 0
    at = np.flatnonzero(ok)
    at = at[at + lead <= text_end[at]]
    gram = _gram(word, at, lead)
    spot = np.minimum(np.searchsorted(block["grams"], gram), len(block["grams"]) - 1)
    known = block["grams"][spot] == gram
    at = at[known]
    if not len(at):
        return n_words, *[none] * 6
    # The windows that begin like one of these suffixes.
    begun = np.unique(spot[known])
    many = block["gram_ends"][begun + 1] - block["gram_ends"][begun]
    tests = np.repeat(block["gram_ends"][begun] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    starts, lengths = block["starts"][tests], block["length"][tests]
    rows = word[at[:, None] + np.arange(window)]
    rows[at[:, None] + np.arange(window) >= text_end[at][:, None]] = 0
    keys = _as_keys(rows, window)
    order = np.argsort(keys, kind="stable")
    suffixes, keys = at[order], keys[order]
    # A window's words as bytes that sort like the words; 0 ends it.
    rows = block["word"][starts[:, None] + np.arange(window)]
    rows[np.arange(window) >= lengths[:, None]] = 0
    low = np.searchsorted(keys, _as_keys(rows, window), "left")
    rows[np.arange(window) >= lengths[:, None]] = 0xFFFFFFFF
    high = np.searchsorted(keys, _as_keys(rows, window), "right")
    n = high - low
    query = np.repeat(np.arange(len(n)), n)
    found = suffixes[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    length, begins, item = (x[query].astype(np.int64) for x in (lengths, starts, block["item"][tests]))
    test_data, test_first, test_end = block["spans"]

    # Byte by byte, word for word: hashes only propose.
    def same(a, b):
        """Whether word a of the shard is word b of the items."""
        m = end[a] - first[a]
        out = m == test_end[b] - test_first[b]
        live = np.flatnonzero(out)
        for k in range(int(m[live].max(initial=0))):
            live = live[m[live] > k]
            out[live] &= data[first[a[live]] + k] == test_data[test_first[b[live]] + k]
        return out

    pairs = np.unique(np.stack([np.concatenate([found[length > k] + k for k in range(window)]),
                                np.concatenate([begins[length > k] + k for k in range(window)])]), axis=1) \
        if len(found) else np.empty((2, 0), np.int64)
    right = same(pairs[0], pairs[1])
    if not right.all():
        wrong = set(zip(*pairs[:, ~right].tolist(), strict=True))
        keep = np.array([all((f + k, s + k) not in wrong for k in range(m))
                         for f, s, m in zip(found.tolist(), begins.tolist(), length.tolist(), strict=True)], bool)
        found, length, begins, item = found[keep], length[keep], begins[keep], item[keep]
    longest = length.copy()
    live = np.arange(len(found))
    while len(live):
        a, b = found[live] + longest[live], begins[live] + longest[live]
        inside = (a < text_end[found[live]]) & (b < block["item_ends"][item[live]])
        live, a, b = live[inside], a[inside], b[inside]
        live = live[same(a, b)] if len(live) else live
        longest[live] += 1
    return n_words, owner[found], found - begin[owner[found]], length, item, longest, begins


def search_long(block: dict, column, window: int, size: int):
    """``search`` in one text, part by part: a part's windows are those that
    begin in its own bytes, and a match that reaches the part's end goes on
    with the one that begins the next part at the same place of the item."""
    import numpy as np
    import pyarrow as pa

    data, _ = flat_texts(column)
    before, reached, kept = 0, {}, []
    for first, own, stop in text_parts(data, size, window):
        n, _, at, length, item, longest, begins = search(block, pa.array([data[first:stop].tobytes()], pa.binary()), window)
        solid = solid_bytes(data[own:stop])
        mine = int(n[0]) - int(solid[:1].sum() + (solid[1:] & ~solid[:-1]).sum())
        earlier = np.zeros(len(at), np.int64)  # words that agree in parts before this one
        for k in np.flatnonzero(at == 0).tolist() if reached else ():
            earlier[k] = reached.get((int(item[k]), int(begins[k])), 0)
        reached = {}
        if own < len(data):
            for k in np.flatnonzero((at < mine) & (at + longest >= n[0])).tolist():
                place = int(item[k]), int(begins[k]) + mine - int(at[k])
                reached[place] = max(reached.get(place, 0), mine - int(at[k]) + int(earlier[k]))
        keep = at < mine
        kept.append([x[keep] for x in (at + before, length, item, longest + earlier, begins)])
        before += mine
    at, length, item, longest, begins = map(np.concatenate, zip(*kept, strict=True))
    return np.array([before]), np.zeros(len(at), np.int64), at, length, item, longest, begins


def item_parts(items: DataFrame, window: int, size: int) -> DataFrame:
    """``items`` (item, text), those of more than ``size`` bytes lower-cased
    and in parts that have all their windows and carry the same item."""
    def run(batches):
        import pyarrow as pa

        for b in slices(batches, limit=size):
            if b.num_rows > 1 or b.column(1).nbytes <= size:
                yield b
                continue
            data, _ = flat_texts(b.column(1))
            for first, _, stop in text_parts(data, size, window - 1):
                part = pa.array([data[first:stop].tobytes()], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0), part], ["item", "text"])

    return map_arrow(items, run, "item string, text string")


def _blocks(items: DataFrame, window: int, item_col: str, text_col: str, block_bytes: int):
    """The compiled blocks of the query set, broadcast, one after the other."""
    spark = items.sparkSession
    with own_copies(spark):
        parts = identified(written(item_parts(items.select(
            F.col(f"`{item_col}`").cast("string").alias("item"),
            F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")), window, PART_BYTES)), "place")
        # Besides its text, a row counts for what its name takes.
        size = parts.agg(F.sum(F.octet_length("text") + ROW_BYTES)).first()[0] or 0
        n_blocks = size // block_bytes + 1
        for k in range(n_blocks):
            rows = parts.where(F.pmod(F.xxhash64("place"), F.lit(n_blocks)) == k).collect()  # one block
            yield spark.sparkContext.broadcast(compile_items([(r["item"], r["text"]) for r in rows], window))


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  block_bytes: int = BLOCK_BYTES, part_bytes: int = SHARD_BYTES) -> DataFrame:
    """(rid, id, n_words, spans, items, longest) of every row of ``docs``:
    ``spans`` are the disjoint runs (first word, end) hit by a window,
    ``items`` the ids of the items with a window in the text, ``longest`` the
    most words that agree in a row.  ``rid`` tells rows apart."""
    src = rows_of(docs, id_col, text_col)
    kind = dict(src.dtypes)["id"]
    schema = f"rid string, id {kind}, n_words long, spans array<struct<first:int,end:int>>, items array<string>, longest int"
    out = None
    for block in _blocks(items, window, item_col, item_text, block_bytes):
        def run(batches, block=block):
            import numpy as np
            import pyarrow as pa

            tests = block.value
            for b in slices(batches, limit=part_bytes):
                whole = b.num_rows > 1 or b.column(2).nbytes <= 2 * part_bytes
                n_words, text, first, length, item, longest, _ = (
                    search(tests, b.column(2), window) if whole else search_long(tests, b.column(2), window, part_bytes))
                spans, names, most = [[] for _ in n_words], [[] for _ in n_words], np.zeros(len(n_words), np.int64)
                np.maximum.at(most, text, longest)
                order = np.lexsort((first, text))
                for t, f, e in zip(text[order].tolist(), first[order].tolist(), (first + length)[order].tolist(), strict=True):
                    if spans[t] and f <= spans[t][-1]["end"]:
                        spans[t][-1]["end"] = max(spans[t][-1]["end"], e)
                    else:
                        spans[t].append({"first": f, "end": e})
                if len(text):
                    for t, i in np.unique(np.stack([text, item]), axis=1).T.tolist():
                        if tests["names"][i] is not None:
                            names[t].append(tests["names"][i])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(n_words, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
                     pa.array(names, pa.list_(pa.string())), pa.array(most, pa.int32())],
                    ["rid", "id", "n_words", "spans", "items", "longest"])

        found = map_arrow(src, run, schema)
        several = out is not None
        out = found if out is None else out.unionByName(found)
    if several:  # a row per block and document; spans of blocks may overlap
        out = out.groupBy("rid").agg(
            F.first("id").alias("id"), F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.flatten(F.collect_list("items")).alias("items"), F.max("longest").alias("longest"))
    return out.withColumn("items", F.array_sort(F.array_distinct("items"))).withColumn("n_hit", F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["first"], a["end"]))).alias("n"),
                              F.greatest(a["end"], s["end"]).alias("end")),
        lambda a: a["n"].cast("long")))


def is_contaminated():
    """Some word is hit, and at least one in twenty."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminated(docs: DataFrame, items: DataFrame, window: int = 13, **names) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    docs = placed(docs)
    return without(docs, contamination(docs, items, window, **names).where(is_contaminated()))


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    from .common import table
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), is_contaminated().alias("contaminated"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, dw.n, i FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
