"""Fill-in-middle transformation (operator 12), a pyarrow.compute pipeline.

A text is cut into units, runs of ASCII letters or single other characters.
Per batch: units are split into list arrays, flattened with the index of their
text, numbered within it, filtered by role (prefix, middle, suffix), rebuilt
into lists and joined with ``binary_join``; the pieces then go between the
marks.  Where a text is cut and which form it takes comes from a SHA-256 of the
id, so a retried task gives the same output.

Texts beyond ``PART_BYTES`` are cut into parts at a unit's start: units are
counted first, then each part goes through the pipeline with the number of
units before it, and the pieces of its parts are joined.  So the arrays of
units, which are larger than the text, are bounded by a part; the whole text
and its output, one row each, are held.  A run of letters is never cut: one of
many MB is one unit.

Defined results: a null or empty text is plain and empty with no units; a text
that contains a mark stays as it is (plain); a null id is hashed as an empty
string; rows of one id are transformed each for itself, alike if their texts
are; an empty table gives no rows; other columns, whatever their names, are
ignored."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices, table

MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Bytes of text that are units at once.
PART_BYTES = 1 << 20
UNIT = "[A-Za-z]+|[^A-Za-z]"
#: A unit in bytes: letters, or one character of any length.  The mark after
#: each, 0xFF, is no byte of UTF-8.
UNIT_BYTES, AFTER = rb"([A-Za-z]+|[\x00-\x40\x5B-\x60\x7B-\x7F]|[\xC0-\xFE][\x80-\xBF]*)", b"\xff"


def split_units(parts):
    """The units of each part (binary array) as a list array."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    marked = pc.replace_substring_regex(parts, pattern=UNIT_BYTES, replacement=rb"\1" + AFTER)
    lists = pc.split_pattern(marked, pattern=AFTER)  # the last entry, after the last mark, is empty
    flat, parent = lists.flatten(), pc.list_parent_indices(lists)
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    real = np.ones(len(flat), bool)
    real[np.cumsum(size) - 1] = False
    return flat.filter(pa.array(real)), parent.filter(pa.array(real)), size - 1


def role_pieces(parts, before, first, last):
    """(prefix, middle, suffix) of each part as binary arrays: units whose
    number, ``before`` and up, is below ``first``, below ``last``, the rest."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    flat, parent, size = split_units(parts)
    owner = parent.to_numpy(zero_copy_only=False)
    starts = np.cumsum(size) - size
    ordinal = np.arange(len(flat)) - (starts - before)[owner]
    role = (ordinal >= first[owner]).astype(np.int8) + (ordinal >= last[owner])
    out = []
    for k in range(3):
        chosen = pc.equal(pa.array(role), k)
        units, owners = flat.filter(chosen), owner[role == k]
        ends = np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=len(parts)))))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), units)
        out.append(pc.binary_join(lists, b""))
    return out


def cut_parts(data: bytes, limit: int):
    """``data`` in parts of about ``limit`` bytes, each begun by a character
    that is no letter: such a one always begins a unit."""
    import re

    start, other = 0, re.compile(rb"[^A-Za-z\x80-\xBF]")
    while len(data) - start > limit:
        hit = other.search(data, start + limit)
        if not hit:
            break
        yield data[start:hit.start()]
        start = hit.start()
    yield data[start:]


def long_pieces(data: bytes, first: int, last: int, sizes, parts):
    """(prefix, middle, suffix) of one text given as ``parts`` with the units
    in each."""
    import numpy as np
    import pyarrow as pa

    found: tuple[list, list, list] = ([], [], [])
    before = 0
    for part, n in zip(parts, sizes):
        if before + n <= first or before >= last or (before >= first and before + n <= last):  # one role
            found[int(before >= first) + int(before >= last)].append(part)
        else:
            got = role_pieces(pa.array([part], pa.binary()), np.array([before]), np.array([first]), np.array([last]))
            for k in range(3):
                found[k].append(got[k][0].as_py())
        before += n
    return [b"".join(f) for f in found]


def transformed(texts, h, rate: int, spm: int, part_bytes: int = PART_BYTES):
    """(n, form, prefix_chars, middle_chars, output) of an Arrow array of
    texts; ``h`` holds four numbers per text."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    raw = texts.cast(pa.binary())
    bytes_in = pc.binary_length(raw).to_numpy(zero_copy_only=False)
    big = {int(k): list(cut_parts(raw[int(k)].as_py(), part_bytes)) for k in np.flatnonzero(bytes_in > part_bytes)}
    counts = {k: pc.count_substring_regex(pa.array(p, pa.binary()).cast(pa.string()), pattern=UNIT).to_pylist()
              for k, p in big.items()}
    small = np.flatnonzero(bytes_in <= part_bytes)
    n = np.zeros(len(texts), np.int64)
    n[small] = pc.count_substring_regex(texts.take(pa.array(small)), pattern=UNIT).to_numpy(zero_copy_only=False)
    for k, c in counts.items():
        n[k] = sum(c)
    a, b = h[0] % (n + 1), h[1] % (n + 1)
    first, last = np.minimum(a, b), np.maximum(a, b)
    marked = np.zeros(len(texts), bool)
    for m in MARKS:
        marked |= pc.match_substring(texts, m).to_numpy(zero_copy_only=False)
    plain = (bytes_in == 0) | marked | (h[2] % 100 >= rate)
    swapped = h[3] % 100 < spm

    pieces: list[list] = [[b""] * len(texts) for _ in range(3)]
    todo = small[~plain[small]]
    for rows in np.split(todo, np.flatnonzero(np.diff(np.cumsum(bytes_in[todo]) // part_bytes)) + 1):
        if len(rows):
            got = role_pieces(raw.take(pa.array(rows)), np.zeros(len(rows), np.int64), first[rows], last[rows])
            for k in range(3):
                for row, piece in zip(rows.tolist(), got[k].to_pylist()):
                    pieces[k][row] = piece
    for k, parts in big.items():
        if not plain[k]:
            for role, piece in enumerate(long_pieces(b"".join(parts), int(first[k]), int(last[k]), counts[k], parts)):
                pieces[role][k] = piece
    prefix, middle, suffix = (pa.array(p, pa.binary()).cast(pa.string()) for p in pieces)
    form = pc.if_else(pa.array(plain), PLAIN, pc.if_else(pa.array(swapped), SPM, PSM))
    p, s, m = MARKS
    output = pc.case_when(
        pc.make_struct(pc.equal(form, PLAIN), pc.equal(form, PSM)), texts,
        pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, ""),
        pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, ""))
    nothing = pa.scalar(None, pa.int64())
    sizes = [pc.if_else(pa.array(plain), nothing, pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
    return [pa.array(n), form, *sizes, output]


def restored(output, form):
    """The texts that outputs of a form were made of, as an Arrow array."""
    import pyarrow as pa
    import pyarrow.compute as pc

    was_plain = pc.equal(form, PLAIN)
    fields = pc.split_pattern_regex(output.filter(pc.invert(was_plain)), pattern="|".join(MARKS))
    spm = pc.equal(form.filter(pc.invert(was_plain)), SPM)
    one, two, middle = (pc.list_element(fields, k) for k in (1, 2, 3))
    whole = pc.binary_join_element_wise(pc.if_else(spm, two, one), middle, pc.if_else(spm, one, two), "")
    if isinstance(whole, pa.ChunkedArray):
        whole = whole.combine_chunks()
    return pc.replace_with_mask(output, pc.invert(was_plain), whole)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = 90, spm: int = 20,
                   seed: str = "1") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row: ``rate``
    of a hundred texts are transformed, ``spm`` of a hundred of them with the
    suffix first; ``seed`` starts the hashed string."""
    ident = F.col(f"`{id_col}`")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    src = docs.select(ident.alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
                      *[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}")
                        for k in range(4)])
    kind = dict(src.dtypes)["id"]

    def run(batches):
        import pyarrow as pa

        for b in slices(batches):
            h = [b.column(2 + k).to_numpy(zero_copy_only=False) for k in range(4)]
            out = transformed(b.column(1).cast(pa.string()), h, rate, spm)
            yield pa.RecordBatch.from_arrays([b.column(0), *out], ["id", *NAMES])

    return map_arrow(src, run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


NAMES = ["n", "form", "prefix_chars", "middle_chars", "output"]


def restore(frame: DataFrame) -> DataFrame:
    """``frame`` (id, ..., form, output) with the texts that the outputs were
    made of as ``text`` in the place of ``output``."""
    cols = [c for c in frame.columns if c != "output"]
    at = cols.index("form")
    fields = ", ".join(f"`{c}` {t}" for c, t in frame.select(*cols).dtypes)

    def run(batches):
        import pyarrow as pa

        for b in slices(batches, "output"):
            text = restored(b.column(len(cols)).cast(pa.string()), b.column(at).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(cols)], text], [*cols, "text"])

    return map_arrow(frame.select(*cols, "output"), run, f"{fields}, text string")


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents")).withColumn("output_sha256", F.sha2("output", 256))
    return restore(out).select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                               "output_sha256", F.sha2("text", 256).alias("restored_sha256"))


OP12_SQL = """
WITH units AS (
  SELECT doc_id, COALESCE(text, '') AS text, regexp_extract_all(COALESCE(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || CAST(doc_id AS VARCHAR)) AS d
  FROM documents),
cuts AS (
  SELECT *, len(u) AS n,
         CAST('0x' || substr(d, 1, 8) AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || substr(d, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
         CAST('0x' || substr(d, 17, 8) AS BIGINT) % 100 AS c, CAST('0x' || substr(d, 25, 8) AS BIGINT) % 100 AS e
  FROM units),
pieces AS (
  SELECT *, COALESCE(array_to_string(u[1:least(a, b)], ''), '') AS p,
         COALESCE(array_to_string(u[least(a, b) + 1:greatest(a, b)], ''), '') AS m,
         COALESCE(array_to_string(u[greatest(a, b) + 1:], ''), '') AS s,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 90
              THEN 'plain' WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces
"""
