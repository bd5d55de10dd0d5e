"""Exact duplicates by composable polynomial fingerprints (operator 10).

Texts are equal when identical after deleting white space.  The fingerprint
of a chunk is a polynomial in its bytes modulo two primes; the fingerprint of
a text combines those of its chunks by shifting with the length before them,
so chunks hash independently, in any order.  Rows whose length and fingerprint
agree are then compared chunk by chunk, as a stream, with the first row of
their group; rows that turn out different form groups of their own.

Defined results: a null text is an empty text; repeated rows are copies of
each other (one is kept); among equal candidates the smallest id is kept and a
null id comes last; an empty table gives no rows; other columns are ignored."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settled
from .common import HEAVY_KEYS, lookup, map_arrow, rows_of, slices, written

#: Fixed parameters of the fingerprint: primes and bases.
PRIMES, BASES = (2_147_483_647, 2_147_483_629), (1_103_515_245, 1_812_433_253)
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
CHUNK = 1 << 16
#: Largest filter of repeated fingerprints, in bits (16 MB).
MOST_BITS = 1 << 27


def fingerprinter(primes=PRIMES, chunk: int = CHUNK):
    """(fingerprint of bytes, combine, finish): ``combine(a, len_a, b)`` is
    the pair of residues of a text made of a and b."""
    import numpy as np

    powers = []
    for p, base in zip(primes, BASES, strict=True):
        row = np.ones(chunk + 1, np.int64)
        done = 1
        while done <= chunk:  # doubling: base^(k + done) = base^k * base^done
            m = min(done, chunk + 1 - done)
            row[done:done + m] = row[:m] * pow(base, done, p) % p
            done += m
        powers.append(row)

    def part(data):
        b = np.frombuffer(data, np.uint8).astype(np.int64) + 1
        return tuple(int(b @ w[:len(b)] % p) for w, p in zip(powers, primes, strict=True))

    def combine(a, len_a, b):
        return tuple((x + pow(base, len_a, p) * y) % p
                     for x, y, base, p in zip(a, b, BASES, primes, strict=True))

    def whole(data):
        out = (0,) * len(primes)
        for k in range(0, len(data), chunk):
            got = part(data[k:k + chunk])
            out = combine(out, k, got) if k else got
        return out[0] << 31 | out[1]

    return whole, part, combine


def digests(rows: DataFrame, primes=PRIMES) -> DataFrame:
    """(rid, id, n_chars, size, fp, sha256) of the normalised texts."""
    def run(batches):
        import hashlib

        import pyarrow as pa

        whole, _, _ = fingerprinter(primes)
        for b in slices(batches):
            texts = [t.translate(None, SPACE) for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(map(len, texts), pa.int64()),
                 pa.array(map(whole, texts), pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())],
                ["rid", "id", "n_chars", "size", "fp", "sha256"])

    kind = dict(rows.dtypes)["id"]
    src = rows.select("rid", "id", F.length("text").cast("long").alias("n_chars"), F.col("text").cast("binary"))
    return map_arrow(src, run, f"rid string, id {kind}, n_chars long, size long, fp long, sha256 string")


def _repeated(groups: DataFrame, n_groups: int):
    """A bitmap over fp modulo its size, with the bit of every fingerprint in
    ``groups`` set; at most MOST_BITS bits however many there are."""
    bits = 1 << 20
    while bits < min(MOST_BITS, 16 * n_groups):
        bits *= 2
    at = F.pmod("fp", F.lit(bits)) + 1  # the bitmap functions count from 1
    rows = (groups.groupBy(F.bitmap_bucket_number(at).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap")).collect())
    out = bytearray(bits // 8)
    for r in rows:
        first = (r["bucket"] - 1) * 4096
        out[first:first + 4096] = r["bitmap"]
    return bytes(out)


def _compared(rows: DataFrame, groups: DataFrame, rows_total: int, n_groups: int, primes, chunk: int) -> DataFrame:
    """(rid, rep, same): every row whose (size, fp) is in ``groups`` against
    the first row of its group.  Groups of more than rows/HEAVY_KEYS rows
    (fewer than HEAVY_KEYS) are dealt over several tasks, each with a copy of
    the first row."""
    cut = rows_total // HEAVY_KEYS + 1
    heavy = {(r["size"], r["fp"]): (r["rep"], -(-r["n"] // cut)) for r in
             groups.where(F.col("n") > cut).select("size", "fp", "rep", "n").collect()}
    spark = rows.sparkSession
    seen = spark.sparkContext.broadcast(_repeated(groups, n_groups))

    def cut_up(batches):
        import zlib

        import pyarrow as pa

        whole, _, _ = fingerprinter(primes)
        marks = seen.value
        for b in slices(batches):
            out = []
            for rid, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                text = text.translate(None, SPACE)
                fp = whole(text)
                at = fp % (8 * len(marks))
                if not marks[at >> 3] >> (at & 7) & 1:
                    continue
                first, parts = heavy.get((len(text), fp), (None, 1))
                for salt in range(parts) if rid == first else [zlib.crc32(rid.encode()) % parts]:
                    out += [(rid, len(text), fp, salt, k, text[k * chunk:(k + 1) * chunk])
                            for k in range(max(1, -(-len(text) // chunk)))]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in out], t) for k, t in enumerate(
                        (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                    ["rid", "size", "fp", "salt", "chunk", "data"])

    def compare(batches):
        import pyarrow as pa

        key, first, data = None, None, None
        for b in slices(batches, "data"):
            rids, reps, sames = [], [], []
            for rid, *k, mine in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if k != key:
                    key, first, data = k, rid, mine
                if rid != first:
                    rids.append(rid)
                    reps.append(first)
                    sames.append(mine == data)
            yield pa.RecordBatch.from_arrays([pa.array(rids, pa.string()), pa.array(reps, pa.string()),
                                              pa.array(sames, pa.bool_())], ["rid", "rep", "same"])

    src = rows.select("rid", F.col("text").cast("binary"))
    chunks = map_arrow(src, cut_up, "rid string, size long, fp long, salt int, chunk int, data binary")
    keys = ["size", "fp", "salt", "chunk"]
    dealt = chunks.repartition(*keys).sortWithinPartitions(*keys, "rid")
    verdicts = map_arrow(dealt.select("rid", *keys, "data"), compare, "rid string, rep string, same boolean")
    return verdicts.groupBy("rid").agg(F.min("rep").alias("rep"), F.bool_and("same").alias("same"))


def _classed(docs: DataFrame, id_col: str, text_col: str, primes, chunk: int) -> DataFrame:
    """(rid, id, n_chars, sha256, rep): rows of equal texts share ``rep``, the
    first of them by rid."""
    rows = rows_of(docs, id_col, text_col)
    facts = written(digests(rows, primes))
    total = facts.count()
    parts, todo, todo_rows = [], facts.select("rid", "size", "fp"), rows
    while True:
        groups = written(todo.groupBy("size", "fp").agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("n"))
                         .where("n > 1"))
        n_groups = groups.count()
        if not n_groups:
            break
        verdicts = written(_compared(todo_rows, groups, total, n_groups, primes, chunk))
        parts.append(verdicts.where("same").select("rid", "rep"))
        # Equal fingerprints of different texts: those rows are grouped again.
        todo = written(verdicts.where(~F.col("same")).select("rid").join(facts.select("rid", "size", "fp"), "rid"))
        if not todo.count():
            break
        todo_rows = rows.join(todo.select("rid"), "rid", "left_semi")
    classed = facts.withColumn("rep", F.col("rid"))
    if parts:
        equal = parts[0]
        for more in parts[1:]:
            equal = equal.unionByName(more)
        classed = (facts.join(equal, "rid", "left").withColumn("rep", F.coalesce("rep", "rid")))
    return classed.drop("size", "fp")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     primes=PRIMES, chunk: int = CHUNK) -> DataFrame:
    """(rid, id, keep_rid, keep_id, group_size, kept, sha256), a row per row
    of ``docs``: of equal texts, the row with the most code points, then the
    smallest id, is kept."""
    # What was written on the way is removed: only the classes are needed on.
    classed = settled(docs.sparkSession, lambda: _classed(docs, id_col, text_col, primes, chunk))
    total = classed.count()
    best = F.min_by(F.struct(F.col("rid").alias("keep_rid"), F.col("id").alias("keep_id")),
                    F.struct(-F.col("n_chars"), F.col("id").isNull(), "id", "rid"))
    kept = classed.groupBy("rep").agg(best.alias("k"), F.count(F.lit(1)).alias("n")) \
        .select("rep", "k.*", F.col("n").alias("group_size"), "n")
    return (lookup(classed, kept, ["rep"], "n", total, "inner")
            .select("rid", "id", "keep_rid", "keep_id", "group_size",
                    (F.col("rid") == F.col("keep_rid")).alias("kept"), "sha256"))


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table
    return exact_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


OP10_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n_chars DESC, doc_id)
"""
