"""Token ids in Huffman-coded files (operator 7).

Format: a folder of Parquet files, one row per block.

* ``codebook``: (id, length), the canonical code: codes of one length ascend
  with the id, shorter codes come first, no code is longer than 16 bits.
* ``blocks``: (file, block, first, docs, tokens, bits, checkpoints): ``docs``
  and ``tokens`` list the documents of the block in ascending id order and how
  many ids each has, ``first`` is the number of ids before the block in its
  file, ``bits`` holds the codes, highest bit first, and ``checkpoints`` the
  bit offset of every 256th id.  A document lies in one block, so each block
  decodes alone; between checkpoints all stretches decode side by side, one
  table look-up per id.

Files are ranges of ids and blocks are numbered within a file.  Spark's
writer commits them, so a lost executor only repeats its own tasks.

Defined results: a null text is an empty text (only the end id); null ids
come first; repeated ids keep a stable order by position in the input; an
empty table gives an empty file; other columns are ignored."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import ensure_checkpoint_dir
from .common import TOKEN_PIECES, map_arrow, narrowed, slices
from .encode import ENCODE_BYTES, word_encoder

#: Longest code in bits; ids between checkpoints, of a block and of a file.
LIMIT, CHECKPOINT, BLOCK_IDS, FILE_IDS = 16, 256, 1 << 15, 1 << 23


def token_counts(docs: DataFrame, tokenizer_file: str, end_id: int = 1, text_col: str = "text") -> DataFrame:
    """(id, n) over the ids of all rows, end ids included; each task sends one
    sum per id."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        encode = word_encoder(tokenizer_file)
        counts = np.zeros(0, np.int64)
        for b in slices(batches, text_col, ENCODE_BYTES):
            got = encode.counted(b.column(0))
            wide = np.zeros(max(end_id + 1, len(counts), len(got)), np.int64)
            wide[:len(counts)] += counts
            wide[:len(got)] += got
            wide[end_id] += b.num_rows
            counts = wide
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["id", "n"])

    return (map_arrow(narrowed(docs, text_col), run, "id int, n long", keeps=TOKEN_PIECES)
            .groupBy("id").agg(F.sum("n").alias("n")))


def code_lengths(counts, limit: int = LIMIT):
    """Length of the code of each of the positive ``counts`` (numpy array), at
    most ``limit`` bits: package-merge."""
    import numpy as np

    n = len(counts)
    if n == 1:
        return np.ones(1, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids don't fit codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    packages, is_leaf = np.empty(0, np.int64), []
    for _ in range(limit):
        both = np.concatenate((leaves, packages))
        by = np.argsort(both, kind="stable")
        is_leaf.append(by < n)
        both = both[by]
        packages = both[0:len(both) // 2 * 2:2] + both[1::2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(is_leaf):
        m = int(leaf[:take].sum())
        lengths[:m] += 1
        take = 2 * (take - m)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


def canonical_codes(ids, lengths):
    """(codes, ids in code order, lengths in code order)."""
    import numpy as np

    order = np.lexsort((ids, lengths))
    size = lengths[order]
    # A code is the sum of the parts of the code space before it.
    space = np.concatenate(([0], np.cumsum(np.int64(1) << (LIMIT - size))[:-1]))
    return space >> (LIMIT - size), ids[order], size


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS) -> None:
    """Write the ids of every row, each followed by ``end_id``, in ascending
    order of the id column."""
    import numpy as np

    spark = docs.sparkSession
    counted = [(r["id"], r["n"]) for r in token_counts(docs, tokenizer_file, end_id, text_col).collect()]  # a row per vocabulary entry
    book = np.array(sorted(counted), np.int64).reshape(-1, 2)
    lengths = code_lengths(book[:, 1]) if len(book) else np.empty(0, np.int64)
    spark.createDataFrame([(int(i), int(n)) for i, n in zip(book[:, 0], lengths, strict=True)],
                          "id int, length int").coalesce(1).write.parquet(f"{path}/codebook")
    codes, ids, size = canonical_codes(book[:, 0], lengths)
    code_of = np.zeros(int(book[:, 0].max(initial=0)) + 1, np.uint32)
    bits_of = np.zeros(len(code_of), np.uint8)
    code_of[ids], bits_of[ids] = codes, size

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encode = word_encoder(tokenizer_file)
        file, block, first = TaskContext.get().partitionId(), 0, 0

        def coded(ids):
            """(bits as bytes, bit offset of each id)."""
            n = bits_of[ids].astype(np.int64)
            ends = np.cumsum(n)
            at = ends - n
            word = at >> 5
            value = code_of[ids].astype(np.uint64) << (64 - n - (at & 31)).astype(np.uint64)
            # Bits of different ids don't overlap: sums below 2^32 are exact in doubles.
            words = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), int(ends[-1] >> 5) + 2)
            words += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), len(words))
            return words.astype(">u4").tobytes()[:int(ends[-1] + 7) >> 3], at

        for b in slices(batches, text_col, ENCODE_BYTES):
            found, n = encode(b.column(1))
            per = n + 1
            ends = np.cumsum(per)
            all_ids = np.full(int(ends[-1]), end_id, np.int32)
            body = np.ones(len(all_ids), bool)
            body[ends - 1] = False
            all_ids[body] = found
            names, rows, start = b.column(0), [], 0
            while start < len(per):
                before = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + BLOCK_IDS, "right")))
                part = all_ids[before:int(ends[stop - 1])]
                data, at = coded(part)
                rows.append((file, block, first, names.slice(start, stop - start).to_pylist(),
                             per[start:stop].tolist(), data, at[::CHECKPOINT].astype("<i8").tobytes()))
                block, first, start = block + 1, first + len(part), stop
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    (pa.int32(), pa.int32(), pa.int64(), pa.list_(names.type), pa.list_(pa.int64()),
                     pa.binary(), pa.binary()))],
                ["file", "block", "first", "docs", "tokens", "bits", "checkpoints"])

    kind = dict(docs.dtypes)[id_col]
    files = max(1, int(book[:, 1].sum()) // file_ids + 1)
    src = narrowed(docs, id_col, text_col).withColumn("_at", F.monotonically_increasing_id())
    ordered = (src.repartitionByRange(files, F.col(f"`{id_col}`"), F.col("_at"))
               .sortWithinPartitions(F.col(f"`{id_col}`"), F.col("_at")).drop("_at"))
    map_arrow(ordered, run, f"file int, block int, first long, docs array<{kind}>, tokens array<long>, "
              "bits binary, checkpoints binary", keeps=TOKEN_PIECES).write.parquet(f"{path}/blocks")


def decoder(book):
    """A function from rows (bits, checkpoints, number of ids) to the ids of
    all rows in one array.  ``book``: (id, length) rows."""
    import numpy as np

    book = np.array(sorted(book), np.int64).reshape(-1, 2)
    codes, ids, size = canonical_codes(book[:, 0], book[:, 1])
    id_at, bits_at = np.zeros(1 << LIMIT, np.int32), np.ones(1 << LIMIT, np.int64)
    if len(ids):
        spread = np.int64(1) << (LIMIT - size)
        id_at[:spread.sum()], bits_at[:spread.sum()] = np.repeat(ids, spread), np.repeat(size, spread)

    def decode(rows):
        data = np.concatenate([np.frombuffer(r[0] + b"\0\0\0\0", np.uint8) for r in rows]).astype(np.uint32)
        # The 32 bits that begin at each byte.
        window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        base = np.cumsum([0] + [len(r[0]) + 4 for r in rows])[:-1] * 8
        marks = [np.frombuffer(r[1], "<i8") for r in rows]
        at = np.concatenate([m + s for m, s in zip(marks, base, strict=True)])
        todo = np.concatenate([np.minimum(CHECKPOINT, r[2] - CHECKPOINT * np.arange(len(m)))
                               for r, m in zip(rows, marks, strict=True)])
        out = np.empty(int(todo.sum()), np.int32)
        put = np.cumsum(todo) - todo
        by = np.argsort(-todo, kind="stable")  # lanes end in turn
        at, put, todo = at[by], put[by], todo[by]
        live = len(todo) - np.searchsorted(todo[::-1], np.arange(int(todo.max(initial=0))), "right")
        for step, n in enumerate(live.tolist()):
            a = at[:n]
            look = window[a >> 3] >> (16 - (a & 7)).astype(np.uint32) & np.uint32(0xFFFF)
            out[put[:n] + step] = id_at[look]
            at[:n] += bits_at[look]
        return out

    return decode


def decoded(spark: SparkSession, path: str) -> DataFrame:
    """(file, doc_id, start, n_tokens, ids): the documents of the files;
    ``start`` counts the ids before it in its file, ``ids`` is binary,
    little-endian unsigned 32 bits each."""
    book = [(r["id"], r["length"]) for r in spark.read.parquet(f"{path}/codebook").collect()]  # a row per vocabulary entry
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = dict(blocks.dtypes)["docs"].removeprefix("array<").removesuffix(">")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        decode = decoder(book)
        for whole in batches:
            for b in slices([whole], "bits", 4 << 20):
                docs, tokens = b.column(2), b.column(3)
                per = tokens.flatten().to_numpy(zero_copy_only=False)
                n = np.add.reduceat(per, tokens.offsets.to_numpy()[:-1] - tokens.offsets[0].as_py())
                ids = decode(list(zip(b.column(4).to_pylist(), b.column(5).to_pylist(), n.tolist(), strict=True)))
                ends = np.cumsum(per)
                block_first = np.repeat(b.column(1).to_numpy(zero_copy_only=False) - (np.cumsum(n) - n),
                                        np.diff(tokens.offsets.to_numpy()))
                data = pa.BinaryArray.from_buffers(pa.binary(), len(per), [None, pa.py_buffer(
                    np.concatenate(([0], ends * 4)).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
                files = pa.array(np.repeat(b.column(0).to_numpy(zero_copy_only=False),
                                           np.diff(tokens.offsets.to_numpy())), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [files, docs.flatten(), pa.array(block_first + ends - per, pa.int64()),
                     pa.array(per, pa.int64()), data], ["file", "doc_id", "start", "n_tokens", "ids"])

    return map_arrow(blocks.select("file", "first", "docs", "tokens", "bits", "checkpoints"), run,
                     f"file int, doc_id {kind}, start long, n_tokens long, ids binary")


def placed(rows: DataFrame, path: str) -> DataFrame:
    """``start`` of ``rows`` (file, start, ...) counted over all files: the
    totals are one row per file."""
    blocks = rows.sparkSession.read.parquet(f"{path}/blocks")
    sizes = blocks.select("file", F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")) \
        .groupBy("file").agg(F.sum("n").alias("n"))
    before = sizes.select("file", F.coalesce(F.sum("n").over(
        W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return rows.join(before, "file").withColumn("start", F.col("_before") + F.col("start")).drop("file", "_before")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents of the files."""
    return placed(decoded(spark, path), path)


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from .common import table
    path = f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    digests = decoded(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return placed(digests, path).select("doc_id", "start", "n_tokens", "ids_crc32")
