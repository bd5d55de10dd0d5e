"""Helpers shared by the operators: tables, Arrow batches, skew-safe lookups,
distributed ranks and connected components."""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialize

#: At most so many keys can each hold more than one part in HEAVY_KEYS of all
#: rows, so the table of those keys is small at any scale and may be broadcast.
HEAVY_KEYS = 1000
#: Names under which workers remember pieces and words between tasks.
TOKEN_PIECES, UNIGRAM_WORDS, PIECE_WORDS = "_token_pieces", "_unigram_words", "_piece_words"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrowed(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only: extra columns of the caller never clash."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: lineage is cut and a
    lost executor costs no recomputation of what is already written."""
    return materialize(df)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use."""
    used = {c.lower() for c in df.columns}
    while stem.lower() in used:
        stem += "_"
    return stem


def identified(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a column ``name`` that tells rows apart and is the same in
    every pass, whatever the ids are and however the files are split: hash of
    the file and row number in it.  ``docs`` is a table read from files, with
    columns selected at most; anything else is written first, anew by each
    call, so a step that marks its rows twice passes them through ``placed``."""
    return _marked(placed(docs), name)


def _marked(docs: DataFrame, name: str) -> DataFrame:
    meta = docs.metadataColumn("_metadata")
    out = docs.withColumn(name, F.concat_ws("-", F.hex(F.xxhash64(meta["file_path"])), F.hex(meta["row_index"])))
    out.schema  # analysed here
    return out


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` if its rows have a place in files, otherwise ``docs`` written
    once: the marks of all ``identified`` copies of the result agree."""
    try:
        _marked(docs, free_name(docs, "_rid"))
        return docs
    except AnalysisException:  # no files
        return written(docs)


def rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rid, id, text) of ``docs``, null texts as empty ones."""
    mark = free_name(docs, "_rid")
    return identified(docs, mark).select(F.col(mark).alias("rid"), F.col(f"`{id_col}`").alias("id"),
                                         F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def without(docs: DataFrame, rids: DataFrame) -> DataFrame:
    """``docs`` less the rows in ``rids`` (rid).  ``docs`` is the ``placed``
    frame that the rids come from; one without files has no such marks and is
    refused.  The rids are written first: Spark then knows their size and
    broadcasts them only if they are small."""
    mark = free_name(docs, "_rid")
    marked = _marked(docs, mark)
    gone = written(rids.select(F.col("rid").alias(mark)))
    return marked.join(gone, mark, "left_anti").drop(mark)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text",
           limit: int = 4 << 20, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``limit`` bytes in
    each (at least one row) and there are at most ``rows`` rows, which bounds
    a worker's memory whatever the row lengths are."""
    import numpy as np
    import pyarrow.compute as pc

    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(column))), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < b.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            stop = min(stop, start + (rows or stop))
            yield b.slice(start, stop - start)
            start = stop


def map_arrow(df: DataFrame, fn, schema: str, keeps: str | None = None) -> DataFrame:
    """``mapInArrow``.  Workers outlive a task: what another operator
    remembers in them is dropped first (all but ``keeps``), and at the end
    free memory goes back to the system."""
    drop = tuple(n for n in (TOKEN_PIECES, UNIGRAM_WORDS, PIECE_WORDS) if n != keeps)

    def run(batches):
        import ctypes
        import sys

        import pyarrow as pa

        for name in drop:
            sys.modules.pop(name, None)
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return df.mapInArrow(run, schema)


def lookup(left: DataFrame, right: DataFrame, keys: list[str], n_col: str,
           total: int, how: str = "left") -> DataFrame:
    """Join ``left`` with ``right`` (one row per key, ``n_col`` = rows of that
    key in ``left``; dropped from the result).  Keys with more than
    total/HEAVY_KEYS rows, of which there are fewer than HEAVY_KEYS, are
    broadcast, so a hot key never meets in one task; the others are joined by
    shuffle."""
    cut = total // HEAVY_KEYS + 1
    mark = "_heavy"
    rest = [c for c in right.columns if c not in keys and c != n_col]
    heavy = right.where(F.col(n_col) > cut).select(*keys, F.lit(True).alias(mark), *rest)
    light = right.where(F.col(n_col) <= cut).select(*keys, *rest)
    is_heavy = left.join(F.broadcast(heavy.select(*keys, mark)), keys, "left")
    hot = (is_heavy.where(F.col(mark).isNotNull()).drop(mark)
           .join(F.broadcast(heavy.drop(mark)), keys, "inner"))
    cold = is_heavy.where(F.col(mark).isNull()).drop(mark).join(light, keys, how)
    return hot.unionByName(cold)


def gapless(df: DataFrame, group: str, order: list[Column], out: str, rows: int,
            salt: list[Column], counted: DataFrame | None = None, per_bucket: int = 10_000) -> DataFrame:
    """Number the rows of each ``group`` from 0 without gaps, in any order
    across buckets.  Rows are dealt by (group, bucket), where the bucket is a
    hash of ``salt``, so a hot group is spread over as many tasks as it needs;
    the counts of the buckets give each its first number.  ``counted`` may hold
    the same groups and salts as ``df`` in a table that is cheaper to count."""
    n = max(1, rows // per_bucket)
    bucket, first = free_name(df, "_bucket"), free_name(df, "_first")
    number = F.pmod(F.xxhash64(*salt), F.lit(n)).cast("int")
    keyed = df.withColumn(bucket, number)
    counts = ((keyed if counted is None else counted.withColumn(bucket, number))
              .groupBy(group, bucket).agg(F.count(F.lit(1)).alias("_n")))
    before = W.partitionBy(group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select(group, bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(first))
    ranked = keyed.withColumn(out, F.row_number().over(W.partitionBy(group, bucket).orderBy(*order)) - 1)
    return (ranked.join(firsts, [group, bucket], "inner")
            .withColumn(out, (F.col(first) + F.col(out)).cast("long")).drop(bucket, first))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b), by alternating large and
    small stars until nothing changes.  Returns (node, root), root = smallest
    node reachable, for every node with an edge to another one.

    Every round is written to the shared checkpoint folder.  Neighbours are
    only ever reduced to their minimum (partial aggregates), and hub nodes are
    joined through ``lookup``; no neighbour list is ever collected."""
    edges = written(edges.where(F.col("a") != F.col("b"))
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        total = edges.count()
        new = edges.agg(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()[0]
        if (total, new) == state or total == 0:
            break
        state = (total, new)
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = (lookup(both, near, ["a"], "n", 2 * total, "inner").where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")))
        large = written(large.distinct())
        total = large.count()
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        small = (lookup(large, low, ["a"], "n", total, "inner")
                 .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where(F.col("a") != F.col("b")))
        edges = written(small.distinct())
    node = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return node.unionByName(node.select(F.col("root").alias("node"), "root").distinct())
