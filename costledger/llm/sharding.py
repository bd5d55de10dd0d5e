"""Sharding by histogram sort (operator 6).

Rows are ordered by the hash of their text, so equal texts lie side by side,
and rows of one text by a hash of their row number.  The splitters between
shards are found without sorting: each round counts, in one pass over a narrow
table, the exact bytes below evenly spaced probes in the range of every open
splitter, until one is within the tolerance of its share; then the rows are
exchanged once.  The law is ``bytes``: shards are equal in size.  A group of
equal texts is cut only if it is larger than both the largest row and the share
WHOLE of a shard.

Defined results: a null text is an empty text; repeated rows are rows; an
empty table gives no rows; a very long text is a row like any other, and a
shard may be larger than its share by one row at most; a column of the input
that is named like one the operator adds is renamed with underscores at its
end, as many as make the name a new one."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import gapless, identified, map_arrow, written

#: Probes per open splitter and round; shares of a shard by which a splitter
#: may miss, and up to which a group of equal texts stays whole.
PROBES, TOLERANCE, WHOLE = 64, 0.001, 0.01
#: What a row takes besides its text.
ROW_BYTES = 8
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def _below(keys: DataFrame, probes: list[int], inside: dict[int, list[int]]) -> tuple[dict[int, int], dict[tuple[int, int], int]]:
    """Exact bytes of the rows whose h is below each probe, and, for a value v
    in ``inside``, of those with h = v whose t is below each of its probes.
    Each task sends one sum per interval between probes."""
    flat = sorted(set(probes))
    nested = {v: sorted(set(p)) for v, p in inside.items()}
    offsets, n = {}, len(flat) + 1
    for v in sorted(nested):
        offsets[v] = n
        n += len(nested[v]) + 1

    def run(batches):
        import numpy as np
        import pyarrow as pa

        sums = np.zeros(n, np.int64)
        for b in batches:
            h, t, size = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            at = np.searchsorted(np.array(flat, np.int64), h, "right")
            np.add.at(sums, at, size)
            for v, ps in nested.items():
                mine = h == v
                np.add.at(sums, offsets[v] + np.searchsorted(np.array(ps, np.int64), t[mine], "right"), size[mine])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n), pa.int32()), pa.array(sums)], ["k", "bytes"])

    got = [0] * n
    for r in map_arrow(keys.select("h", "t", "size"), run, "k int, bytes long").groupBy("k").agg(F.sum("bytes").alias("b")).collect():
        got[r["k"]] = r["b"]

    def running(first, ps):
        total, out = 0, {}
        for k, p in enumerate(ps):
            total += got[first + k]
            out[p] = total
        return out

    return running(0, flat), {(v, p): x for v, ps in nested.items() for p, x in running(offsets[v], ps).items()}


def _spaced(low: int, high: int) -> list[int]:
    """Up to PROBES probes strictly between low and high."""
    step = max(1, -(-(high - low) // (PROBES + 1)))
    return list(range(low + step, high, step))


def splitters(keys: DataFrame, shards: int, total: int, largest: int) -> list[tuple[int, int]]:
    """shards - 1 keys (h, t): a row belongs above every splitter that is not
    greater than its own key.  ``keys`` is a table (h, t, size)."""
    ideal = total / shards
    slack, whole = TOLERANCE * ideal, max(largest, WHOLE * ideal)
    # Per splitter: bytes wanted below; range of h with the bytes below its ends; then the same of t within one h.
    live = {k: {"goal": k * ideal, "v": None, "low": LOWEST, "high": HIGHEST + 1, "less": 0, "more": total, "base": 0}
            for k in range(1, shards)}
    done: dict[int, tuple[int, int]] = {}

    def settle(k, value):
        s = live.pop(k)
        done[k] = (value, LOWEST) if s["v"] is None else (s["v"], value)

    while live:
        for k, s in list(live.items()):
            if s["high"] - s["low"] > 1:
                continue
            if s["v"] is None and s["more"] - s["less"] > whole:  # one text holds the goal
                s.update(v=s["low"], base=s["less"], low=LOWEST, high=HIGHEST + 1)
            else:
                settle(k, s["low"] if s["goal"] - s["less"] <= s["more"] - s["goal"] else s["high"])
        if not live:
            break
        probes = {k: _spaced(s["low"], s["high"]) for k, s in live.items()}
        inside: dict[int, list[int]] = {}
        for k, s in live.items():
            if s["v"] is not None:
                inside.setdefault(s["v"], []).extend(probes[k])
        flat, nested = _below(keys, [p for k, s in live.items() if s["v"] is None for p in probes[k]], inside)
        for k, s in list(live.items()):
            for p in probes[k]:
                x = flat[p] if s["v"] is None else s["base"] + nested[s["v"], p]
                if x <= s["goal"]:
                    s.update(low=p, less=x)
                else:
                    s.update(high=p, more=x)
                    break
            if min(s["goal"] - s["less"], s["more"] - s["goal"]) <= slack:
                settle(k, s["low"] if s["goal"] - s["less"] <= s["more"] - s["goal"] else s["high"])
    out = [done[k] for k in sorted(done)]
    return [(HIGHEST, HIGHEST) if h > HIGHEST else (h, min(t, HIGHEST)) for h, t in out]


def _renamed(columns: list[str], taken: tuple[str, ...]) -> dict[str, str]:
    """New names for those of ``columns`` that are ``taken``."""
    used, out = {c.lower() for c in columns}, {}
    for c in columns:
        if c.lower() in taken:
            new = f"{c}_"
            while new.lower() in used:
                new += "_"
            used.add(new.lower())
            out[c] = new
    return out


def sharded(docs: DataFrame, shards: int = 24, text_col: str = "text") -> DataFrame:
    """``docs`` with (shard, slot): slots count from 0 in each shard.  The
    rows move once."""
    spare = _renamed(docs.columns, ("shard", "slot", "_rid", "_h", "_t"))
    docs = docs.withColumnsRenamed(spare)
    text_col = spare.get(text_col, text_col)
    keyed = (identified(docs, "_rid")
             .withColumn("_h", F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
             .withColumn("_t", F.xxhash64("_rid")))
    size = (F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)) + ROW_BYTES).cast("long")
    keys = written(keyed.select(F.col("_rid"), F.col("_h").alias("h"), F.col("_t").alias("t"), size.alias("size")))
    facts = keys.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), F.max("size").alias("most")).first()
    if not facts["n"]:
        return keyed.select(*docs.columns, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    cuts = splitters(keys, shards, facts["total"], facts["most"])

    def shard(h, t):
        out = F.lit(0)
        for v, q in cuts:
            out = out + ((F.col(h) > v) | ((F.col(h) == v) & (F.col(t) >= q))).cast("int")
        return out

    return gapless(keyed.withColumn("shard", shard("_h", "_t")), "shard", [F.col("_rid")], "slot", facts["n"],
                   salt=[F.col("_rid")], counted=keys.withColumn("shard", shard("h", "t"))
                   ).select(*docs.columns, "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 24, text_col: str = "text") -> None:
    """One folder per shard, rows whole."""
    sharded(docs, shards, text_col).write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    from .common import table
    docs = table(spark, sf_dir, "documents")
    path = f"{ensure_checkpoint_dir(spark)}/shards-{uuid.uuid4().hex}"
    out = sharded(docs, 24)
    out.write.partitionBy("shard").parquet(path)
    text = F.coalesce("text", F.lit(""))
    return read_shards(spark, path, out.schema).select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
