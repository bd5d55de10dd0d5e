"""SimHash near-duplicate groups (operator 1).

Fingerprints are compared exactly and in tiles: distinct fingerprints with the
same population counts in each quarter form a cell, a cell is cut into tiles,
and a pair of tiles is compared (exclusive-or, bit count) only if the sum of
the differences of their counts is within the radius.  That sum never exceeds
the number of differing bits, so no pair is lost.

Defined results: a null text is an empty text; a text without words has
fingerprint 0 and is linked like any other; repeated rows are copies; a
null doc_id is carried but never becomes a component id; an empty table gives
no rows; columns other than the id and the text are ignored."""
from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settled
from .common import components, lookup, map_arrow, narrowed, slices, written

#: Rows of a tile, and entries of one exclusive-or block.
TILE, BLOCK = 16_384, 1 << 21
#: The 64 bits are counted in four quarters.
QUARTERS, QUARTER = 4, 0xFFFF


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, fp): 64-bit SimHash over XXH64 (seed 42) of ``shingle``-word
    shingles, repeats included, of the ASCII-lower-cased words of the text."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest as xxh

        def hashes(text):
            words = text.lower().split()
            if len(words) <= shingle:
                return [xxh(b" ".join(words), 42)] if words else []
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate(([0], ends[:-shingle])).tolist()
            return [xxh(joined[a:b], 42) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=True)]

        def votes(h):
            ones = np.zeros(64, np.int64)
            for k in range(0, len(h), 1 << 16):
                bits = np.unpackbits(np.array(h[k:k + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8),
                                     axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.int64)
            return np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0] if h else 0

        for b in slices(batches, text_col):
            texts = b.column(1).cast(pa.binary()).to_pylist()
            fps = [votes(hashes(t)) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["id", "fp"])

    kind = dict(docs.dtypes)[id_col]
    src = narrowed(docs, id_col, text_col).withColumn(text_col, F.col(text_col).cast("binary"))
    return map_arrow(src, run, f"id {kind}, fp long")


def _cell(fp, quarters: int = QUARTERS):
    """Population counts of the quarters, as one number in base 17."""
    key = F.lit(0)
    for k in range(quarters):
        key = key * 17 + F.bit_count(F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(QUARTER).cast("long")))
    return key.cast("int")


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """One of each pair of opposite steps between cells within the radius, and
    the step from a cell to itself."""
    return [o for o in product(range(-radius, radius + 1), repeat=QUARTERS)
            if sum(map(abs, o)) <= radius and o >= (0,) * QUARTERS]


def links(fps: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """(a, b): a spanning set of the links between distinct fingerprints
    ``fps`` (fp) that differ in at most ``radius`` bits: per home tile, each
    visiting fingerprint with a partner and each merge of home fingerprints
    once, so a dense group costs its size, not its square.

    The count of each cell (at most 17^4 cells) decides into how many tiles it
    is cut, so no group of rows grows with the input.  A pair of cells is
    compared in the tiles of the one, which the tiles of the other visit."""
    cells = (fps.groupBy(_cell(F.col("fp")).alias("cell")).agg(F.count(F.lit(1)).alias("_n"))
             .select("cell", F.ceil(F.col("_n") / tile).cast("int").alias("parts")))
    cells = written(cells.coalesce(1))  # at most 17^4 rows: a proven bound
    tiles = (fps.withColumn("cell", _cell(F.col("fp"))).join(F.broadcast(cells), "cell")
             .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
             .groupBy("cell", "part").agg(F.collect_list("fp").alias("fps")))
    tiles = written(tiles)
    digits = [F.pmod(F.floor(F.col("cell") / 17 ** (QUARTERS - 1 - k)), F.lit(17)).cast("int") for k in range(QUARTERS)]
    steps = F.array(*[F.struct(*[F.lit(x).alias(f"o{k}") for k, x in enumerate(o)]) for o in _offsets(radius)])
    inside = [(F.col(f"d{k}") + F.col(f"s.o{k}")).between(0, 16) for k in range(QUARTERS)]
    target = sum((F.col(f"d{k}") + F.col(f"s.o{k}")) * 17 ** (QUARTERS - 1 - k) for k in range(QUARTERS))
    moved = (tiles.select("cell", "part", *[d.alias(f"d{k}") for k, d in enumerate(digits)])
             .withColumn("s", F.explode(steps)))
    for i in inside:
        moved = moved.where(i)
    moved = moved.select("cell", "part", target.cast("int").alias("home"))
    # Every tile of the home cell is visited; within one cell each pair of tiles
    # meets once.  A tile without rows (its hash came up for none) is no home:
    # its visitors find no own tile and are skipped.
    meets = (moved.join(F.broadcast(cells.select(F.col("cell").alias("home"), F.col("parts").alias("homes"))), "home")
             .withColumn("home_part", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)))
             .where((F.col("home") != F.col("cell")) | (F.col("home_part") <= F.col("part"))))
    visits = meets.join(tiles, ["cell", "part"]).select(
        "home", "home_part",
        ((F.col("home") == F.col("cell")) & (F.col("home_part") == F.col("part"))).alias("own"), "fps")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def merge(labels, a, b):
            while True:
                la, lb = labels[a], labels[b]
                low, high = np.minimum(la, lb), np.maximum(la, lb)
                if not (differ := low < high).any():
                    return labels
                np.minimum.at(labels, high[differ], low[differ])
                while not np.array_equal(labels, nxt := labels[labels]):
                    labels = nxt

        def compare(home, labels, guests):
            """Links between home and guests; labels of home are merged."""
            found = []
            step = max(1, BLOCK // max(1, len(home)))
            for k in range(0, len(guests), step):
                g = guests[k:k + step]
                j, i = np.nonzero(np.bitwise_count((g[:, None] ^ home[None, :]).view(np.uint64)) <= radius)
                if len(j):
                    same = j[1:] == j[:-1]
                    labels = merge(labels, i[:-1][same], i[1:][same])
                    first = np.concatenate(([True], ~same))
                    found.append((g[j[first]], home[i[first]]))
            return labels, found

        def out(pairs):
            a = np.concatenate([p[0] for p in pairs])
            b = np.concatenate([p[1] for p in pairs])
            keep = a != b
            return pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

        key = home = labels = None
        waiting, n, pairs, n_pairs = [], 0, [], 0

        def flush():
            nonlocal labels, waiting, n, n_pairs
            if waiting:
                labels, found = compare(home, labels, np.concatenate(waiting))
                pairs.extend(found)
                n_pairs += sum(len(p[0]) for p in found)
                waiting, n = [], 0

        for b in batches:
            homes, parts, own = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            lists = b.column(3)
            values, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for r in range(b.num_rows):
                here = values[at[r]:at[r + 1]]
                if (homes[r], parts[r]) != key:
                    flush()
                    if home is not None:
                        pairs.append((home, home[labels]))
                        n_pairs += len(home)
                    key = (homes[r], parts[r])
                    home = here if own[r] else here[:0]  # the home tile comes first, if there is one
                    labels = np.arange(len(home))
                if not len(home):
                    continue
                waiting.append(here)
                n += len(here)
                if n >= 1 << 16:
                    flush()
            if n_pairs > 1 << 16:
                yield out(pairs)
                pairs, n_pairs = [], 0
        flush()
        if home is not None:
            pairs.append((home, home[labels]))
        if pairs:
            yield out(pairs)

    dealt = (visits.repartition("home", "home_part")
             .sortWithinPartitions("home", "home_part", F.desc("own")))
    return map_arrow(dealt, run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component): the fingerprint of every row and the smallest id
    reachable over links of at most ``radius`` differing bits."""
    fps = written(fingerprints(docs, shingle, id_col, text_col))
    total = fps.count()
    spark = docs.sparkSession
    distinct = written(fps.groupBy("fp").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")))
    comp = settled(spark, lambda: components(links(distinct.select("fp"), radius)))
    rooted = distinct.join(comp, distinct["fp"] == comp["node"], "left").select(
        "fp", "n", "low", F.coalesce("root", "fp").alias("root"))
    roots = rooted.groupBy("root").agg(F.min("low").alias("component"), F.count(F.lit(1)).alias("n_root"))
    classes = lookup(rooted.drop("low"), roots, ["root"], "n_root", distinct.count(), "inner").drop("root")
    return lookup(fps, written(classes), ["fp"], "n", total, "inner")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    from .common import table
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))
