"""Hard-negative mining (operator 11): cover trees over norm-augmented vectors.

Every candidate gets one more component that brings all norms of a tree to the
same length M; with a zero there for the anchor q, the distance to a candidate
x is |q|^2 + M^2 - 2 q.x, so near means a high inner product.  A tree's nodes
have a centre, which is one of their points, and a covering radius, the largest
distance from it to a point below.  Centre and radius bound the inner products
below a node from both sides.  An anchor descends best-first, by the highest
score a node could give, and skips nodes whose bounds miss all its windows or
lie below the tenth best found; the points of a leaf are verified exactly.

Candidates are dealt by row over shards of at most ``SHARD_ROWS``, each with a
tree of its own, written once.  Anchors are dealt over groups of at most
``GROUP_ROWS``; every (shard, group) is one small task, in which both are
present.  So no task holds more than a shard and a group, whatever vector or
label is frequent, and no row is left out.  Two passes: the best positives of
each anchor, whose scores set the windows, then the best negatives in each
window; both merge the shards' answers by a partial top-k.

Arithmetic: components are integers and inner products are exact, in double
precision where that is exact and in Python integers elsewhere; they must fit a
long.  Bounds are widened by more than their rounding error.

Defined results: rows with a null id, label or vector, or a null or non-finite
component, take no part; a vector shorter than another is filled up with
zeros; equal scores are ordered by the id; rows of one id are rows of their
own, and each of them that is an anchor gives its own results; a window that
no score can meet (a negative positive score) gives none; empty tables give no
rows; other columns, whatever their names, are ignored."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import narrowed, table, written

#: Most rows of a tree and of a group of anchors, about: what a task holds of each.
SHARD_ROWS, GROUP_ROWS = 1 << 18, 1 << 16
#: Smaller tables have smaller trees, so that tasks are many: at least the first number of trees and, up to the
#: second, one for so many rows.
TREES, TREE_ROWS = (16, 256), 1 << 14
#: Most points of a leaf (but equal points, which no radius tells apart), children of a node, and the ratio of
#: the radii of two levels.
LEAF, CHILDREN, BASE = 256, 64, 1.5
#: Beyond every score.
FAR = (1 << 63) - 1


def matrix(vectors, width: int):
    """Lists of integers (an Arrow array) as the rows of one array, filled up
    with zeros or cut to ``width``."""
    import numpy as np

    size = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), width), np.int64)
    row = np.repeat(np.arange(len(vectors)), size)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out[row[column < width], column[column < width]] = flat[column < width]
    return out


def products(points, q):
    """Inner products of the rows of ``points`` with q, exact: in floating
    point if all sums are integers below 2^53, otherwise in Python integers."""
    import numpy as np

    if points.dtype == np.float64 and q.dtype == np.float64:
        return (points @ q).astype(np.int64)
    return (points.astype(np.int64).astype(object) @ q.astype(np.int64).astype(object)).astype(np.int64)


def light(points):
    """``points`` as floating point if products of two such rows are exact."""
    import numpy as np

    most = float(np.abs(points.astype(np.float64)).max(initial=0.0))
    return points.astype(np.float64) if most * most * max(1, points.shape[-1]) < 2.0 ** 53 else points


class CoverTree:
    """Points in the order of the leaves, and per node: centre (place of its
    point), radius, first and last child or first and last point."""

    def __init__(self, points, centre, radius, child, span, top):
        self.points, self.centre, self.radius, self.child, self.span, self.top = points, centre, radius, child, span, top
        self.centres = points[centre]

    @classmethod
    def build(cls, points):
        """(tree, order of the points in it).  A node's children are found
        farthest-first: its own centre, then the point farthest from all
        centres so far, while that is beyond the next level's radius; every
        point goes to its nearest centre."""
        import numpy as np

        points = light(points)
        x = points.astype(np.float64)
        square = np.einsum("ij,ij->i", x, x)
        top = float(square.max(initial=0.0))
        x = np.column_stack((x, np.sqrt(np.maximum(top - square, 0.0))))

        def distances(members, to):
            gap = x[members] - x[to]
            return np.sqrt(np.einsum("ij,ij->i", gap, gap))

        everyone = np.arange(len(x))
        far = distances(everyone, 0)
        nodes, order = [(0, float(far.max(initial=0.0)), everyone, far)], []
        centre, radius, child, span = [], [], [], []
        k = placed = 0
        while k < len(nodes):  # breadth first: the children of a node follow each other
            at, reach, members, far = nodes[k]
            nodes[k] = None
            k += 1
            centre.append(at)
            radius.append(reach)
            if len(members) <= LEAF or reach == 0.0:
                child.append((0, 0))
                span.append((placed, placed + len(members)))
                order.append(members)
                placed += len(members)
                continue
            owner, near, centres = np.zeros(len(members), np.int64), far, [at]
            while len(centres) < CHILDREN and near.max() > reach / BASE:
                centres.append(int(members[near.argmax()]))
                d = distances(members, centres[-1])
                closer = d < near
                owner[closer], near = len(centres) - 1, np.where(closer, d, near)
            child.append((len(nodes), len(nodes) + len(centres)))
            span.append((0, 0))
            for n, c in enumerate(centres):
                mine = owner == n
                nodes.append((c, float(near[mine].max(initial=0.0)), members[mine], near[mine]))
        order = np.concatenate(order) if order else everyone
        place = np.empty(len(x), np.int64)
        place[order] = everyone
        return cls(points[order], place[np.array(centre, np.int64)], np.array(radius), np.array(child, np.int64),
                   np.array(span, np.int64), top), order

    def descend(self, q, wanted, take) -> None:
        """Visit the nodes that may hold what is wanted, most worth first.
        ``wanted(low, high)`` says what scores between such bounds are worth
        by now (None: nothing); ``take(first, scores)`` gets the exact scores
        of a leaf's points."""
        from heapq import heappop, heappush

        import numpy as np

        x = q.astype(np.float64)
        base = float(x @ x) + self.top
        slack = 1e-9 * base + 1e-3
        agenda: list = []

        def offer(first, last):
            reach = self.radius[first:last]
            d = np.sqrt(np.maximum(base - 2.0 * products(self.centres[first:last], q), 0.0))
            above = (base - np.maximum(d - reach, 0.0) ** 2) / 2 + slack
            below = (base - (d + reach) ** 2) / 2 - slack
            for n, (low, high) in enumerate(zip(below.tolist(), above.tolist())):
                if (worth := wanted(low, high)) is not None:
                    heappush(agenda, (-worth, first + n, low, high))

        offer(0, 1)
        while agenda:
            _, k, low, high = heappop(agenda)
            if wanted(low, high) is None:
                continue
            if self.child[k, 1]:
                offer(*self.child[k].tolist())
            else:
                first, last = self.span[k].tolist()
                take(first, products(self.points[first:last], q))


class Best:
    """The first ``k`` of the offered (score, id) with a score in [low, high]."""

    def __init__(self, low, high, k: int):
        import numpy as np

        self.low, self.high, self.k = low, high, k
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores, ids) -> None:
        import numpy as np

        at = (scores >= self.low) & (scores <= self.high)
        if not at.any():
            return
        scores, ids = np.concatenate((self.scores, scores[at])), np.concatenate((self.ids, ids[at]))
        first = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[first], ids[first]
        if len(first) == self.k:
            self.low = int(self.scores[-1])  # an equal score may have a smaller id


def search(tree, rows, ids, labels, q, own_row: int, own_label: int, windows, k: int, same: bool):
    """The best ``k`` points of each window (low, high): points of the
    anchor's label but its own row (``same``), or points of other labels."""
    import numpy as np

    found, top = [Best(low, high, k) for low, high in windows], max(high for _, high in windows)

    def wanted(low, high):
        return max((min(high, w.high) for w in found if high >= w.low and low <= w.high), default=None)

    def take(first, scores):
        at = np.flatnonzero((scores >= min(w.low for w in found)) & (scores <= top))
        if not len(at):
            return
        place = first + at
        alike = labels[place] == own_label
        allowed = alike & (rows[place] != own_row) if same else ~alike
        scores, near = scores[at[allowed]], ids[place[allowed]]
        for w in found:
            w.add(scores, near)

    tree.descend(q, wanted, take)
    return found


def packed(array) -> bytes:
    import io

    import numpy as np

    out = io.BytesIO()
    np.save(out, array, allow_pickle=False)
    return out.getvalue()


def unpacked(data: bytes):
    import io

    import numpy as np

    return np.load(io.BytesIO(data), allow_pickle=False)


TREE = "shard int, n long, top double, names array<string>, " + ", ".join(
    f"{p} binary" for p in ("rows", "ids", "labels", "points", "centre", "radius", "child", "span"))


def plant(shard):
    """One row with the tree of a shard's rows (shard, row, id, label, v)."""
    import numpy as np
    import pyarrow as pa

    vectors = shard["v"].combine_chunks()
    tree, order = CoverTree.build(matrix(vectors, max(vectors.value_lengths().to_pylist())))
    coded = shard["label"].combine_chunks().dictionary_encode()
    arrays = {"rows": shard["row"].to_numpy()[order], "ids": shard["id"].to_numpy()[order],
              "labels": coded.indices.to_numpy(zero_copy_only=False)[order], "points": tree.points,
              "centre": tree.centre, "radius": tree.radius, "child": tree.child, "span": tree.span}
    return pa.table({"shard": pa.array([shard["shard"][0].as_py()], pa.int32()), "n": pa.array([len(order)], pa.int64()),
                     "top": [tree.top], "names": [coded.dictionary.to_pylist()],
                     **{k: pa.array([packed(np.ascontiguousarray(v))], pa.binary()) for k, v in arrays.items()}})


def forest(vectors: DataFrame, shards: int) -> DataFrame:
    """A tree per shard of ``vectors`` (row, id, label, v), written."""
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    return written(dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(plant, TREE))


def best_in_windows(trees: DataFrame, shards: int, anchors: DataFrame, groups: int, k: int, same: bool) -> DataFrame:
    """(row, low, high, rank, score, id): the best ``k`` of each window of
    ``anchors`` (row, label, v, windows) over all shards."""
    left = trees.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = (anchors.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))

    def visit(planted, group):
        import pyarrow as pa

        out: dict[str, list] = {c: [] for c in ("row", "low", "high", "score", "id")}
        if planted.num_rows and group.num_rows:
            t = planted.to_pylist()[0]
            tree = CoverTree(*(unpacked(t[c]) for c in ("points", "centre", "radius", "child", "span")), t["top"])
            rows, ids, labels = (unpacked(t[c]) for c in ("rows", "ids", "labels"))
            code = {name: n for n, name in enumerate(t["names"])}
            queries = light(matrix(group["v"].combine_chunks(), tree.points.shape[1]))
            for q, own, label, windows in zip(queries, group["row"].to_pylist(), group["label"].to_pylist(),
                                              group["windows"].to_pylist()):
                windows = [(w["low"], w["high"]) for w in windows]
                for w, best in zip(windows, search(tree, rows, ids, labels, q, own, code.get(label, -1), windows, k, same)):
                    n = len(best.ids)
                    for c, values in (("row", [own] * n), ("low", [w[0]] * n), ("high", [w[1]] * n),
                                      ("score", best.scores.tolist()), ("id", best.ids.tolist())):
                        out[c].extend(values)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    tasks, key = shards * groups, ["shard", "grp"]
    answers = (left.repartition(tasks, *key).groupBy(*key).cogroup(right.repartition(tasks, *key).groupBy(*key))
               .applyInArrow(visit, "row long, low long, high long, score long, id long"))
    order = W.partitionBy("row", "low", "high").orderBy(F.desc("score"), "id")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hundredths(a: Column, b: int) -> Column:
    """a * b / 100, rounded down, in longs: a * b itself may not fit one."""
    rest = F.pmod(a, F.lit(100))
    below = F.call_function("div", b * rest - F.pmod(b * rest, F.lit(100)), F.lit(100))
    return b * F.call_function("div", a - rest, F.lit(100)) + below


def hard_negatives(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, is_anchor, positives: int = 5,
                   negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each anchor (``is_anchor`` of the id column) and each
    of its first ``positives`` rows of the same label, the first ``negatives``
    rows of other labels that score between ``low`` and ``high`` hundredths of
    the positive.  Components count as floor(scale * component)."""
    src = narrowed(vectors, id_col, label_col, vector_col).toDF("id", "label", "x")
    finite = F.forall("x", lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    src = src.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    rows = written(src.select(
        F.monotonically_increasing_id().alias("row"), F.col("id").cast("long").alias("id"),
        F.col("label").cast("string").alias("label"), is_anchor(F.col("id")).alias("is_anchor"),
        F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("v")))
    total, asked = rows.agg(F.count("*"), F.count_if("is_anchor")).first()
    few, many = TREES
    shards = max(-(-total // SHARD_ROWS), min(many, max(few, -(-total // TREE_ROWS))))
    groups = max(1, -(-asked // GROUP_ROWS))
    trees = forest(rows.drop("is_anchor"), shards)
    anchors = rows.where("is_anchor").select("row", "id", "label", "v")

    everything = F.array(F.struct(F.lit(-FAR).alias("low"), F.lit(FAR).alias("high")))
    near = best_in_windows(trees, shards, anchors.drop("id").withColumn("windows", everything), groups, positives, True)
    score = F.col("positive_score")
    near = written(near.select("row", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
                   .withColumns({"low": -hundredths(-score, low), "high": hundredths(score, high)})
                   .where(F.col("low") <= F.col("high")))
    windows = near.groupBy("row").agg(F.collect_set(F.struct("low", "high")).alias("windows"))  # at most ``positives``
    far = best_in_windows(trees, shards, anchors.drop("id").join(windows, "row"), groups, negatives, False)
    far = far.select("row", "low", "high", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (near.join(far, ["row", "low", "high"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives(rows, "vec_id", "label", "embedding", lambda i: i % 100 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 10
"""
