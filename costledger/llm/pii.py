"""Personal data by candidate gradient boosting (operator 4).

Generators with high recall propose spans, which may overlap.  The base
generators are the plain patterns of the four kinds; those of their spans that
pass the kind's check always stay.  The others propose what the plain patterns
miss: numbers that a neighbour runs into, national phone formats, card numbers
grouped by other signs, addresses written out, encoded or defanged, IPv6.  Boosted trees score each proposal by its format and context, and a
threshold per kind, calibrated on a held-out fold, selects what is added.

There are no labels of personal data, so the trees learn from proposals whose
own check (check digit, octets, numbering plan, domain) says what they are; the
features leave that check out.  Features are few-valued, so all proposals of
the corpus reduce to a histogram of feature values, from which the trees are
fitted exactly.  Copies of a proposal count once in it.

Everything that touches rows is DataFrame functions.  Defined results: a null
text is an empty text; every row comes out once, repeated rows too; a null id
is carried and belongs to the training fold; an empty table gives no rows;
other columns are ignored; of a long text a row holds its matches and what is
next to them, never copies of the text."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import free_name, identified, placed, rows_of, written

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns: generator -> (kind, pattern).  The first four are the base
#: patterns, written so that a failing attempt costs no second look at a run.
GENERATORS = {
    "email": ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": ("card", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    "email_words": ("email", r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{1,63}){1,8}"),
    "ip_hex": ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "card_run": ("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    "card_groups": ("card", r"(?<![0-9])(?:[0-9]{4}[\x20.-]){3}[0-9]{1,7}(?![0-9])"),
    "phone_plus": ("phone", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])"),
    "phone_local": ("phone", r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])"),
    "phone_pairs": ("phone", r"(?<![0-9+.,/-])0[1-9](?:[\x20.-][0-9]{2}){4}(?![0-9]|[.,/-][0-9])"),
    "phone_area": ("phone", r"(?<![0-9+.,/-])\(?0[1-9][0-9]{0,3}\)?[\x20/-][0-9]{3,4}[\x20-]?[0-9]{3,5}(?![0-9]|[.,/-][0-9])"),
    "email_said": ("email", r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20at\x20[A-Za-z0-9-]{1,63}(?:\x20dot\x20[A-Za-z0-9-]{2,63}){1,4}"),
    "email_signs": ("email", r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._+-]{1,64}(?:\x20@\x20|&#64;|&commat;|%40)[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"),
    "ip_defanged": ("ip", r"(?i)(?<![0-9])[0-9]{1,3}(?:[\[(](?:\.|dot)[\])][0-9]{1,3}){3}(?![0-9])"),
    "ip_short": ("ip", r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}(?![0-9A-Za-z:])"),
    "card_signs": ("card", r"(?<![0-9])(?:[0-9]{4}[._/\xA0]){3}[0-9]{4}(?![0-9])"),
    "card_short": ("card", r"(?<![0-9])3[47][0-9]{2}[\x20._/-][0-9]{6}[\x20._/-][0-9]{5}(?![0-9])"),
}
#: What a text must contain for a generator to be tried at all: a string or a pattern.
NEEDS = {"email": "@", "phone": "+", "phone_plus": "+", "ip": ".", "ip_hex": ":", "ip_short": "::"}
NEEDS_LIKE = {"email_words": r"(?i)[\[(]at[\])]", "email_said": r"(?i)\x20dot\x20", "email_signs": r"(?i)\x20@\x20|&#64;|&commat;|%40",
              "ip_defanged": r"(?i)[0-9][\[(](?:\.|dot)[\])][0-9]"}
#: Words that announce a kind.
ANNOUNCE = {"email": "mail", "ip": r"\bip\b|addr|host", "card": "card|visa|credit|pay", "phone": "phone|tel|call|mobile|fax"}
CONTEXT = 24
#: Trees, their depth and step, least weight of a leaf, and the precision that
#: a threshold must reach on the held-out fold.
TREES, DEPTH, STEP, LEAST, PRECISION, FOLDS = 30, 3, 0.3, 1.0, 0.95, 5
#: Held-out proposals that a threshold rests on at least, in kinds that have so many.
ENOUGH = 20


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, id, generator, span_start, span_end, match, before, after): all
    proposals, in code points; a row without any has one with nulls.
    ``before`` and ``after`` reach to the neighbouring match."""
    digits = rows_of(docs, id_col, text_col).withColumn("_digit", F.col("text").rlike("[0-9]"))
    found = []
    for name, (kind, pattern) in GENERATORS.items():
        ready = F.col("text").contains(NEEDS[name]) if name in NEEDS else F.lit(True)
        ready = F.col("text").rlike(NEEDS_LIKE[name]) if name in NEEDS_LIKE else ready
        ready = ready & (F.col("_digit") if kind != "email" and name != "ip_hex" else F.lit(True))
        found.append(F.when(ready, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias(f"m_{name}"))
        # Of what lies between matches, its length and ends; the text itself is not kept in the row.
        found.append(F.when(ready, F.transform(F.split("text", pattern, -1), lambda p: F.struct(
            F.length(p).alias("n"), F.left(p, F.lit(CONTEXT)).alias("head"), F.right(p, F.lit(CONTEXT)).alias("tail")))).alias(f"s_{name}"))
    parts = digits.select("rid", "id", *found)

    def spans(name):
        pieces = F.col(f"s_{name}")

        def one(m, i):
            left, right = F.get(pieces, i), F.get(pieces, i + 1)
            return F.struct(F.lit(name).alias("generator"), i.alias("i"), m.alias("match"), left["n"].alias("gap"),
                            left["tail"].alias("before"), right["head"].alias("after"))

        return F.coalesce(F.transform(F.col(f"m_{name}"), one), F.array().cast(
            "array<struct<generator:string,i:int,match:string,gap:int,before:string,after:string>>"))

    rows = (parts.select("rid", "id", F.concat(*[spans(n) for n in GENERATORS]).alias("all"))
            .select("rid", "id", F.explode_outer("all").alias("c")).select("rid", "id", "c.*"))
    # A span starts after all gaps up to it and all matches before it.
    so_far = W.partitionBy("rid", "generator").orderBy("i")
    end = F.sum(F.col("gap") + F.length("match")).over(so_far).cast("int")
    return rows.withColumn("span_end", end).withColumn("span_start", F.col("span_end") - F.length("match")).drop("i", "gap")


def _digits() -> Column:
    return F.regexp_replace("match", "[^0-9]", "")


def kind_of() -> Column:
    out = F.lit(None).cast("string")
    for name, (kind, _) in GENERATORS.items():
        out = F.when(F.col("generator") == name, F.lit(kind)).otherwise(out)
    return out


def base_check() -> Column:
    """Whether a span of a base generator passes its kind's check."""
    n = F.length(_digits())
    octets = F.transform(F.split("match", r"\."), lambda o: F.regexp_replace(o, "^0+(?=[0-9])", ""))
    ok_octets = F.forall(octets, lambda o: (F.length(o) <= 3) & (F.try_to_number(o, F.lit("999")) <= 255))
    g = F.col("generator")
    return F.coalesce(
        F.when(g == "email", F.lit(True)).when(g == "ip", ok_octets)
        .when(g == "card", n.between(12, 19) & F.call_function("luhn_check", _digits()))
        .when(g == "phone", n.between(9, 15)), F.lit(False))


def own_check() -> Column:
    """What a proposal's own content says of it, for training only: the form
    of a domain, octets, the check digit, and for phones the plan of +1, else
    a country code or a trunk 0 before a number of a possible length."""
    d, g, k = _digits(), F.col("generator"), F.col("kind")
    domain = F.lower(F.regexp_extract("match", r"([A-Za-z0-9-]+)$", 1))
    plan = (F.when(g.isin("phone_pairs", "phone_area"), d.rlike("^0[1-9][0-9]{7,9}$"))
            .when((g == "phone_local") | d.startswith("1"), d.rlike("^1?[2-9][0-9]{2}[2-9][0-9]{6}$"))
            .otherwise(d.rlike("^[2-9][0-9]{8,14}$")))
    octets = F.forall(F.split("match", "[.:]"), lambda o: F.length(o) <= 4)
    numbers = F.forall(F.split("match", "[^0-9]+"), lambda o: (o == "") | (o.try_cast("int") <= 255))
    groups = F.size(F.filter(F.split("match", ":"), lambda o: o != ""))
    return F.coalesce(
        F.when(k == "email", domain.rlike("^[a-z]{2,12}$"))
        .when(g == "ip_defanged", numbers).when(g == "ip_short", groups.between(3, 7) & (F.length(d) > 0))
        .when(k == "ip", octets & (base_check() | (g == "ip_hex")))
        .when(k == "card", F.length(d).between(13, 19) & F.call_function("luhn_check", d))
        .when(k == "phone", plan), F.lit(False))


def _side(text: Column) -> Column:
    """Kind of the neighbouring sign."""
    return (F.when(F.length(text) == 0, F.lit(0)).when(text.rlike(r"\s"), F.lit(1)).when(text.rlike("[0-9]"), F.lit(2))
            .when(text.rlike(r"[\p{L}]"), F.lit(3)).when(text.rlike("[-.+_@:/]"), F.lit(4)).otherwise(F.lit(5)))


def features() -> list[Column]:
    """Few-valued numbers that describe a proposal and what is around it."""
    n = F.length(_digits())
    announced = F.lit(0)
    for kind, words in ANNOUNCE.items():
        announced = F.when((F.col("kind") == kind) & F.lower("before").rlike(words), F.lit(1)).otherwise(announced)
    kind = F.lit(0)
    for k, name in enumerate(KINDS):
        kind = F.when(F.col("kind") == name, F.lit(k)).otherwise(kind)
    maker = F.lit(0)
    for k, name in enumerate(GENERATORS):
        maker = F.when(F.col("generator") == name, F.lit(k)).otherwise(maker)
    signs = F.length(F.regexp_replace("match", "[0-9A-Za-z]", ""))
    out = {"kind": kind, "maker": maker, "left": _side(F.right("before", F.lit(1))), "right": _side(F.left("after", F.lit(1))),
           "digits": F.floor(F.least(n, F.lit(24)) / 2).cast("int"), "signs": F.least(signs, F.lit(7)), "announced": announced,
           "round": F.col("match").contains("(").cast("int"), "lead": F.coalesce(F.left(_digits(), F.lit(1)).try_cast("int"), F.lit(-1)),
           "repeats": _digits().rlike(r"([0-9])\1{4}").cast("int")}
    return [v.alias(f"f_{k}") for k, v in out.items()]


F_NAMES = ["f_kind", "f_maker", "f_left", "f_right", "f_digits", "f_signs", "f_announced", "f_round", "f_lead", "f_repeats"]


def boost(table: list[tuple[tuple[int, ...], int, int]]) -> list[tuple]:
    """Gradient-boosted trees (logistic loss) from a histogram: (feature
    values, positives, negatives).  A tree is (feature, value, left, right)
    for ``feature <= value``, or a leaf's score."""
    rows = [(f, p, n) for f, p, n in table if p + n]
    score = [0.0] * len(rows)
    trees = []

    def grow(members, grad, hess, depth):
        g, h = sum(grad[k] for k in members), sum(hess[k] for k in members)
        leaf = STEP * g / (h + 1.0)
        if depth == 0:
            return leaf
        best = (1e-6, None)
        for f in range(len(F_NAMES)):
            sums: dict[int, list[float]] = {}
            for k in members:
                s = sums.setdefault(rows[k][0][f], [0.0, 0.0])
                s[0] += grad[k]
                s[1] += hess[k]
            gl = hl = 0.0
            for value in sorted(sums)[:-1]:
                gl, hl = gl + sums[value][0], hl + sums[value][1]
                if min(hl, h - hl) < LEAST * 0.01:
                    continue
                gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                if gain > best[0]:
                    best = (gain, (f, value))
        if best[1] is None:
            return leaf
        f, value = best[1]
        return (f, value, grow([k for k in members if rows[k][0][f] <= value], grad, hess, depth - 1),
                grow([k for k in members if rows[k][0][f] > value], grad, hess, depth - 1))

    for _ in range(TREES if rows else 0):
        grad, hess = [], []
        for (_, p, n), s in zip(rows, score, strict=True):
            q = 1 / (1 + math.exp(-s))
            grad.append(p * (1 - q) - n * q)
            hess.append((p + n) * q * (1 - q))
        tree = grow(range(len(rows)), grad, hess, DEPTH)
        trees.append(tree)
        score = [s + value_of(tree, f) for s, (f, _, _) in zip(score, rows, strict=True)]
    return trees


def value_of(tree, f) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if f[tree[0]] <= tree[1] else tree[3]
    return tree


def score_column(trees: list) -> Column:
    def column(tree):
        if not isinstance(tree, tuple):
            return F.lit(float(tree))
        return F.when(F.col(F_NAMES[tree[0]]) <= tree[1], column(tree[2])).otherwise(column(tree[3]))

    out = F.lit(0.0)
    for tree in trees:
        out = out + column(tree)
    return out


def thresholds(trees: list, held: list[tuple[tuple[int, ...], int, int]]) -> dict[int, float]:
    """Per kind, the least score down to which the held-out proposals that can
    be added together reach PRECISION; those of that score reach it, too.  Few
    bad ones at a high score don't end the search; a kind without such a score
    adds nothing."""
    out = {}
    for kind in range(len(KINDS)):
        by: dict[float, list[int]] = {}
        for f, p, n in held:
            if f[0] == kind and f[1] >= len(KINDS):  # the base generators add nothing
                s = by.setdefault(sum(value_of(t, f) for t in trees), [0, 0])
                s[0] += p
                s[1] += n
        enough = ENOUGH if sum(map(sum, by.values())) >= ENOUGH else 1
        good = total = 0
        for s in sorted(by, reverse=True):
            good, total = good + by[s][0], total + sum(by[s])
            if total >= enough and good >= PRECISION * total and by[s][0] >= PRECISION * sum(by[s]):
                out[kind] = s
    return out


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, id, kind, span_start, span_end, base): every span; a row of
    ``docs`` without any has one row with nulls."""
    found = candidates(docs, id_col, text_col).withColumn("kind", kind_of())
    fold = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    rows = written(found.select("rid", "id", "kind", "span_start", "span_end",
                                F.col("generator").isin(list(KINDS)).alias("plain"),
                                (base_check() & F.col("generator").isin(list(KINDS))).alias("base"),
                                F.xxhash64("match").alias("what"), own_check().alias("own"), fold.alias("held"), *features()))
    # A row per combination of few-valued features, however many proposals there are.
    table = (rows.where(F.col("kind").isNotNull()).select("held", *F_NAMES, "what", "own").distinct().groupBy("held", *F_NAMES)
             .agg(F.sum(F.col("own").cast("long")).alias("p"), F.sum((~F.col("own")).cast("long")).alias("n")).collect())
    split = {held: sorted((tuple(r[f] for f in F_NAMES), r["p"], r["n"]) for r in table if r["held"] == held)
             for held in (True, False)}
    trees = boost(split[False])
    least = F.lit(None).cast("double")
    for kind, s in thresholds(trees, split[True]).items():
        least = F.when(F.col("f_kind") == kind, F.lit(s)).otherwise(least)
    # A plain match that fails its check stays dropped: it only teaches the trees.
    judged = rows.withColumn("added", F.coalesce(~F.col("plain") & (score_column(trees) >= least - 1e-9), F.lit(False)))
    # An added span gives way to a base span of its kind that it overlaps, and
    # to a longer added one (of equal ones, the first).
    near = W.partitionBy("rid", "kind")
    spans = judged.where("base or added").select("rid", "id", "kind", "span_start", "span_end", "base").dropDuplicates(
        ["rid", "kind", "span_start", "span_end", "base"])
    before = near.orderBy("span_start", "span_end").rowsBetween(W.unboundedPreceding, -1)
    after = near.orderBy("span_start", "span_end").rowsBetween(1, W.unboundedFollowing)
    reach = F.max(F.when(F.col("base"), F.col("span_end")))
    opens = F.min(F.when(F.col("base"), F.col("span_start")))
    clear = spans.withColumn("_end", reach.over(before)).withColumn("_start", opens.over(after)).where(
        F.col("base") | (F.coalesce(F.col("_end") <= F.col("span_start"), F.lit(True))
                         & F.coalesce(F.col("_start") >= F.col("span_end"), F.lit(True)))).drop("_end", "_start")
    inside = F.max("span_end").over(near.orderBy("span_start", F.desc("span_end"), F.desc("base")).rowsBetween(W.unboundedPreceding, -1))
    kept = clear.withColumn("_in", inside).where(
        F.col("base") | F.col("_in").isNull() | (F.col("_in") < F.col("span_end"))).drop("_in")
    # Every row of the input comes out.
    alone = rows.groupBy("rid").agg(F.first("id").alias("id"))
    return alone.join(kept.drop("id"), "rid", "left")


def spans_text(only: Column) -> Column:
    """kind:start:end of the spans for which ``only`` holds, by start and
    then kind, comma-joined."""
    rank = F.lit(0)
    for k, name in enumerate(KINDS):
        rank = F.when(F.col("kind") == name, F.lit(k)).otherwise(rank)
    item = F.when(only & F.col("kind").isNotNull(), F.struct("span_start", rank.alias("r"), "span_end", "kind"))
    return F.concat_ws(",", F.transform(F.array_sort(F.collect_list(item)), lambda s: F.concat_ws(
        ":", s["kind"], s["span_start"].cast("string"), s["span_end"].cast("string"))))


def summary(found: DataFrame) -> DataFrame:
    """(rid, id, n_<kind>, base_spans, spans) per row of the input."""
    base = F.coalesce(F.col("base"), F.lit(False))
    return found.groupBy("rid").agg(
        F.first("id").alias("id"),
        *[F.sum((base & (F.col("kind") == k)).cast("long")).alias(f"n_{k}") for k in KINDS],
        spans_text(base).alias("base_spans"), spans_text(F.lit(True)).alias("spans")).na.fill(0, [f"n_{k}" for k in KINDS])


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets;
    overlapping spans become one, named after the first."""
    docs = placed(docs)
    mark, list_of = free_name(docs, "_rid"), free_name(docs, "_spans")
    found = find(docs, id_col, text_col).where(F.col("kind").isNotNull()).groupBy(F.col("rid").alias(mark)).agg(
        F.array_sort(F.collect_list(F.struct("span_start", "span_end", "kind"))).alias(list_of))
    text = F.col(f"`{text_col}`")
    done = F.aggregate(
        list_of, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.when(s["span_start"] < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], s["span_end"]).alias("at")))
        .otherwise(F.struct(F.concat(a["out"], F.substring(text, a["at"] + 1, s["span_start"] - a["at"]),
                                     F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"), s["span_end"].alias("at"))),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    marked = identified(docs, mark).join(found, mark, "left")
    return marked.withColumn(text_col, F.when(F.col(list_of).isNull(), text).otherwise(done)).select(*docs.columns)


def op4_personal_data(spark, sf_dir: str) -> DataFrame:
    from .common import table
    return summary(find(table(spark, sf_dir, "documents"))).select(
        F.col("id").alias("doc_id"), *[f"n_{k}" for k in KINDS],
        F.sha2("base_spans", 256).alias("base_sha256"), "spans")
