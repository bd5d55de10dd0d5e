"""Language identification by nearest centroid (operator 3).

A text becomes a TF-IDF vector over hashed byte 2- and 3-grams of its
lower-cased letters (1 + log of the count, times the inverse document
frequency, scaled to length 1).  Each language has several centroids, clustered
by cosine; a text gets the language of the nearest one.  It is rejected when it
is farther from every centroid than texts of its length in the training sample
ever are.

The classifier is fitted on a bounded sample of labelled rows: about SAMPLE for
each of the LANGUAGES languages with most rows (ties: the lesser name), picked
by a hash of the id and the row's place in its file, so that an id on many rows
is no more likely than others.  Every text is predicted whole; one of more than
a slice is counted in steps.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and rejected; without any labelled row every text is ``und`` with score 0 and
only letterless ones are rejected; of centroids equally near, the one whose
language's name is the least wins; a text with fewer n-grams than any in the
sample's shortest length class is not judged by distance; a null id is neither
held out nor learned from; a language beyond LANGUAGES is not learned, its rows
are predicted like others; repeated rows get equal results; other columns are
ignored."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import own_copies
from .common import identified, map_arrow, placed, rows_of, slices, without, written
from .decontam import flat_texts

#: Labelled rows of each language that the classifier is fitted on, about.
SAMPLE = 1500
#: Languages that the classifier learns at most.
LANGUAGES = 400
#: Bytes and rows of texts that are turned into vectors at once.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 512
#: Hashed n-grams, centroids of a language, and folds of which 0 is held out.
BUCKETS, CENTROIDS, FOLDS = 4096, 4, 5
#: Share of the sample that lies below the similarity of its length class, and
#: the part of that similarity below which a text is rejected.
TAIL, MARGIN = 0.002, 0.9


#: Lengths of n-grams and what spreads them over the buckets.
GRAMS = ((2, 0x9E3779B1), (3, 0x85EBCA6B))


def _letters(data):
    return ((data >= 0x61) & (data <= 0x7A)) | (data >= 0x80)


def long_counts(data, step: int = SLICE_BYTES):
    """The counts of one text's lower-cased bytes, ``step`` bytes at a time:
    what ``vectors`` gives for it."""
    import numpy as np

    counts = np.zeros(BUCKETS, np.int64)
    tail = np.array([0x20], np.int64)  # the last signs so far; a text begins with a space
    for at in range(0, len(data) + 1, step):
        part = data[at:at + step]
        if at + step > len(data):  # and ends with one
            part = np.append(part, np.uint8(0x20))
        letter = _letters(part)
        keep = letter.copy()
        keep[0] |= tail[-1] != 0x20
        keep[1:] |= letter[:-1]
        signs = np.concatenate((tail, np.where(letter, part, 0x20)[keep]))
        for n, salt in GRAMS:
            first, m = max(0, len(tail) - n + 1), len(signs) - n + 1
            if m > first:
                gram = signs[first:m].copy()
                for k in range(1, n):
                    gram = gram << 8 | signs[first + k:m + k]
                counts += np.bincount((gram * salt >> 13) & (BUCKETS - 1), minlength=BUCKETS)
        tail = signs[-2:]
    return counts


def vectors(column):
    """(counts, one row per text; whether each has a letter) of an Arrow
    string array without nulls."""
    import numpy as np

    if len(column) == 1 and column.nbytes > 2 * SLICE_BYTES:
        data, _ = flat_texts(column)
        found = bool(((data >= 0x61) & (data <= 0x7A)).any()) or any(c.isalpha() for c in column[0].as_py())
        return long_counts(data)[None].astype(np.float32), np.array([found])
    data, offsets = flat_texts(column)
    # A space at the start and the end and between texts; then every run of
    # other signs is one space, which belongs to the texts on both sides.
    at = offsets
    data = np.insert(data, at, 0x20)
    offsets_in = at + np.arange(len(at))
    letter = _letters(data)
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    at = np.flatnonzero(keep)
    signs = np.where(letter[at], data[at], 0x20).astype(np.int64)
    owner = np.where(letter[at], np.searchsorted(offsets_in, at, "right") - 1, -1)
    counts = np.zeros((len(column), BUCKETS), np.float32)
    for n, salt in GRAMS:
        m = len(signs) - n + 1
        if m < 1:
            continue
        gram, most = signs[:m].copy(), owner[:m].copy()
        for k in range(1, n):
            gram = gram << 8 | signs[k:m + k]
            most = np.maximum(most, owner[k:m + k])
        whole = most >= 0
        for k in range(n):  # letters of two texts make no n-gram
            whole &= (owner[k:m + k] == most) | (owner[k:m + k] < 0)
        bucket = (gram[whole] * salt >> 13) & (BUCKETS - 1)
        counts += np.bincount(most[whole] * BUCKETS + bucket, minlength=counts.size).reshape(counts.shape)
    ascii_letter = np.zeros(len(column), bool)
    found = np.flatnonzero((data >= 0x61) & (data <= 0x7A))
    ascii_letter[np.searchsorted(offsets_in, found, "right") - 1] = True
    for k in np.flatnonzero(~ascii_letter & (np.diff(offsets) > 0)):
        ascii_letter[k] = any(c.isalpha() for c in column[int(k)].as_py())
    return counts, ascii_letter


def weighted(counts, idf):
    """Unit TF-IDF rows and the number of n-grams of each."""
    import numpy as np

    n = counts.sum(axis=1)
    v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32) * idf
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.maximum(norm, 1e-12), n


def _length_class(n):
    import numpy as np
    return np.log2(np.maximum(n, 1)).astype(int)


def cluster(unit, k: int = CENTROIDS, rounds: int = 12):
    """Spherical k-means of unit rows, begun at rows far from each other."""
    import numpy as np

    centre = unit.mean(axis=0)
    picked = [int((unit @ centre).argmax())]
    while len(picked) < min(k, len(unit)):
        near = (unit @ unit[picked].T).max(axis=1)
        picked.append(int(near.argmin()))
    centres = unit[picked]
    for _ in range(rounds):
        own = (unit @ centres.T).argmax(axis=1)
        sums = np.stack([unit[own == c].sum(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def fit(docs: DataFrame, **names) -> dict | None:
    """The classifier, from rows with a language outside the held-out fold:
    languages, centroids, inverse document frequencies and, per length class,
    the least similarity.  None without such rows.  What it writes on the way
    is removed."""
    with own_copies(docs.sparkSession):
        return _fitted(docs, **names)


def _fitted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            sample: int = SAMPLE, languages: int = LANGUAGES) -> dict | None:
    import numpy as np

    rows = (identified(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                                   F.col(f"`{lang_col}`").alias("lang")), "place")
            .where("id is not null and lang is not null and text is not null").where(~held_out("id")))
    most = (rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "lang").limit(languages)
            .select("lang", F.least(F.lit(1.0), sample / F.col("n")).alias("share")))
    shares = written(most)  # at most ``languages`` rows
    chance = F.pmod(F.xxhash64("id", F.substring_index("place", "-", -1)), F.lit(1 << 30))
    picked = written(rows.join(F.broadcast(shares), "lang").where(chance < F.col("share") * (1 << 30)).select("lang", "text"))

    def tables(batches):
        import pyarrow as pa

        for b in slices(batches, limit=SLICE_BYTES, rows=SLICE_ROWS):
            got, ok = vectors(b.column(1))
            got = got[ok]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).filter(pa.array(ok)), pa.array([r.astype("<f4").tobytes() for r in got], pa.binary())],
                ["lang", "counts"])

    features = written(map_arrow(picked, tables, "lang string, counts binary"))

    def frequencies(batches):
        import pyarrow as pa

        df, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for c in b.column(0).to_pylist():
                df += np.frombuffer(c, "<f4") > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS + 1), pa.int32()),
                                          pa.array(np.append(df, n), pa.int64())], ["bucket", "n"])

    sums = {r["bucket"]: r["n"] for r in map_arrow(features.select("counts"), frequencies, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # BUCKETS + 1 rows
    df = np.array([sums.get(k, 0) for k in range(BUCKETS)], np.float64)
    if not sums.get(BUCKETS):
        return None
    idf = (np.log((1 + sums[BUCKETS]) / (1 + df)) + 0.1).astype(np.float32)

    def centres(pdf):
        import pandas as pd

        got = np.stack([np.frombuffer(c, "<f4") for c in pdf["counts"]])
        return pd.DataFrame({"lang": pdf["lang"].iloc[0],
                             "centre": [c.astype("<f4").tobytes() for c in cluster(weighted(got, idf)[0])]})

    # One group per language, of about ``sample`` rows each.
    found = sorted((r["lang"], bytes(r["centre"])) for r in
                   features.groupBy("lang").applyInPandas(centres, "lang string, centre binary").collect())
    model = {"langs": [lang for lang, _ in found], "idf": idf, "least": {},
             "centres": np.stack([np.frombuffer(c, "<f4") for _, c in found])}

    def similar(batches):
        """Similarity of the sampled texts, and of ever shorter parts of them."""
        import pyarrow as pa

        for b in slices(batches, limit=SLICE_BYTES, rows=SLICE_ROWS):
            texts = b.column(1).to_pylist()
            for step in range(4, 16):
                part = [t[len(t) // 3:len(t) // 3 + (1 << step)] for t in texts if len(t) >= 1 << step] if step < 15 else texts
                if part:
                    got, ok = vectors(pa.array(part))
                    unit, n = weighted(got[ok], model["idf"])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_length_class(n), pa.int32()),
                         pa.array((unit @ model["centres"].T).max(axis=1, initial=0).astype(float), pa.float64())],
                        ["length", "similarity"])

    low = (map_arrow(picked, similar, "length int, similarity double").groupBy("length")
           .agg(F.percentile_approx("similarity", F.lit(TAIL), F.lit(10_000)).alias("low")).collect())
    model["least"] = {r["length"]: MARGIN * r["low"] for r in low}
    return model


def held_out(id_col: str, folds: int = FOLDS):
    """Whether the fold of the id, crc32 of its text, is 0 (null: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def identify(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, id, lang_pred, score, rejected) of every row; ``rid`` tells rows
    apart."""
    src = rows_of(docs, id_col, text_col)
    kind = dict(src.dtypes)["id"]
    known = docs.sparkSession.sparkContext.broadcast(model)  # languages x CENTROIDS rows of BUCKETS

    def run(batches):
        import numpy as np
        import pyarrow as pa

        m = known.value
        if m:
            names = np.array(m["langs"], object)
            lowest, highest = min(m["least"]), max(m["least"])
            bounds = np.array([m["least"].get(k, np.nan) for k in range(lowest, highest + 1)])
            for k in range(len(bounds)):  # a class without texts takes the next shorter one's
                bounds[k] = bounds[k - 1] if np.isnan(bounds[k]) else bounds[k]
        for b in slices(batches, limit=SLICE_BYTES, rows=SLICE_ROWS):
            counts, ok = vectors(b.column(2))
            score, pred, reject = np.zeros(len(ok)), np.full(len(ok), "und", object), ~ok
            if m:
                unit, n = weighted(counts, m["idf"])
                near = unit @ m["centres"].T
                best = near.argmax(axis=1)
                score = np.where(ok, np.clip(near.max(axis=1), 0, 1), 0).astype(float)
                pred = np.where(ok, names[best], "und")
                length = _length_class(n)
                # Shorter than any class that the sample has: not judged by distance.
                least = np.where(length < lowest, -1, bounds[np.clip(length, lowest, highest) - lowest])
                reject = ~ok | (score < least)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array(reject, pa.bool_())], ["rid", "id", "lang_pred", "score", "rejected"])

    return map_arrow(src, run, f"rid string, id {kind}, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, **names) -> DataFrame:
    """The rows of ``docs`` whose language is recognised."""
    docs = placed(docs)
    return without(docs, identify(docs, fit(docs, **names)).where("rejected"))


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    from .common import table
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs)).select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "lang_pred", "score", "rejected")
