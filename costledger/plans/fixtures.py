"""Ad-spend, rate, registry and listing frames derived from the shared test
tables (TPC-H-like parquet).  Each is a lazy DataFrame over the whole table,
so its size grows with the scale factor.  ``oracle.py`` holds the same views
as SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import known_size


# Fixed values of the fixtures: the number of ad files the events are spread
# over, the nations without a rate, the literal dates of the registry and of
# the run used by every query.
N_AD_FILES = 7
NATIONS_WITHOUT_RATE = (3, 7)
REGISTRY_TS = "2024-01-01 00:00:00"
RUN_ID = "run-2024-01-31"
RUN_TS = "2024-01-31 00:00:00"
RUN_DATE = "2024-01-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-spend rows of seven files: one row per event, currency from the
    nation of ``user_id % 10``."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    # nation is a fixed-size dimension: Spark's planner broadcasts it from its
    # file-size statistics (and would shuffle-join it if it were large).
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    file_no = F.col("event_id") % N_AD_FILES
    return (e.join(n, F.col("n_nationkey") == F.col("user_id") % 10)
             .select(F.col("ts").cast("date").alias("dt"),
                     F.col("event_type").alias("network"),
                     F.col("n_name").alias("currency"),
                     F.when(F.col("event_id") % 2 == 0, "ios").otherwise("android").alias("platform"),
                     F.col("value").alias("cost"),
                     F.concat(F.lit("ads_"), file_no.cast("string"), F.lit(".parquet")).alias("file_name"),
                     file_no.alias("file_no"),
                     "event_id"))


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only rate history with duplicate (date, currency) rows."""
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_suppkey", "l_tax")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name") \
        .filter(~F.col("n_nationkey").isin(*NATIONS_WITHOUT_RATE))
    # Written: its size is known then (the estimate for a join would make the
    # planner take the pruned lineitem side for the small one).
    sn = known_size(s.join(n, F.col("s_nationkey") == F.col("n_nationkey")))
    return (li.join(sn, F.col("l_suppkey") == F.col("s_suppkey"))
              .select(F.col("l_shipdate").cast("date").alias("date"),
                      F.col("n_name").alias("currency_code"),
                      (F.lit(1.0) + F.col("l_tax")).alias("rate")))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File registry over ``part``: by ``p_partkey % 5`` a file is 0 missing,
    1 unchanged, 2 re-uploaded, 3 seen under another name, 4 new (no row)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    pk = F.col("p_partkey").cast("string")
    ts = F.lit(REGISTRY_TS).cast("timestamp_ntz")
    return (p.filter(F.col("p_partkey") % 5 != 4)
             .select(F.concat(F.when(F.col("p_partkey") % 5 == 3, "old_").otherwise("f_"),
                              pk, F.lit(".parquet")).alias("file_name"),
                     F.md5(F.concat(F.col("p_name"), pk)).alias("file_hash"),
                     F.concat(F.lit("v"), pk).alias("file_version_id"),
                     ts.alias("upload_date"), ts.alias("processed_date"),
                     F.when(F.col("p_size") % 7 == 0, "deleted").otherwise("processed").alias("status")))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed objects (flat keys) with their content MD5; half of the files
    seen under another name still exist under both names."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    pk = F.col("p_partkey").cast("string")
    current = (p.filter(F.col("p_partkey") % 5 != 0)
                .select(F.concat(F.lit("f_"), pk, F.lit(".parquet")).alias("file_name"),
                        F.md5(F.concat(F.when(F.col("p_partkey") % 5 == 2, "changed").otherwise(""),
                                       F.col("p_name"), pk)).alias("file_hash")))
    old = (p.filter((F.col("p_partkey") % 5 == 3) & (F.col("p_partkey") % 2 == 0))
            .select(F.concat(F.lit("old_"), pk, F.lit(".parquet")).alias("file_name"),
                    F.md5(F.concat(F.col("p_name"), pk)).alias("file_hash")))
    return current.unionByName(old).withColumn("object_key", F.col("file_name"))


# Fixed values of the ingest fixture: which ad file vanishes, which one is
# re-uploaded with a changed content (its costs times the factor), which one
# gets a copy under a second name, and the folders of the listing.
VANISHED_FILE = 0
REUPLOADED_FILE, REUPLOAD_FACTOR = 2, 2.0
COPIED_FILE = 3
OLD_FOLDER, NEW_FOLDER = "2024-01-29", "2024-01-30"


def _ad_name(no):
    return F.concat(F.lit("ads_"), no.cast("string"), F.lit(".parquet"))


def ingest_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing of the run with, per object, the ad file whose rows it
    holds (``src_no``) and a cost factor (the changed re-upload)."""
    files = fx_files(spark, sf_dir)
    no = F.col("file_no")
    name = _ad_name(no)
    listed = files.filter(no != VANISHED_FILE).select(
        F.concat(F.lit("in/"), F.when(no.isin(1, COPIED_FILE), OLD_FOLDER).otherwise(NEW_FOLDER),
                 F.lit("/"), name).alias("object_key"),
        name.alias("file_name"),
        F.md5(F.concat(F.when(no == REUPLOADED_FILE, "v2").otherwise(""), name)).alias("file_hash"),
        no.alias("src_no"),
        F.when(no == REUPLOADED_FILE, REUPLOAD_FACTOR).otherwise(1.0).alias("factor"))
    copy = files.filter(no == COPIED_FILE).select(
        F.lit(f"in/{NEW_FOLDER}/ads_{COPIED_FILE}_copy.parquet").alias("object_key"),
        F.lit(f"ads_{COPIED_FILE}_copy.parquet").alias("file_name"),
        F.md5(name).alias("file_hash"), no.alias("src_no"), F.lit(1.0).alias("factor"))
    manifest = files.filter(no == VANISHED_FILE).select(
        F.lit(f"in/{NEW_FOLDER}/manifest.csv").alias("object_key"),
        F.lit("manifest.csv").alias("file_name"), F.md5(F.lit("manifest")).alias("file_hash"),
        F.lit(None).cast("bigint").alias("src_no"), F.lit(None).cast("double").alias("factor"))
    out = listed.unionByName(copy).unionByName(manifest)
    return out.withColumn("folder", F.element_at(F.split("object_key", "/"), -2))


def fx_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_rows(spark, sf_dir).select("file_no").distinct()


def ingest_rows(spark: SparkSession, sf_dir: str, listing: DataFrame | None = None) -> DataFrame:
    """Rows of every listed ad object (``object_key`` + the ad columns).
    ``listing`` is the (written) run listing; derived here when absent."""
    lst = (listing if listing is not None else ingest_listing(spark, sf_dir)) \
        .filter(F.col("src_no").isNotNull())
    ads = ad_rows(spark, sf_dir)
    return (ads.join(lst.select("object_key", "src_no", "factor"),
                     F.col("file_no") == F.col("src_no"))
               .select("object_key", "dt", "network", "currency", "platform",
                       (F.col("cost") * F.col("factor")).alias("cost")))


def ingest_registry0(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry before the run: files 0-3 processed."""
    no = F.col("file_no")
    ts = F.lit(REGISTRY_TS).cast("timestamp_ntz")
    return fx_files(spark, sf_dir).filter(no <= COPIED_FILE).select(
        _ad_name(no).alias("file_name"), F.md5(_ad_name(no)).alias("file_hash"),
        F.concat(F.lit("v_"), _ad_name(no)).alias("file_version_id"),
        ts.alias("upload_date"), ts.alias("processed_date"), F.lit("processed").alias("status"))


# Fixed values of the file fixture: the least number of files, events of a
# further file, and the names that files take in turn.
MIN_FILES, EVENTS_PER_FILE = 8, 2500
ODD_NAMES = ("ads_{}.parquet", "ads {}.parquet", "ads%20{}.parquet", "ads+{}.parquet", "adsé{}.parquet",
             "ads[{}].parquet", "_ads{}.parquet", ".ads{}.parquet")


def odd_name(no):
    parts = [n.split("{}") for n in ODD_NAMES]
    out = F.lit(None).cast("string")
    for k, (before, after) in enumerate(parts):
        out = F.when(no % len(parts) == k, F.concat(F.lit(before), no.cast("string"), F.lit(after))).otherwise(out)
    return out


def n_ad_files(spark: SparkSession, sf_dir: str) -> int:
    """How many files the events are dealt to (by ``event_id``)."""
    return MIN_FILES + table(spark, sf_dir, "events").join(
        table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("user_id") % 10).count() // EVENTS_PER_FILE


def write_ad_files(spark: SparkSession, sf_dir: str, root: str, name=odd_name, folder: str = "2024-01-30",
                   which=None) -> int:
    """The events as real Parquet files below ``root``, written by tasks, one
    group of events each; by default with names that a reader may trip over.
    ``which`` tells from a file's number whether it is written.  Returns how
    many are."""
    from ..sources.store import store_opener
    n = n_ad_files(spark, sf_dir)
    open_store = store_opener()

    def write(pdf):
        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq

        name = pdf["name"].iloc[0]
        fs, path, _ = open_store(f"{root}/{folder}")
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/{name}") as f:
            pq.write_table(pa.Table.from_pandas(pdf.drop(columns="name"), preserve_index=False), f)
        return pd.DataFrame({"name": [name], "rows": [len(pdf)]})

    ads = ad_rows(spark, sf_dir).withColumn("no", F.col("event_id") % n)
    rows = (ads if which is None else ads.where(which(F.col("no")))).select(
        "dt", "network", "currency", "platform", "cost", name(F.col("no")).alias("name"))
    return rows.groupBy("name").applyInPandas(write, "name string, rows long").count()


def plain_name(no):
    return F.concat(F.lit("ads_"), no.cast("string"), F.lit(".parquet"))


def copy_files(listing: DataFrame, folder: str) -> int:
    """Copies of the listed objects, byte by byte, in another folder beside
    theirs.  Returns how many."""
    from ..sources.store import store_opener
    open_store = store_opener()

    def copy(batches):
        for pdf in batches:
            for key in pdf["object_key"]:
                fs, path, _ = open_store(key)
                above, _, name = path.rpartition("/")
                to = above.rpartition("/")[0] + "/" + folder
                fs.create_dir(to, recursive=True)
                fs.copy_file(path, f"{to}/{name}")
            yield pdf

    return listing.select("object_key").mapInPandas(copy, "object_key string").count()


# Fixed values of the fixture of damaged files: what is wrong with a file, by its number.
FILE_KINDS = ("no platform", "no cost", "text cost", "cut off", "no parquet", "text date", "good")


def write_odd_ad_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The events as files of which each has something wrong (``FILE_KINDS``):
    a missing column, a cost as text of which every tenth is no number, a
    footer that is cut off, bytes that are no Parquet, a date as text."""
    from ..sources.store import store_opener
    n = n_ad_files(spark, sf_dir)
    open_store = store_opener()
    kinds = FILE_KINDS

    def write(pdf):
        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq

        no = int(pdf["no"].iloc[0])
        kind, rows = kinds[no % len(kinds)], pdf.drop(columns=["no", "event_id"])
        if kind in ("no platform", "no cost"):
            rows = rows.drop(columns=kind.split()[1])
        elif kind == "text cost":
            rows["cost"] = [repr(c) if i % 10 else "n/a" for i, c in zip(pdf["event_id"], pdf["cost"])]
        elif kind == "text date":
            rows["dt"] = rows["dt"].astype(str)
        sink = pa.BufferOutputStream()
        pq.write_table(pa.Table.from_pandas(rows, preserve_index=False), sink)
        data = sink.getvalue().to_pybytes()
        data = data[:-9] if kind == "cut off" else b"no parquet" if kind == "no parquet" else data
        fs, path, _ = open_store(f"{root}/2024-01-30")
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/ads_{no}.parquet") as f:
            f.write(data)
        return pd.DataFrame({"no": [no]})

    rows = ad_rows(spark, sf_dir).select("dt", "network", "currency", "platform", "cost", "event_id",
                                         (F.col("event_id") % n).alias("no"))
    rows.groupBy("no").applyInPandas(write, "no long").count()


def copied_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects from ``orders``: a third of them are copies of one content
    under a thousand names, some have no content hash, some are no Parquet."""
    k = F.col("o_orderkey")
    key = k.cast("string")
    name = (F.when(k % 101 == 0, F.concat(F.lit("x_"), key, F.lit(".csv")))
            .when(k % 3 == 0, F.concat(F.lit("c_"), (k % 1000).cast("string"), F.lit(".parquet")))
            .otherwise(F.concat(F.lit("f_"), key, F.lit(".parquet"))))
    content = F.when(k % 3 == 0, F.md5(F.lit("shared"))).when(k % 50 == 1, F.lit(None)).otherwise(F.md5(key))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("in/"), key, F.lit("/"), name).alias("object_key"), key.alias("folder"),
        name.alias("file_name"), content.alias("file_hash"))


def copied_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the single objects and one copy were processed before."""
    ts = F.lit(REGISTRY_TS).cast("timestamp_ntz")
    return (copied_listing(spark, sf_dir)
            .filter((F.col("folder").cast("long") % 4 == 1) & F.col("file_name").startswith("f_")
                    | (F.col("file_name") == "c_3.parquet"))
            .select("file_name", "file_hash", F.concat(F.lit("v_"), F.col("folder")).alias("file_version_id"),
                    ts.alias("upload_date"), ts.alias("processed_date"), F.lit("processed").alias("status")))
