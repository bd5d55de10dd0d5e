"""List the objects under a root with their content MD5."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import base_name, folder_name
from ..operators.sequence import sum_in_order
from ..session import materialize
from .store import store_opener

_SAME_FILE = ["object_key", "length", "modification_time"]
_CHUNK = 8 << 20
# Bytes of content that one hashing task reads, about.
_TASK_BYTES = 128 << 20
# What opening an object costs, in bytes of content.
_OPEN_BYTES = 64 << 10
# Folders that one listing task reads, about.
_TASK_FOLDERS = 100
_ENTRY = "object_key string, length long, modification_time timestamp, is_folder boolean"


def _lister(root: bool):
    """The per-partition lister for ``mapInPandas``: what is in each folder
    (``object_key``), not below it.  A folder below the root that has vanished
    since it was listed is empty."""
    open_store = store_opener()

    def entries(batches):
        import pandas as pd
        import pyarrow.fs as pafs

        def table(found):
            return pd.DataFrame(found, columns=["object_key", "length", "modification_time", "is_folder"])

        for pdf in batches:
            for key in pdf["object_key"]:
                fs, path, prefix = open_store(key)
                found = []
                for i in fs.get_file_info(pafs.FileSelector(path, allow_not_found=not root)):
                    found.append((prefix + i.path, i.size or 0, pd.Timestamp(i.mtime),
                                  i.type == pafs.FileType.Directory))
                    if len(found) == 10_000:
                        yield table(found)
                        found = []
                if found:
                    yield table(found)
    return entries


def _md5_streamer(chunk: int = _CHUNK):
    """The per-partition MD5 for ``mapInPandas``: every object is read in
    chunks, so none is ever held whole."""
    open_store = store_opener()

    def stream(batches):
        import hashlib

        import pandas as pd

        for pdf in batches:
            out = []
            for key in pdf["object_key"]:
                fs, path, _ = open_store(key)
                h = hashlib.md5()
                with fs.open_input_stream(path) as f:
                    while block := f.read(chunk):
                        h.update(block)
                out.append(h.hexdigest())
            yield pd.DataFrame({"object_key": pdf["object_key"], "file_hash": out})
    return stream


def spread(df: DataFrame, by: list[str], size: str, task_bytes: int = _TASK_BYTES) -> DataFrame:
    """A written ``df`` dealt over tasks by bytes: rows in the order ``by``,
    each to the task in whose share of the running sum of ``size`` it begins.
    So no task gets more than its share and one row, however the sizes
    differ.  There are as many tasks as the bytes ask for, and no fewer than
    can run at once (if there are the rows); opening an object counts as
    ``_OPEN_BYTES``."""
    cost = F.coalesce(F.col(size), F.lit(0)) + _OPEN_BYTES
    n, total = df.agg(F.count(F.lit(1)), F.sum(cost)).first()
    at_once = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(n, max(at_once, (total or 0) // task_bytes + 1)))
    if tasks == 1:
        return df.coalesce(1)
    share = -(-total // tasks)
    dealt = sum_in_order(df.withColumn("_cost", cost), [F.col(c) for c in by], "_cost", "_begins")
    return (dealt.repartitionById(tasks, F.floor(F.col("_begins") / share).cast("int"))
            .drop("_cost", "_begins"))


def with_md5(objects: DataFrame) -> DataFrame:
    """(object_key, file_hash) of a written frame (object_key, length): one
    path for every size, spread over tasks by bytes."""
    return (spread(objects, ["object_key"], "length").select("object_key")
            .mapInPandas(_md5_streamer(), "object_key string, file_hash string"))


def qualified(spark: SparkSession, path: str) -> str:
    """A path without a scheme as the session's default file system means it;
    executors have another working folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _objects(spark: SparkSession, root: str, glob: str | None) -> DataFrame:
    """Every object below ``root``.  The folders of a level are dealt over
    tasks, which list them without going deeper; the folders they find are the
    next level, until there is none.  So one top folder with many below it is
    listed by many tasks, and a task holds the entries of one folder at a
    time.  Each level is a written table."""
    if ":" not in root.partition("/")[0]:
        root = qualified(spark, root)
    folders, n, levels = spark.createDataFrame([(root,)], "object_key string"), 1, []
    at_once = spark.sparkContext.defaultParallelism
    while n:
        tasks = min(n, max(at_once, n // _TASK_FOLDERS + 1))
        level = materialize(folders.repartition(tasks).mapInPandas(_lister(not levels), _ENTRY))
        levels.append(level.where("not is_folder").drop("is_folder"))
        folders = level.where("is_folder").select("object_key")
        n = folders.count()
    found = reduce(DataFrame.unionByName, levels)
    if glob:
        like = "".join({"*": ".*", "?": "."}.get(c, "\\" + c if not c.isalnum() else c) for c in glob)
        found = found.where(base_name("object_key").rlike(f"^{like}$"))
    return materialize(found)


def _shape(df: DataFrame) -> DataFrame:
    return df.select("object_key", folder_name("object_key").alias("folder"),
                     base_name("object_key").alias("file_name"), "file_hash", "length", "modification_time")


def list_objects(spark: SparkSession, root: str, with_hash: bool = True,
                 glob: str | None = None, known: DataFrame | None = None) -> DataFrame:
    """Every object below ``root`` (recursive, whatever its name) as
    (object_key, folder, file_name, file_hash, length, modification_time).
    ``object_key`` is the full path as the store spells it, so key order is
    list order.

    Listing and MD5 run on the executors.  Without ``with_hash`` no content
    is read.  With ``known`` (the listing of the previous run) only objects
    whose path, length or modification time changed are read; the others keep
    their known hash."""
    meta = _objects(spark, root, glob)
    if not with_hash:
        return _shape(meta.withColumn("file_hash", F.lit(None).cast("string")))
    if known is None:
        return _shape(meta.join(with_md5(meta), "object_key"))
    prev = known.select(*_SAME_FILE, "file_hash").filter(F.col("file_hash").isNotNull())
    same = meta.join(prev, _SAME_FILE)
    changed = materialize(meta.join(prev, _SAME_FILE, "left_anti"))
    return _shape(same.unionByName(changed.join(with_md5(changed), "object_key")))


def listing_from_keys(df: DataFrame, key_col: str = "object_key",
                      hash_col: str = "file_hash") -> DataFrame:
    """A listing from an existing inventory of keys and hashes (for example
    an object-store inventory report), split like ``list_objects``."""
    return df.select(F.col(key_col).alias("object_key"),
                     folder_name(key_col).alias("folder"),
                     base_name(key_col).alias("file_name"),
                     F.col(hash_col).alias("file_hash"))
