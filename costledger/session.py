"""Session helpers: a tuned local session for tests/bench, and the shared
checkpoint folder that multi-step jobs use to cut lineage."""
from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "costledger", extra_conf: dict | None = None) -> SparkSession:
    """Session for tests and the bench.  On a cluster, use the cluster's own
    session and only apply ``SCALE_CONF``."""
    master = master or os.environ.get("COSTLEDGER_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SCALE_CONF, **(extra_conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the cluster (a shared file system).  Only
    a local-mode session without one gets a private scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="costledger-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def materialize(df):
    """Write ``df`` as Parquet into a new folder of the shared checkpoint
    folder and read it back: one computation, lineage cut, and it survives
    executor loss (unlike a cache).  ``Dataset.checkpoint`` would compute the
    input twice (once for the job, once more to write it)."""
    import uuid
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/materialized/{uuid.uuid4().hex}"
    if _kept.stack:
        _kept.stack[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class _Copies(threading.local):
    """Per thread, what each job that is under way has written: a job only
    ever removes copies of its own, whatever runs beside it (a stream's
    ``foreachBatch`` is a thread of its own)."""

    def __init__(self):
        self.stack: list[list[str]] = []


_kept = _Copies()


@contextmanager
def own_copies(spark: SparkSession):
    """Remove what ``materialize`` writes inside, when it ends: for a job
    that has committed its results elsewhere."""
    _kept.stack.append([])
    try:
        yield
    finally:
        _remove(spark, _kept.stack.pop())


def settled(spark: SparkSession, make):
    """The frame that ``make()`` returns as a written table, without the
    copies that were written on the way to it."""
    _kept.stack.append([])
    paths: list[str] = []
    try:
        out = materialize(make())
        paths.append(_kept.stack[-1][-1])
    finally:
        written = _kept.stack.pop()
        _remove(spark, [p for p in written if p not in paths])
    if _kept.stack:
        _kept.stack[-1].extend(paths)
    return out


def _remove(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
