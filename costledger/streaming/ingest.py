"""A Structured Streaming front end, keyed by content.

The file source names every new Parquet file once (by path).  Its content is
hashed in the stream, and the query's state store remembers every (name, hash)
it has let through: a file that lands again under another path, in this
micro-batch or years later, is dropped there, without a look at the registry.
The rest of a micro-batch is an ingest run: read, deduped, converted, upserted
and recorded in the registry like by the batch job, which afterwards finds the
files unchanged.  A content under another name is new to the state and is
handed over by the run.

Late files of any age are simply merged by key: there is no watermark, as in
the reference, so the state grows by one small row per content, like the
registry; a cluster keeps it on disk with
``spark.sql.streaming.stateStore.providerClass`` set to Spark's RocksDB store.
A content whose version the batch job has tombstoned since (its file was gone)
stays known to the stream; if it lands again it is the batch job's.  The file
source never reports deleted files and skips names that begin with ``_`` or
``.``; those are the batch job's too."""
from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import base_name
from ..plans.run import apply_run
from ..session import materialize, own_copies
from ..sinks.tables import publish, publish_tables, read_state, read_tables, write_version_dates
from ..sources.adfiles import parquet_loader
from ..sources.listing import _md5_streamer, listing_from_keys

_FILE = "path string, modificationTime timestamp, length long, content binary"


def ad_file_stream(spark: SparkSession, source_root: str, max_files: int | None = None) -> DataFrame:
    """New ``*.parquet`` files below ``source_root`` as a stream of
    (object_key, length); no content is read.  At most ``max_files`` of them
    in one micro-batch."""
    reader = (spark.readStream.format("binaryFile").schema(_FILE)
              .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(source_root).select(F.col("path").alias("object_key"), "length")


def new_contents(files: DataFrame) -> DataFrame:
    """(object_key, file_name, file_hash) of a stream of files, each name and
    content once in the life of the query.  Which of equal objects in one
    micro-batch is taken is open: they hold the same rows."""
    hashed = files.select("object_key").mapInPandas(_md5_streamer(), "object_key string, file_hash string")
    return (hashed.select("object_key", base_name("object_key").alias("file_name"), "file_hash")
            .dropDuplicates(["file_name", "file_hash"]))


def merge_batch(spark: SparkSession, batch: DataFrame, run_id: str, state_root: str | None,
                rates: DataFrame, run_ts: str, rate_policy: str = "latest",
                tables: tuple[str, str] | None = None) -> None:
    """Ingest the contents of one micro-batch (``new_contents``).  Redone after
    a crash it changes nothing twice: a snapshot run id that is in the log is
    skipped, and in table mode the version ids follow from the run id."""
    with own_copies(spark):
        listing = listing_from_keys(materialize(batch.select("object_key", "file_hash")))
        if listing.isEmpty():       # nothing but copies
            return
        target, registry = read_tables(spark, *tables) if tables else read_state(spark, state_root)
        res = apply_run(listing, registry, target, rates, parquet_loader(spark), run_id, run_ts,
                        run_ts[:10], rate_policy=rate_policy, allow_empty=True, reconcile=False)
        if state_root:
            write_version_dates(res.version_dates, state_root, run_id)
        if tables:
            publish_tables(spark, *tables, res.touched_dates, res.target_touched, res.registry,
                           res.registry_changes, run_id=run_id)
        else:
            publish(spark, state_root, run_id, res.target_touched, res.registry, untouched=res.target_untouched)


def start_ingest_stream(spark: SparkSession, source_root: str, state_root: str | None,
                        rates: DataFrame, run_ts: str, checkpoint: str | None = None,
                        available_now: bool = True, tables: tuple[str, str] | None = None,
                        max_files: int | None = None):
    """Start the stream; with ``available_now`` it processes what is there and
    stops (a scheduled daily run).  The stream's checkpoint stays at one place
    below ``state_root`` for each source unless given, so the next session
    goes on where this one stopped.  Run ids carry the id that the checkpoint
    gives the query: a new checkpoint or a second source never repeats one.
    ``tables`` publishes into catalog tables (only the dates of each
    micro-batch are rewritten); ``max_files`` bounds a micro-batch."""
    if checkpoint is None:
        if state_root is None:
            raise ValueError("a stream needs a checkpoint or a state_root")
        checkpoint = f"{state_root}/_stream/{hashlib.sha256(source_root.encode()).hexdigest()[:16]}"

    def each(df, batch_id):
        query = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        merge_batch(spark, df, f"stream-{query}-{batch_id}", state_root, rates, run_ts, tables=tables)

    writer = (new_contents(ad_file_stream(spark, source_root, max_files)).writeStream.foreachBatch(each)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime="1 minute")
    return writer.start()
