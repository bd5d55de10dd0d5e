"""Read the ad-spend Parquet files of a run.

Files may differ in physical types (``cost`` as decimal, ``dt`` as string or
timestamp), lack columns or be damaged.  The footers are read on the
executors; the row groups of the good files are dealt over tasks by size and
read there into one staged table, with the object key as listed, so a row's
file is never looked up by a path spelled another way."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import AD_INPUT, REQUIRED_COLUMNS
from ..session import materialize
from .listing import spread
from .store import store_opener

_FOOTER = "object_key string, row_group int, n_rows long, n_bytes long, missing string, error string"
_RAW = ("object_key string, dt string, network string, currency string, platform string, cost double, "
        "cost_text string, error string")


def _footer_reader(required=tuple(REQUIRED_COLUMNS)):
    """The per-partition footer reader for ``mapInPandas``: a row per row
    group, or a single one numbered -1."""
    open_store = store_opener()

    def read(batches):
        import pandas as pd
        import pyarrow.parquet as pq

        for pdf in batches:
            out = []
            for key in pdf["object_key"]:
                try:
                    fs, path, _ = open_store(key)
                    with fs.open_input_file(path) as f:
                        meta = pq.ParquetFile(f)
                        names = set(meta.schema_arrow.names)
                        groups = [meta.metadata.row_group(k) for k in range(meta.metadata.num_row_groups)]
                        groups = [(k, g.num_rows, g.total_byte_size) for k, g in enumerate(groups)]
                except Exception as e:      # a damaged file is rejected with its reason
                    out.append((key, -1, 0, 0, "", f"{type(e).__name__}: {e}"[:500]))
                    continue
                missing = ",".join(c for c in required if c not in names)
                out += [(key, *g, missing, None) for g in groups or [(-1, 0, 0)]]
            yield pd.DataFrame(out, columns=["object_key", "row_group", "n_rows", "n_bytes", "missing", "error"])
    return read


def _row_reader(required=tuple(REQUIRED_COLUMNS)):
    """The per-partition reader of row groups for ``mapInArrow``.  A row group
    that can't be read gives one row with the reason."""
    open_store = store_opener()

    def read(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        names = ["object_key", *required, "cost_text", "error"]
        kinds = {"cost": pa.float64()}

        def column(table, name):
            if name not in table.schema.names:
                return pa.nulls(table.num_rows, kinds.get(name, pa.string()))
            c = table.column(name)
            if pa.types.is_dictionary(c.type):
                c = c.cast(c.type.value_type)
            if name == "dt" and pa.types.is_timestamp(c.type):
                c = c.cast(pa.date32(), safe=False)
            return c

        def rows(key, table):
            values = {n: column(table, n) for n in required}
            cost = values["cost"]
            numeric = pa.types.is_floating(cost.type) or pa.types.is_integer(cost.type) or pa.types.is_decimal(cost.type)
            text = pa.nulls(table.num_rows, pa.string()) if numeric else cost.cast(pa.string())
            values["cost"] = cost.cast(pa.float64(), safe=False) if numeric else pa.nulls(table.num_rows, pa.float64())
            arrays = [pa.array([key] * table.num_rows, pa.string()),
                      *(values[n].cast(kinds.get(n, pa.string())) for n in required),
                      text, pa.nulls(table.num_rows, pa.string())]
            arrays = [a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays]
            return pa.RecordBatch.from_arrays(arrays, names)

        for b in batches:
            for key, group, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                got = 0
                try:
                    fs, path, _ = open_store(key)
                    with fs.open_input_file(path) as f:
                        file = pq.ParquetFile(f)
                        has = [c for c in required if c in file.schema_arrow.names]
                        for part in file.iter_batches(row_groups=[group], columns=has):
                            got += part.num_rows
                            yield rows(key, pa.Table.from_batches([part]))
                    if got != n:
                        raise ValueError(f"row group {group} gave {got} of {n} rows")
                except (OSError, ValueError, pa.ArrowException) as e:
                    nulls = [pa.nulls(1, kinds.get(c, pa.string())) for c in [*required, "cost_text"]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), *nulls, pa.array([f"{type(e).__name__}: {e}"[:500]])], names)
    return read


def footers(files: DataFrame) -> DataFrame:
    """The row groups of the files, what required columns each lacks, or why
    it can't be read.  Only footers are read, in parallel."""
    n = max(1, min(files.count(), files.sparkSession.sparkContext.defaultParallelism))
    return materialize(files.select("object_key").repartition(n, "object_key")
                       .mapInPandas(_footer_reader(), _FOOTER))


def read_ad_files(spark: SparkSession, files: DataFrame, pad_missing: bool = False
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read the files of ``files`` (``object_key`` = path).

    Returns (rows, rejected, read): rows carry ``object_key`` and the ad
    columns cast to the input types (``dt`` to date before any dedup, ``cost``
    to double; values that do not fit become NULL and are counted); read has
    (object_key, n_rows, cast_failures) per file.  A file that can't be read
    or lacks a required column is rejected (object_key, missing, reason), or
    with ``pad_missing`` read with NULLs for columns it lacks (the legacy
    rule; a file without ``cost`` is still rejected, as the legacy conversion
    fails on it).  Extra columns are ignored."""
    foot = footers(files)
    lacks = F.col("missing") != ""
    if pad_missing:
        lacks = F.array_contains(F.split("missing", ","), "cost")
    bad = F.col("error").isNotNull() | lacks
    good = materialize(foot.where(~bad & (F.col("row_group") >= 0)).select("object_key", "row_group", "n_rows", "n_bytes"))
    raw = (spread(good, ["object_key", "row_group"], "n_bytes").select("object_key", "row_group", "n_rows")
           .mapInArrow(_row_reader(), _RAW))
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in AD_INPUT.fields}
    typed["cost"] = F.coalesce(F.col("cost"), F.col("cost_text").try_cast("double"))
    lost = ((F.col("dt").isNotNull() & typed["dt"].isNull()).cast("int")
            + (F.col("cost_text").isNotNull() & typed["cost"].isNull()).cast("int"))
    # Staged once (K2): everything downstream reads this copy.
    staged = materialize(raw.select("object_key", *[typed[f.name].alias(f.name) for f in AD_INPUT.fields],
                                    lost.alias("cast_failures"), "error"))
    broken = materialize(staged.where("error IS NOT NULL").groupBy("object_key").agg(F.min("error").alias("reason")))
    rejected = foot.where(bad & (F.col("row_group") <= 0)).select("object_key", "missing", "error") \
        .withColumn("reason", F.coalesce("error", F.concat(F.lit("missing columns: "), F.col("missing")))).drop("error") \
        .unionByName(broken.withColumn("missing", F.lit("")))
    kept = staged.where("error IS NULL").join(broken.select("object_key"), "object_key", "left_anti")
    read = kept.groupBy("object_key").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("cast_failures").alias("cast_failures"))
    return kept.drop("cast_failures", "error"), rejected, read


def parquet_loader(spark: SparkSession, pad_missing: bool = False):
    """A ``Loader`` for ``plans.run.apply_run``."""
    return lambda files: read_ad_files(spark, files, pad_missing)
