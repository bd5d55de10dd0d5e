"""Exchange-rate inputs."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rates import explode_rates, parse_rates_payload
from ..schemas import RATES


class NullInRequiredColumn(ValueError):
    pass


def read_rates_payloads(spark: SparkSession, path: str, fetch_date: str | None = None) -> DataFrame:
    """S3 + P1: landed API responses (one JSON object per file, the rates map
    under ``rates``) -> (date, currency_code, rate).  The date is the one
    given, else the file's modification date in UTC, whatever the session's
    time zone.  A payload that is no whole JSON object fails the job; one
    without rates has no rows."""
    raw = spark.read.text(path, wholetext=True).select(
        "value", F.col("_metadata.file_modification_time").alias("_mtime"),
        F.col("_metadata.file_path").alias("_file"))
    utc = F.convert_timezone(None, F.lit("UTC"), F.col("_mtime").cast("timestamp_ntz"))
    date = F.lit(fetch_date).cast("date") if fetch_date else F.to_date(utc)
    whole = F.try_parse_json("value")
    checked = F.when(whole.isNotNull() & F.startswith(F.schema_of_variant(whole), F.lit("OBJECT")), F.col("value")).otherwise(
        F.raise_error(F.concat(F.lit("damaged rates payload: "), F.col("_file"))))
    return explode_rates(raw.withColumn("_rates", parse_rates_payload(checked)), "_rates", date)


def require_not_null(df: DataFrame, schema=RATES) -> DataFrame:
    """Fail the job on a NULL in a non-nullable field (file sources do not
    enforce nullability).  Checked inside the plan, no extra pass."""
    for f in schema.fields:
        if not f.nullable:
            df = df.withColumn(f.name, F.when(F.col(f.name).isNull(), F.raise_error(
                F.lit(f"NULL in required column {f.name}"))).otherwise(F.col(f.name)))
    return df


def read_rates_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited JSON rows under the fixed rates schema; malformed
    rows fail the read, NULLs in required fields fail the job."""
    df = spark.read.schema(RATES).option("mode", "FAILFAST").json(path)
    return require_not_null(df)


def read_rates_table(spark: SparkSession, path: str) -> DataFrame:
    """The appended rates table (Parquet)."""
    return spark.read.schema(RATES).parquet(path)
