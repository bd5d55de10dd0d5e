"""Table schemas of the ingest pipeline and the fixed names it relies on."""
from pyspark.sql import types as T

# Fixed values of the data model (must stay as they are for equal results):
# the upsert key, the columns a file must carry, the registry states and the
# file suffix that marks an ad-spend object.
KEYS = ["dt", "network", "currency", "platform"]
REQUIRED_COLUMNS = ["dt", "network", "currency", "platform", "cost"]
STATUS_PROCESSED = "processed"
STATUS_DELETED = "deleted"
PARQUET_SUFFIX = ".parquet"

AD_INPUT = T.StructType([
    T.StructField("dt", T.DateType()),
    T.StructField("network", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("cost", T.DoubleType()),
])

TARGET = T.StructType([
    T.StructField("dt", T.DateType()),
    T.StructField("network", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("cost", T.DoubleType()),
    T.StructField("cost_usd", T.DoubleType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_version_id", T.StringType()),
    T.StructField("last_processed_timestamp", T.TimestampType()),
])

REGISTRY = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("file_hash", T.StringType()),
    T.StructField("file_version_id", T.StringType()),
    T.StructField("upload_date", T.TimestampNTZType()),
    T.StructField("processed_date", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
])

RATES = T.StructType([
    T.StructField("date", T.DateType(), nullable=False),
    T.StructField("currency_code", T.StringType(), nullable=False),
    T.StructField("rate", T.DoubleType(), nullable=False),
])

# One listed object: full key, base name, date folder and content MD5 (hex).
LISTING = T.StructType([
    T.StructField("object_key", T.StringType()),
    T.StructField("folder", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_hash", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modification_time", T.TimestampType()),
])

RATES_PAYLOAD_MAP = "map<string,double>"


def empty(spark, schema):
    return spark.createDataFrame([], schema)
