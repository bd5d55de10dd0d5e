"""Incremental ingestion of ad-spend files on Spark: dedup to the highest cost
per key, conversion to US dollars, upsert where the higher cost wins, and a
file registry that tracks new, unchanged, copied and vanished files."""
__version__ = "0.1.0"
