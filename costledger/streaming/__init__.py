from .ingest import ad_file_stream, merge_batch, start_ingest_stream  # noqa: F401
