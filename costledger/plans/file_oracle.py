"""Oracle SQL of the queries over files and tables."""
from __future__ import annotations

from .fixtures import EVENTS_PER_FILE, FILE_KINDS, MIN_FILES
from .oracle import _USD_DROP, _with

_NAMED = f"""
, named AS (SELECT a.*, event_id % n AS no FROM ad_rows a, (SELECT {MIN_FILES} + count(*) // {EVENTS_PER_FILE} AS n FROM ad_rows))"""
_KIND = "CASE no % {} {} END".format(len(FILE_KINDS), " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(FILE_KINDS)))

SQL: dict[str, str] = {
    "stream_end_state": _with("ad_rows", "latest") + _NAMED + f"""
, best AS (SELECT dt, network, currency, platform, max(CASE WHEN isnan(cost) THEN NULL ELSE cost END) AS cost
           FROM named GROUP BY ALL)
SELECT a.dt, a.network, a.currency, a.platform, a.cost, a.cost * l.rate AS cost_usd,
       (SELECT count(DISTINCT no) FROM named) AS n_versions
FROM best a JOIN latest l ON a.currency = l.currency_code {_USD_DROP}""",
    "odd_files_report": _with("ad_rows") + _NAMED + f"""
, files AS (SELECT no, {_KIND} AS kind, count(*) AS n, count(*) FILTER (event_id % 10 = 0) AS tenth, max(cost) AS top,
                   max(cost) FILTER (event_id % 10 <> 0) AS top_number FROM named GROUP BY no),
modes AS (SELECT unnest([false, true]) AS pad),
judged AS (SELECT *, kind IN ('no cost', 'cut off', 'no parquet') OR (kind = 'no platform' AND NOT pad) AS rejected
           FROM files, modes)
SELECT pad, 'ads_' || CAST(no AS VARCHAR) || '.parquet' AS file_name, rejected,
       CASE WHEN rejected AND starts_with(kind, 'no ') AND kind <> 'no parquet' THEN substr(kind, 4) ELSE '' END AS missing,
       CASE WHEN rejected THEN 0 ELSE n END AS n_rows,
       CASE WHEN kind = 'text cost' THEN tenth ELSE 0 END AS cast_failures,
       CASE WHEN NOT rejected THEN CASE WHEN kind = 'text cost' THEN top_number ELSE top END END AS max_cost,
       CASE WHEN rejected OR kind = 'no platform' THEN 0 ELSE n END AS n_platforms
FROM judged""",
    "rates_load": _with("fx_rates") + """
, yearly AS (SELECT make_date(CAST(year(date) AS INTEGER), 12, 31) AS date, currency_code, max(rate) AS rate
             FROM fx_rates GROUP BY ALL)
SELECT *, date = max(date) OVER (PARTITION BY currency_code) AS is_newest FROM yearly""",
    "latest_rate_kept": _with("latest") + "SELECT * FROM latest",
    "listing_changes": _with("registry", "listing") + """
, b AS (SELECT file_name, file_hash FROM registry WHERE status = 'processed'),
j AS (SELECT b.file_name AS b_name, b.file_hash AS b_hash, n.file_name AS n_name, n.file_hash AS n_hash
      FROM b FULL OUTER JOIN listing n ON b.file_name = n.file_name
      WHERE b.file_name IS NULL OR n.file_name IS NULL OR b.file_hash <> n.file_hash)
SELECT b_name AS file_name, b_hash AS file_hash, CASE WHEN n_name IS NULL THEN 'gone' ELSE 'before' END AS change
FROM j WHERE b_name IS NOT NULL
UNION ALL
SELECT n_name, n_hash, CASE WHEN b_name IS NULL THEN 'added' ELSE 'after' END FROM j WHERE n_name IS NOT NULL""",
    "table_ingest_end_state": _with("tgt2") + "SELECT * FROM tgt2",
    "table_ingest_registry": _with("reg2") + "SELECT * FROM reg2",
    "table_states": _with("tgt0", "tgt2", "reg0", "reg2") + """
SELECT 'before' AS step, (SELECT count(*) FROM tgt0) AS n_rows,
       count(*) FILTER (status = 'processed') AS n_processed, count(*) FILTER (status = 'deleted') AS n_deleted FROM reg0
UNION ALL
SELECT 'after', (SELECT count(*) FROM tgt2), count(*) FILTER (status = 'processed'), count(*) FILTER (status = 'deleted') FROM reg2
UNION ALL SELECT 'reset', 0, 0, 0""",
    "rates_ndjson": _with("fx_rates") + "SELECT * FROM fx_rates",
}
