"""Oracle SQL (DuckDB dialect, ANSI where possible) for every catalog query.
The base tables are views named after the parquet files; the fixture views of
``fixtures.py`` are repeated here as CTEs."""
from __future__ import annotations

from .fixtures import EVENTS_PER_FILE, MIN_FILES, ODD_NAMES, REGISTRY_TS, RUN_DATE, RUN_ID, RUN_TS

VIEWS = {
    "ad_rows": """
SELECT CAST(e.ts AS DATE) AS dt, e.event_type AS network, n.n_name AS currency,
       CASE WHEN e.event_id % 2 = 0 THEN 'ios' ELSE 'android' END AS platform,
       e.value AS cost,
       'ads_' || CAST(e.event_id % 7 AS VARCHAR) || '.parquet' AS file_name,
       e.event_id % 7 AS file_no, e.event_id
FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 10""",
    "fx_rates": """
SELECT CAST(l.l_shipdate AS DATE) AS date, n.n_name AS currency_code, 1 + l.l_tax AS rate
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
                JOIN nation n ON n.n_nationkey = s.s_nationkey
WHERE n.n_nationkey NOT IN (3, 7)""",
    "registry": f"""
SELECT CASE WHEN p_partkey % 5 = 3 THEN 'old_' ELSE 'f_' END || CAST(p_partkey AS VARCHAR) || '.parquet' AS file_name,
       md5(p_name || CAST(p_partkey AS VARCHAR)) AS file_hash,
       'v' || CAST(p_partkey AS VARCHAR) AS file_version_id,
       TIMESTAMP '{REGISTRY_TS}' AS upload_date, TIMESTAMP '{REGISTRY_TS}' AS processed_date,
       CASE WHEN p_size % 7 = 0 THEN 'deleted' ELSE 'processed' END AS status
FROM part WHERE p_partkey % 5 <> 4""",
    "listing": """
SELECT file_name, file_hash, file_name AS object_key FROM (
  SELECT 'f_' || CAST(p_partkey AS VARCHAR) || '.parquet' AS file_name,
         md5(CASE WHEN p_partkey % 5 = 2 THEN 'changed' ELSE '' END || p_name || CAST(p_partkey AS VARCHAR)) AS file_hash
  FROM part WHERE p_partkey % 5 <> 0
  UNION ALL
  SELECT 'old_' || CAST(p_partkey AS VARCHAR) || '.parquet', md5(p_name || CAST(p_partkey AS VARCHAR))
  FROM part WHERE p_partkey % 5 = 3 AND p_partkey % 2 = 0)""",
    "latest": """
SELECT currency_code, date, rate FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY currency_code
                               ORDER BY date DESC NULLS LAST, rate DESC NULLS LAST) AS rn
  FROM fx_rates) WHERE rn = 1""",
    "snapshot": """
SELECT currency_code, MAX(date) AS date, MAX(rate) AS rate FROM fx_rates
WHERE date = (SELECT MAX(date) FROM fx_rates) GROUP BY currency_code""",
    "dedup": """
SELECT dt, network, currency, platform, cost, file_name, event_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY dt, network, currency, platform
    ORDER BY CASE WHEN isnan(cost) THEN NULL ELSE cost END DESC NULLS LAST, file_name, event_id) AS rn
  FROM ad_rows) WHERE rn = 1""",
    "dedup_old": """
SELECT dt, network, currency, platform, cost, file_name, event_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY dt, network, currency, platform
    ORDER BY CASE WHEN isnan(cost) THEN NULL ELSE cost END DESC NULLS LAST, file_name, event_id) AS rn
  FROM ad_rows WHERE file_no <= 3) WHERE rn = 1""",
    "dedup_new": """
SELECT dt, network, currency, platform, cost, file_name, event_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY dt, network, currency, platform
    ORDER BY CASE WHEN isnan(cost) THEN NULL ELSE cost END DESC NULLS LAST, file_name, event_id) AS rn
  FROM ad_rows WHERE file_no >= 3) WHERE rn = 1""",
    "merged": """
SELECT CASE WHEN take_s THEN s_dt ELSE t_dt END AS dt,
       CASE WHEN take_s THEN s_network ELSE t_network END AS network,
       CASE WHEN take_s THEN s_currency ELSE t_currency END AS currency,
       CASE WHEN take_s THEN s_platform ELSE t_platform END AS platform,
       CASE WHEN take_s THEN s_cost ELSE t_cost END AS cost,
       CASE WHEN take_s THEN s_file_name ELSE t_file_name END AS file_name,
       CASE WHEN take_s THEN s_event_id ELSE t_event_id END AS event_id,
       CASE WHEN in_t IS NULL THEN 'insert' WHEN in_s IS NULL THEN 'target_only'
            WHEN upd THEN 'update' ELSE 'keep' END AS merge_action
FROM (
  SELECT *, (in_t IS NULL OR upd) AS take_s FROM (
    SELECT t.dt AS t_dt, t.network AS t_network, t.currency AS t_currency, t.platform AS t_platform,
           t.cost AS t_cost, t.file_name AS t_file_name, t.event_id AS t_event_id, t.in_t,
           s.dt AS s_dt, s.network AS s_network, s.currency AS s_currency, s.platform AS s_platform,
           s.cost AS s_cost, s.file_name AS s_file_name, s.event_id AS s_event_id, s.in_s,
           COALESCE(t.in_t AND s.in_s AND t.cost < s.cost AND NOT isnan(s.cost) AND NOT isnan(t.cost), FALSE) AS upd
    FROM (SELECT *, TRUE AS in_t FROM dedup_old
          WHERE dt IS NOT NULL AND network IS NOT NULL AND currency IS NOT NULL AND platform IS NOT NULL) t
    FULL OUTER JOIN
         (SELECT *, TRUE AS in_s FROM dedup_new
          WHERE dt IS NOT NULL AND network IS NOT NULL AND currency IS NOT NULL AND platform IS NOT NULL) s
    ON t.dt = s.dt AND t.network = s.network AND t.currency = s.currency AND t.platform = s.platform))
UNION ALL
SELECT *, 'target_only' FROM dedup_old
WHERE dt IS NULL OR network IS NULL OR currency IS NULL OR platform IS NULL
UNION ALL
SELECT *, 'insert' FROM dedup_new
WHERE dt IS NULL OR network IS NULL OR currency IS NULL OR platform IS NULL""",
    "object_keys": """
SELECT DISTINCT 'in/' || CAST(dt AS VARCHAR) || '/' || file_name AS object_key FROM ad_rows""",
    "paths": """
SELECT object_key,
       CASE WHEN len(string_split(object_key, '/')) >= 2 THEN string_split(object_key, '/')[-2] END AS folder,
       string_split(object_key, '/')[-1] AS file_name,
       suffix(string_split(object_key, '/')[-1], '.parquet') AS is_parquet
FROM object_keys""",
    "renamed": """
SELECT file_name, file_hash, prev_file_name, prev_version_id FROM (
  SELECT l.file_name, l.file_hash, r.file_name AS prev_file_name, r.file_version_id AS prev_version_id,
         ROW_NUMBER() OVER (PARTITION BY l.file_name, l.file_hash ORDER BY r.file_name, r.file_version_id) AS rn
  FROM listing l JOIN registry r
    ON r.file_hash = l.file_hash AND r.file_name <> l.file_name AND r.status = 'processed') WHERE rn = 1""",
    "missing": """
SELECT file_name, file_version_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY file_name
                               ORDER BY processed_date DESC NULLS LAST, file_version_id DESC NULLS LAST) AS rn
  FROM registry WHERE status = 'processed') r
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM listing l WHERE l.file_name = r.file_name)""",
    "docs_md5": "SELECT doc_id, text, md5(text) AS content_md5 FROM documents",
    "registry_reconciled": f"""
SELECT r.file_name, CASE WHEN hit THEN NULL ELSE r.file_hash END AS file_hash, r.file_version_id,
       r.upload_date, CASE WHEN hit THEN TIMESTAMP '{RUN_TS}' ELSE r.processed_date END AS processed_date,
       CASE WHEN hit THEN 'deleted' ELSE r.status END AS status
FROM (SELECT r.*, (r.status = 'processed' AND r.file_version_id IN (SELECT file_version_id FROM missing)) AS hit
      FROM registry r) r""",
    "renamed_after": """
SELECT file_name, file_hash, prev_file_name, prev_version_id FROM (
  SELECT l.file_name, l.file_hash, r.file_name AS prev_file_name, r.file_version_id AS prev_version_id,
         ROW_NUMBER() OVER (PARTITION BY l.file_name, l.file_hash ORDER BY r.file_name, r.file_version_id) AS rn
  FROM listing l JOIN registry_reconciled r
    ON r.file_hash = l.file_hash AND r.file_name <> l.file_name AND r.status = 'processed') WHERE rn = 1""",
    # ---- one ingest run (same rules as plans/run.py, written as SQL) ----
    "files": "SELECT DISTINCT file_no FROM ad_rows",
    "lst": """
SELECT 'in/' || CASE WHEN file_no IN (1, 3) THEN '2024-01-29' ELSE '2024-01-30' END
       || '/ads_' || CAST(file_no AS VARCHAR) || '.parquet' AS object_key,
       'ads_' || CAST(file_no AS VARCHAR) || '.parquet' AS file_name,
       md5(CASE WHEN file_no = 2 THEN 'v2' ELSE '' END || 'ads_' || CAST(file_no AS VARCHAR) || '.parquet') AS file_hash,
       file_no AS src_no, CASE WHEN file_no = 2 THEN 2.0 ELSE 1.0 END AS factor
FROM files WHERE file_no <> 0
UNION ALL
SELECT 'in/2024-01-30/ads_3_copy.parquet', 'ads_3_copy.parquet', md5('ads_3.parquet'), file_no, 1.0
FROM files WHERE file_no = 3
UNION ALL
SELECT 'in/2024-01-30/manifest.csv', 'manifest.csv', md5('manifest'), NULL, NULL
FROM files WHERE file_no = 0""",
    "reg0": f"""
SELECT 'ads_' || CAST(file_no AS VARCHAR) || '.parquet' AS file_name,
       md5('ads_' || CAST(file_no AS VARCHAR) || '.parquet') AS file_hash,
       'v_ads_' || CAST(file_no AS VARCHAR) || '.parquet' AS file_version_id,
       TIMESTAMP '{REGISTRY_TS}' AS upload_date, TIMESTAMP '{REGISTRY_TS}' AS processed_date,
       'processed' AS status
FROM files WHERE file_no <= 3""",
    "tgt0": f"""
SELECT a.dt, a.network, a.currency, a.platform, a.cost, a.cost * l.rate AS cost_usd, a.file_name,
       'v_' || a.file_name AS file_version_id, TIMESTAMP '{REGISTRY_TS}' AS last_processed_timestamp
FROM (SELECT * FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY dt, network, currency, platform
          ORDER BY CASE WHEN isnan(cost) THEN NULL ELSE cost END DESC NULLS LAST, file_name, event_id) AS rn
        FROM ad_rows WHERE file_no <= 3) WHERE rn = 1) a
JOIN latest l ON a.currency = l.currency_code
WHERE a.cost * l.rate IS NOT NULL AND NOT isnan(a.cost * l.rate)""",
    "run_missing": """
SELECT file_version_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY file_name
                               ORDER BY processed_date DESC NULLS LAST, file_version_id DESC NULLS LAST) AS rn
  FROM reg0 WHERE status = 'processed') r
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM lst l WHERE l.file_name = r.file_name)""",
    "visits": """
SELECT object_key, file_name, file_hash,
       CASE WHEN n_names = 1 THEN object_key = first_key AND NOT is_live
            WHEN prev_name IS NULL THEN NOT is_live
            ELSE prev_name <> file_name END AS ingest
FROM (
  SELECT p.*,
         COUNT(DISTINCT file_name) OVER (PARTITION BY file_hash) AS n_names,
         MIN(object_key) OVER (PARTITION BY file_name, file_hash) AS first_key,
         LAG(file_name) OVER (PARTITION BY file_hash ORDER BY object_key) AS prev_name,
         EXISTS (SELECT 1 FROM reg0 r WHERE r.status = 'processed'
                 AND r.file_name = p.file_name AND r.file_hash = p.file_hash) AS is_live
  FROM lst p WHERE suffix(p.file_name, '.parquet')) q""",
    "owners": """
SELECT v.* FROM visits v
WHERE v.ingest AND v.object_key = (SELECT MAX(w.object_key) FROM visits w
                                   WHERE w.ingest AND w.file_hash = v.file_hash)""",
    "relays": """
SELECT v.* FROM visits v
WHERE v.ingest AND v.object_key < (SELECT MAX(w.object_key) FROM visits w
                                   WHERE w.ingest AND w.file_hash = v.file_hash)""",
    "dead": """
SELECT file_version_id FROM run_missing
UNION
SELECT file_version_id FROM reg0
WHERE status = 'processed' AND file_hash IN (SELECT file_hash FROM owners)""",
    "src": f"""
SELECT dt, network, currency, platform, cost, cost_usd, file_name, file_version_id,
       CAST(TIMESTAMP '{RUN_TS}' AS TIMESTAMP) AS last_processed_timestamp
FROM (
  SELECT s.*, s.cost * l.rate AS cost_usd FROM (
    SELECT * FROM (
      SELECT r.*, ROW_NUMBER() OVER (PARTITION BY dt, network, currency, platform
        ORDER BY CASE WHEN isnan(cost) THEN NULL ELSE cost END DESC NULLS LAST, object_key) AS rn
      FROM (SELECT o.object_key, o.file_name,
                   sha256(concat_ws('~', '{RUN_ID}', o.object_key, o.file_hash)) AS file_version_id,
                   a.dt, a.network, a.currency, a.platform, a.cost * l.factor AS cost
            FROM owners o JOIN lst l ON l.object_key = o.object_key
            JOIN ad_rows a ON a.file_no = l.src_no) r
      WHERE r.currency IN (SELECT currency_code FROM latest)) WHERE rn = 1) s
  JOIN latest l ON s.currency = l.currency_code)
WHERE cost_usd IS NOT NULL AND NOT isnan(cost_usd)""",
    "tgt1": "SELECT * FROM tgt0 WHERE file_version_id NOT IN (SELECT file_version_id FROM dead)",
    "tgt2": """
SELECT CASE WHEN take_s THEN s_dt ELSE t_dt END AS dt,
       CASE WHEN take_s THEN s_network ELSE t_network END AS network,
       CASE WHEN take_s THEN s_currency ELSE t_currency END AS currency,
       CASE WHEN take_s THEN s_platform ELSE t_platform END AS platform,
       CASE WHEN take_s THEN s_cost ELSE t_cost END AS cost,
       CASE WHEN take_s THEN s_cost_usd ELSE t_cost_usd END AS cost_usd,
       CASE WHEN take_s THEN s_file_name ELSE t_file_name END AS file_name,
       CASE WHEN take_s THEN s_version ELSE t_version END AS file_version_id,
       CASE WHEN take_s THEN s_ts ELSE t_ts END AS last_processed_timestamp
FROM (
  SELECT *, (in_t IS NULL OR COALESCE(in_s AND t_cost < s_cost AND NOT isnan(s_cost)
                                      AND NOT isnan(t_cost), FALSE)) AS take_s
  FROM (SELECT t.dt AS t_dt, t.network AS t_network, t.currency AS t_currency, t.platform AS t_platform,
               t.cost AS t_cost, t.cost_usd AS t_cost_usd, t.file_name AS t_file_name,
               t.file_version_id AS t_version, t.last_processed_timestamp AS t_ts, t.in_t,
               s.dt AS s_dt, s.network AS s_network, s.currency AS s_currency, s.platform AS s_platform,
               s.cost AS s_cost, s.cost_usd AS s_cost_usd, s.file_name AS s_file_name,
               s.file_version_id AS s_version, s.last_processed_timestamp AS s_ts, s.in_s
        FROM (SELECT *, TRUE AS in_t FROM tgt1 WHERE dt IS NOT NULL AND network IS NOT NULL
                AND currency IS NOT NULL AND platform IS NOT NULL) t
        FULL OUTER JOIN
             (SELECT *, TRUE AS in_s FROM src WHERE dt IS NOT NULL AND network IS NOT NULL
                AND currency IS NOT NULL AND platform IS NOT NULL) s
        ON t.dt = s.dt AND t.network = s.network AND t.currency = s.currency AND t.platform = s.platform))
UNION ALL
SELECT * FROM tgt1 WHERE dt IS NULL OR network IS NULL OR currency IS NULL OR platform IS NULL
UNION ALL
SELECT * FROM src WHERE dt IS NULL OR network IS NULL OR currency IS NULL OR platform IS NULL""",
    "reg2": f"""
SELECT r.file_name,
       CASE WHEN hit THEN NULL ELSE r.file_hash END AS file_hash,
       r.file_version_id, r.upload_date,
       CASE WHEN hit THEN TIMESTAMP '{RUN_TS}' ELSE r.processed_date END AS processed_date,
       CASE WHEN hit THEN 'deleted' ELSE r.status END AS status
FROM (SELECT r.*, (r.status = 'processed' AND r.file_version_id IN (SELECT file_version_id FROM dead)) AS hit
      FROM reg0 r) r
UNION ALL
SELECT file_name, file_hash, sha256(concat_ws('~', '{RUN_ID}', object_key, file_hash)),
       TIMESTAMP '{RUN_TS}', TIMESTAMP '{RUN_TS}', 'processed' FROM owners
UNION ALL
SELECT file_name, NULL, sha256(concat_ws('~', '{RUN_ID}', object_key, file_hash)),
       TIMESTAMP '{RUN_TS}', TIMESTAMP '{RUN_TS}', 'deleted' FROM relays""",
    "report": """
SELECT l.object_key, l.folder, l.file_name, l.file_hash,
       CASE WHEN NOT suffix(l.file_name, '.parquet') THEN 'skipped'
            WHEN NOT v.ingest THEN 'unchanged'
            WHEN o.object_key IS NOT NULL THEN 'ingested' ELSE 'relayed' END AS action
FROM (SELECT object_key, string_split(object_key, '/')[-2] AS folder, file_name, file_hash FROM lst) l
LEFT JOIN visits v ON v.object_key = l.object_key
LEFT JOIN owners o ON o.object_key = l.object_key""",
}

# Which views each query needs (dependencies first).
_NEEDS = {
    "ad_rows": [], "fx_rates": [], "registry": [], "listing": [],
    "latest": ["fx_rates"], "snapshot": ["fx_rates"],
    "dedup": ["ad_rows"], "dedup_old": ["ad_rows"], "dedup_new": ["ad_rows"],
    "merged": ["dedup_old", "dedup_new"],
    "object_keys": ["ad_rows"], "paths": ["object_keys"],
    "renamed": ["listing", "registry"], "missing": ["listing", "registry"],
    "docs_md5": [],
    "registry_reconciled": ["registry", "missing"], "renamed_after": ["listing", "registry_reconciled"],
    "files": ["ad_rows"], "lst": ["files"], "reg0": ["files"], "tgt0": ["ad_rows", "latest"],
    "run_missing": ["reg0", "lst"], "visits": ["lst", "reg0"], "owners": ["visits"],
    "relays": ["visits"], "dead": ["run_missing", "owners"],
    "src": ["owners", "lst", "ad_rows", "latest"], "tgt1": ["tgt0", "dead"],
    "tgt2": ["tgt1", "src"], "reg2": ["reg0", "dead", "owners", "relays"],
    "report": ["lst", "visits", "owners"],
}


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(n):
        for m in _NEEDS[n]:
            visit(m)
        if n not in order:
            order.append(n)
    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]}\n)" for n in order) + "\n"


def _tombstone(dead_sql: str) -> str:
    return f"""
SELECT r.file_name,
       CASE WHEN hit THEN NULL ELSE r.file_hash END AS file_hash,
       r.file_version_id, r.upload_date,
       CASE WHEN hit THEN TIMESTAMP '{RUN_TS}' ELSE r.processed_date END AS processed_date,
       CASE WHEN hit THEN 'deleted' ELSE r.status END AS status
FROM (SELECT r.*, (r.status = 'processed' AND r.file_version_id IN ({dead_sql})) AS hit
      FROM registry r) r"""


_USD_DROP = "WHERE a.cost * l.rate IS NOT NULL AND NOT isnan(a.cost * l.rate)"

_ODD_NAME = "CASE no % {} {} END".format(len(ODD_NAMES), " ".join(
    "WHEN {} THEN '{}' || CAST(no AS VARCHAR) || '{}'".format(k, *n.split("{}")) for k, n in enumerate(ODD_NAMES)))

SQL: dict[str, str] = {
    "flagship_ad_spend": _with("dedup", "latest") + f"""
SELECT a.dt, a.network, a.currency, a.platform, a.cost, a.cost * l.rate AS cost_usd, a.file_name, a.event_id
FROM dedup a JOIN latest l ON a.currency = l.currency_code {_USD_DROP}""",
    "file_ingest_end_state": _with("ad_rows", "latest") + f"""
, named AS (SELECT a.*, event_id % n AS no FROM ad_rows a, (SELECT {MIN_FILES} + count(*) // {EVENTS_PER_FILE} AS n FROM ad_rows)),
files AS (SELECT dt, network, currency, platform, cost, {_ODD_NAME} AS file_name FROM named),
best AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY dt, network, currency, platform
    ORDER BY CASE WHEN isnan(cost) THEN NULL ELSE cost END DESC NULLS LAST, file_name) AS rn FROM files)
SELECT a.dt, a.network, a.currency, a.platform, a.cost, a.cost * l.rate AS cost_usd, a.file_name
FROM (SELECT * FROM best WHERE rn = 1) a JOIN latest l ON a.currency = l.currency_code {_USD_DROP}""",
    "ingest_copies_report": """
WITH l AS (SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey AS k FROM orders),
named AS (SELECT key, k, CASE WHEN k % 101 = 0 THEN 'x_' || key || '.csv' WHEN k % 3 = 0 THEN 'c_' || CAST(k % 1000 AS VARCHAR) || '.parquet'
                    ELSE 'f_' || key || '.parquet' END AS file_name,
          CASE WHEN k % 3 = 0 THEN md5('shared') WHEN k % 50 = 1 THEN NULL ELSE md5(key) END AS file_hash FROM l),
listing AS (SELECT 'in/' || key || '/' || file_name AS object_key, * FROM named),
live AS (SELECT DISTINCT file_name, file_hash FROM listing WHERE (k % 4 = 1 AND starts_with(file_name, 'f_')) OR file_name = 'c_3.parquet'),
v AS (SELECT a.*, live.file_name IS NOT NULL AS is_live,
             lag(a.file_name) OVER w AS prev, ROW_NUMBER() OVER w AS rn,
             min(a.file_name) OVER (PARTITION BY a.file_hash) < max(a.file_name) OVER (PARTITION BY a.file_hash) AS copied
      FROM listing a LEFT JOIN live ON a.file_name = live.file_name AND a.file_hash = live.file_hash
      WHERE a.file_name LIKE '%.parquet' WINDOW w AS (PARTITION BY a.file_hash ORDER BY a.object_key)),
i AS (SELECT *, CASE WHEN file_hash IS NULL THEN TRUE WHEN NOT copied THEN rn = 1 AND NOT is_live
                WHEN prev IS NULL THEN NOT is_live ELSE prev <> file_name END AS ingest FROM v),
f AS (SELECT *, file_hash IS NULL OR object_key = max(CASE WHEN ingest THEN object_key END) OVER (PARTITION BY file_hash) AS final FROM i)
SELECT listing.object_key, listing.file_hash,
       CASE WHEN f.object_key IS NULL THEN 'skipped' WHEN NOT ingest THEN 'unchanged' WHEN final THEN 'ingested' ELSE 'relayed' END AS action
FROM listing LEFT JOIN f USING (object_key)""",
    "ad_rows_scan": _with("ad_rows") + "SELECT * FROM ad_rows",
    "cast_ad_rows": """
SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority_num,
       TRY_CAST(o_orderstatus AS DOUBLE) AS status_num,
       CAST((CASE WHEN substr(o_orderpriority, 1, 1) IS NOT NULL
                   AND TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) IS NULL THEN 1 ELSE 0 END)
          + (CASE WHEN o_orderstatus IS NOT NULL AND TRY_CAST(o_orderstatus AS DOUBLE) IS NULL
                  THEN 1 ELSE 0 END) AS INTEGER) AS cast_failures
FROM orders""",
    "dedup_max_cost": _with("dedup") + "SELECT * FROM dedup",
    "sort_cost": _with("ad_rows") + """
SELECT event_id, cost, file_name FROM ad_rows
ORDER BY CASE WHEN isnan(cost) THEN NULL ELSE cost END DESC NULLS LAST, event_id""",
    "sort_cost_rank": _with("ad_rows") + """
SELECT event_id, cost, file_name,
       ROW_NUMBER() OVER (ORDER BY CASE WHEN isnan(cost) THEN NULL ELSE cost END DESC NULLS LAST,
                                   event_id) AS cost_rank
FROM ad_rows""",
    "latest_rate": _with("latest") + "SELECT * FROM latest",
    "rates_snapshot": _with("snapshot") + "SELECT * FROM snapshot",
    "rates_explode": """
SELECT event_id AS payload_id, CAST(ts AS DATE) AS date, k AS currency_code,
       CAST(json_extract_string(props, '$."' || k || '"') AS DOUBLE) AS rate
FROM (SELECT *, unnest(json_keys(props)) AS k FROM events)""",
    "cost_usd": _with("ad_rows", "latest") + f"""
SELECT a.event_id, a.currency, a.cost, l.rate, a.cost * l.rate AS cost_usd
FROM ad_rows a JOIN latest l ON a.currency = l.currency_code {_USD_DROP}""",
    "cost_usd_legacy": _with("ad_rows", "latest") + """
SELECT a.event_id, a.currency, a.cost, l.rate,
       CASE WHEN l.rate <> 0 AND NOT isnan(a.cost * l.rate) THEN a.cost * l.rate END AS cost_usd
FROM ad_rows a LEFT JOIN latest l ON a.currency = l.currency_code""",
    "distinct_currencies": _with("ad_rows") +
        "SELECT DISTINCT currency FROM ad_rows WHERE currency IS NOT NULL",
    "stamp_lineage": _with("dedup", "latest") + f"""
SELECT a.dt, a.network, a.currency, a.platform, a.cost, a.cost * l.rate AS cost_usd, a.file_name, a.event_id,
       sha256(concat_ws('~', '{RUN_ID}', a.file_name)) AS file_version_id,
       TIMESTAMP '{RUN_TS}' AS last_processed_timestamp
FROM dedup a JOIN latest l ON a.currency = l.currency_code {_USD_DROP}""",
    "path_split": _with("paths") + "SELECT * FROM paths",
    "late_file_check": _with("paths") + f"""
SELECT bool_or(folder = '{RUN_DATE}' AND is_parquet) AS found_today_file,
       COUNT(*) AS n_objects,
       COUNT(*) FILTER (WHERE is_parquet) AS n_parquet,
       COUNT(*) FILTER (WHERE folder = '{RUN_DATE}') AS n_today
FROM paths""",
    "content_md5": """
SELECT doc_id, md5(text) AS content_md5, to_base64(unhex(md5(text))) AS content_md5_b64,
       octet_length(encode(text)) AS n_bytes
FROM documents""",
    "unique_content": _with("docs_md5") + """
SELECT doc_id, content_md5 FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY content_md5 ORDER BY doc_id) AS rn FROM docs_md5)
WHERE rn = 1""",
    "file_version_id": _with("docs_md5") + f"""
SELECT doc_id, sha256(concat_ws('~', '{RUN_ID}', CAST(doc_id AS VARCHAR), content_md5)) AS file_version_id
FROM docs_md5""",
    "files_unchanged": _with("listing", "registry") + """
SELECT l.file_name, l.file_hash FROM listing l WHERE EXISTS (
  SELECT 1 FROM registry r WHERE r.status = 'processed'
   AND r.file_name = l.file_name AND r.file_hash = l.file_hash)""",
    "files_new": _with("listing", "registry") + """
SELECT l.file_name, l.file_hash FROM listing l WHERE NOT EXISTS (
  SELECT 1 FROM registry r WHERE r.status = 'processed'
   AND r.file_name = l.file_name AND r.file_hash = l.file_hash)""",
    "files_reuploaded": _with("listing", "registry") + """
SELECT l.file_name, l.file_hash FROM listing l
WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.status = 'processed'
                  AND r.file_name = l.file_name AND r.file_hash = l.file_hash)
  AND EXISTS (SELECT 1 FROM registry r WHERE r.status = 'processed' AND r.file_name = l.file_name)""",
    "files_missing": _with("missing") + "SELECT * FROM missing",
    "listing_names": _with("listing") + "SELECT DISTINCT file_name FROM listing",
    "names_except": _with("listing", "registry") + """
SELECT file_name FROM registry WHERE status = 'processed'
EXCEPT SELECT file_name FROM listing""",
    "files_renamed": _with("renamed") + "SELECT * FROM renamed",
    "files_renamed_after_reconcile": _with("renamed_after") + "SELECT * FROM renamed_after",
    "content_owner": _with("listing") + """
SELECT file_hash, arg_max(file_name, object_key) AS owner_file_name, MAX(object_key) AS owner_key,
       COUNT(DISTINCT file_name) AS n_names
FROM listing GROUP BY file_hash""",
    "registry_last_version": _with("registry") + """
SELECT file_name, file_version_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY file_name
                               ORDER BY processed_date DESC NULLS LAST, file_version_id DESC NULLS LAST) AS rn
  FROM registry WHERE status = 'processed') WHERE rn = 1""",
    "registry_upsert": _with("listing", "registry") + f""",
records AS (
  SELECT l.file_name, l.file_hash,
         sha256(concat_ws('~', '{RUN_ID}', l.file_name, l.file_hash)) AS file_version_id,
         'processed' AS status
  FROM listing l WHERE NOT EXISTS (
    SELECT 1 FROM registry r WHERE r.status = 'processed'
     AND r.file_name = l.file_name AND r.file_hash = l.file_hash)
  UNION ALL
  SELECT r.file_name, r.file_hash, r.file_version_id, 'processed' FROM registry r
  WHERE r.status = 'processed' AND EXISTS (
    SELECT 1 FROM listing l WHERE l.file_name = r.file_name AND l.file_hash = r.file_hash))
SELECT CASE WHEN r.file_version_id IS NOT NULL THEN r.file_name ELSE n.file_name END AS file_name,
       CASE WHEN n.file_version_id IS NOT NULL THEN n.file_hash ELSE r.file_hash END AS file_hash,
       COALESCE(r.file_version_id, n.file_version_id) AS file_version_id,
       CASE WHEN r.file_version_id IS NOT NULL THEN r.upload_date ELSE TIMESTAMP '{RUN_TS}' END AS upload_date,
       CASE WHEN n.file_version_id IS NOT NULL THEN TIMESTAMP '{RUN_TS}' ELSE r.processed_date END AS processed_date,
       CASE WHEN n.file_version_id IS NOT NULL THEN n.status ELSE r.status END AS status
FROM registry r FULL OUTER JOIN records n ON r.file_version_id = n.file_version_id""",
    "registry_tombstone": _with("renamed") + _tombstone("SELECT prev_version_id FROM renamed"),
    "reconcile": _with("missing") + _tombstone("SELECT file_version_id FROM missing"),
    "merge_max_cost": _with("merged") + "SELECT * FROM merged",
    "delete_by_version": _with("merged") + """
SELECT dt, network, currency, platform, cost, file_name, event_id FROM merged m
WHERE NOT EXISTS (SELECT 1 FROM ad_rows a WHERE a.file_no % 3 = 2 AND a.file_name = m.file_name)""",
    "outer_consolidate": _with("dedup_old", "dedup_new", "snapshot") + """,
e AS (SELECT a.dt, a.network, a.currency, a.platform, a.cost, a.cost * s.rate AS cost_usd
      FROM dedup_old a JOIN snapshot s ON a.currency = s.currency_code
      WHERE a.cost * s.rate IS NOT NULL AND NOT isnan(a.cost * s.rate)),
n AS (SELECT a.dt, a.network, a.currency, a.platform, a.cost, a.cost * s.rate AS cost_usd
      FROM dedup_new a JOIN snapshot s ON a.currency = s.currency_code
      WHERE a.cost * s.rate IS NOT NULL AND NOT isnan(a.cost * s.rate))
SELECT CASE WHEN e_in THEN e_dt ELSE n_dt END AS dt,
       CASE WHEN e_in THEN e_network ELSE n_network END AS network,
       CASE WHEN e_in THEN e_currency ELSE n_currency END AS currency,
       CASE WHEN e_in THEN e_platform ELSE n_platform END AS platform,
       CASE WHEN take_n THEN n_cost ELSE e_cost END AS cost,
       CASE WHEN take_n THEN n_usd ELSE e_usd END AS cost_usd
FROM (
  SELECT *, (n_usd IS NOT NULL AND NOT isnan(n_usd) AND (e_usd IS NULL OR isnan(e_usd)
             OR COALESCE(e_cost < n_cost AND NOT isnan(n_cost) AND NOT isnan(e_cost), FALSE))) AS take_n
  FROM (SELECT e.dt AS e_dt, e.network AS e_network, e.currency AS e_currency, e.platform AS e_platform,
               e.cost AS e_cost, e.cost_usd AS e_usd, e.e_in,
               n.dt AS n_dt, n.network AS n_network, n.currency AS n_currency, n.platform AS n_platform,
               n.cost AS n_cost, n.cost_usd AS n_usd
        FROM (SELECT *, TRUE AS e_in FROM e) e FULL OUTER JOIN n
          ON e.dt IS NOT DISTINCT FROM n.dt AND e.network IS NOT DISTINCT FROM n.network
         AND e.currency IS NOT DISTINCT FROM n.currency AND e.platform IS NOT DISTINCT FROM n.platform))""",
    "consolidate_max": _with("ad_rows", "snapshot") + """,
per_file AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY dt, network, currency, platform, file_name
      ORDER BY CASE WHEN isnan(cost) THEN NULL ELSE cost END DESC NULLS LAST, event_id) AS rn
    FROM ad_rows) WHERE rn = 1),
conv AS (SELECT a.*, a.cost * s.rate AS cost_usd FROM per_file a JOIN snapshot s ON a.currency = s.currency_code
         WHERE a.cost * s.rate IS NOT NULL AND NOT isnan(a.cost * s.rate))
SELECT dt, network, currency, platform,
       MAX(CASE WHEN isnan(cost) THEN NULL ELSE cost END) AS cost,
       arg_max(cost_usd, CASE WHEN isnan(cost) THEN NULL ELSE cost END) AS cost_usd
FROM conv GROUP BY dt, network, currency, platform""",
    "ingest_end_state": _with("tgt2") + "SELECT * FROM tgt2",
    "ingest_registry": _with("reg2") + "SELECT * FROM reg2",
    "ingest_report": _with("report") + "SELECT * FROM report",
    "ingest_summary": _with("report", "dead") + f"""
SELECT bool_or(folder = '{RUN_DATE}' AND suffix(file_name, '.parquet')) AS found_today_file,
       COUNT(*) FILTER (WHERE action = 'skipped') AS n_skipped,
       COUNT(*) FILTER (WHERE action = 'unchanged') AS n_unchanged,
       COUNT(*) FILTER (WHERE action = 'ingested') AS n_ingested,
       COUNT(*) FILTER (WHERE action = 'relayed') AS n_relayed,
       COUNT(*) FILTER (WHERE action = 'rejected') AS n_rejected,
       (SELECT COUNT(*) FROM dead) AS n_dead_versions
FROM report""",
    "union_files": _with("ad_rows") + """
SELECT dt, network, currency, platform, cost, file_name, event_id FROM ad_rows WHERE file_no % 2 = 0
UNION ALL
SELECT dt, network, currency, NULL AS platform, cost, file_name, event_id FROM ad_rows WHERE file_no % 2 = 1""",
}
