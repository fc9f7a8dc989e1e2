"""The same queries in DuckDB SQL, written apart from the Spark code."""

from __future__ import annotations

_VIEWS = r"""
shard_rows AS (
  SELECT printf('%05d%04d', d.doc_id // 100, d.doc_id % 100) AS key,
    printf('%05d', d.doc_id // 100) AS shard,
    sha256(d.text) AS sha256,
    concat('https://', d.source, '.example.org/', d.lang, '/', d.doc_id) AS url,
    CASE WHEN l.quality = 0 THEN '' ELSE d.text END AS caption,
    concat('doc-', d.doc_id) AS original_key,
    CASE WHEN l.toxic = 1 THEN 'failed_to_download' ELSE 'success' END AS status,
    CAST(CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE d.n_chars % 1024 END AS INT) AS width,
    CAST(d.doc_id % 768 AS INT) AS height,
    CAST(d.n_chars AS INT) AS original_width, CAST(d.doc_id AS INT) AS original_height,
    md5(d.text) AS md5, d.lang AS tags, concat(d.lang, ', ', d.source) AS merged_tags, d.doc_id
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
shard_meta AS (SELECT * FROM shard_rows WHERE doc_id % 5 <> 0),
sidecars AS (
  SELECT shard, key, CASE WHEN doc_id % 15 = 0 THEN '{"key":'
    ELSE concat('{"key":"', key, '","caption":"', md5, '","url":"', url, '","width":',
                coalesce(CAST(width AS VARCHAR), 'null'), '}') END AS body
  FROM shard_rows WHERE doc_id % 5 = 0 AND doc_id % 20 <> 0),
asset_docs AS (
  SELECT doc_id, printf('%05d%04d', doc_id // 100, doc_id % 100) AS key,
    unnest(CASE WHEN doc_id % 10 = 0 THEN ['webp', 'png'] WHEN doc_id % 4 = 0 THEN ['jpg']
      WHEN doc_id % 4 = 1 THEN ['jpeg'] WHEN doc_id % 4 = 2 THEN ['png'] ELSE ['webp'] END) AS ext
  FROM documents),
asset_files AS (
  SELECT concat('images/', key[1:5], '/', key, '.', ext) AS path, key, ext, key[1:5] AS shard FROM asset_docs),
asset_files_dirs AS (
  SELECT concat('images/', dir, '/', key, '.', ext) AS path, key, ext, dir AS shard FROM (
    SELECT *, CASE WHEN doc_id % 100 = 48 THEN 'tmp' ELSE key[1:5] END AS dir FROM asset_docs)),
page_assets AS (
  SELECT page_id, printf('%05d%04d', page_id // 100, page_id % 100) AS key,
    printf('images/%05d/%05d%04d.html', page_id // 100, page_id // 100, page_id % 100) AS path, html FROM pages),
page_validity AS (
  SELECT page_id, key, path, error IS NULL AS is_valid, error FROM (
    SELECT *, CASE WHEN length(html) = 0 THEN 'missing_or_empty'
      WHEN NOT regexp_matches(html, '^ *(?i)<!doctype html') THEN 'bad_head'
      WHEN NOT regexp_matches(html, '(?i)</html>[ \t\r\n]*$') THEN 'bad_tail' END AS error FROM page_assets)),
processed AS (
  SELECT printf('%05d%04d', doc_id // 100, doc_id % 100) AS key FROM labels
  UNION SELECT printf('%05d%04d', doc_id // 100, doc_id % 100) FROM documents WHERE doc_id % 7 = 0),
pending_keys AS (
  SELECT key FROM shard_rows WHERE key NOT IN (SELECT key FROM processed)),
captions AS (
  SELECT key, arg_max(caption, doc_id) AS caption FROM shard_rows WHERE status = 'success' GROUP BY key),
preferred AS (
  SELECT key, arg_min(path, list_position(['jpg', 'jpeg', 'png', 'webp'], ext)) AS path FROM asset_files GROUP BY key),
enriched_all AS (
  SELECT p.path, p.key, m.key IS NOT NULL AS matched, s.body,
    CASE WHEN s.body IS NOT NULL AND json_valid(s.body) THEN s.body END AS good,
    m.caption AS m_caption, m.url AS m_url, m.width AS m_width, m.height, m.original_width, m.original_height,
    m.sha256 AS m_sha256, m.original_key AS m_original_key, m.md5 AS m_md5, m.tags AS m_tags,
    m.merged_tags AS m_merged_tags
  FROM preferred p LEFT JOIN shard_meta m ON p.key = m.key LEFT JOIN sidecars s ON p.key = s.key),
enriched AS (
  SELECT path, key,
    CASE WHEN matched THEN m_caption WHEN good IS NOT NULL THEN good ->> '$.caption' ELSE '' END AS caption,
    CASE WHEN matched THEN m_url WHEN good IS NOT NULL THEN good ->> '$.url' ELSE '' END AS url,
    CASE WHEN matched THEN m_width WHEN good IS NOT NULL THEN CAST(good ->> '$.width' AS INT) END AS width,
    height, original_width, original_height,
    CASE WHEN matched THEN m_sha256 ELSE '' END AS sha256,
    CASE WHEN matched THEN m_original_key ELSE '' END AS original_key,
    CASE WHEN matched THEN m_md5 ELSE '' END AS md5,
    CASE WHEN matched THEN m_tags ELSE '' END AS tags,
    CASE WHEN matched THEN m_merged_tags ELSE '' END AS merged_tags
  FROM enriched_all WHERE matched OR body IS NULL OR good IS NOT NULL),
pending_rows AS (
  SELECT *, row_number() OVER (ORDER BY key) - 1 AS gidx FROM shard_rows
  WHERE key NOT IN (SELECT key FROM processed)),
stored AS (
  SELECT *, gidx // 50 AS batch_id, contains(caption, ' the ') AS failed FROM pending_rows),
damage AS (
  SELECT printf('%05d%04d', d.doc_id // 100, d.doc_id % 100) AS key, printf('%05d', d.doc_id // 100) AS shard,
    greatest(1, (strlen(d.text) + 63) // 64) AS lines,
    CASE WHEN l.quality = 0 THEN 'cut' WHEN l.toxic = 1 THEN 'garbled' WHEN d.doc_id % 11 = 3 THEN 'thumbnail'
      WHEN d.doc_id % 11 = 5 THEN 'thumbnail_cut' WHEN d.doc_id % 11 = 7 THEN 'bad_crc' WHEN d.doc_id % 11 = 8 THEN 'webp'
      WHEN d.doc_id % 11 = 9 THEN 'webp_cut' ELSE 'none' END AS kind
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
walked AS (
  SELECT *, CASE kind WHEN 'cut' THEN 'truncated_png' WHEN 'thumbnail_cut' THEN 'truncated_jpeg' WHEN 'bad_crc' THEN 'bad_crc'
      WHEN 'webp_cut' THEN 'truncated_webp' END AS problem,
    CASE WHEN kind LIKE 'thumbnail%' THEN 'jpeg' WHEN kind LIKE 'webp%' THEN 'webp' ELSE 'png' END AS container FROM damage)
"""

def _first_words(column: str) -> str:
    """What the captioner of the queries says: all words, a blank between."""
    return rf"array_to_string(regexp_extract_all({column}, '[^ \t\r\n\f]+'), ' ')"


_RECORD = (
    "key, caption, url, width, height, original_width, original_height, sha256, original_key, md5, tags, merged_tags"
)

_BODIES = {
    "source_projection": """
        SELECT concat('https://', source, '.example.org/', lang, '/', doc_id) AS url, text AS caption,
          concat('doc-', doc_id) AS original_key, md5(text) AS md5, lang AS tags,
          concat(lang, ', ', source) AS merged_tags FROM documents""",
    "assign_keys": """
        SELECT doc_id, i AS gidx, printf('%05d%04d', i // 100, i % 100) AS key, printf('%05d', i // 100) AS shard
        FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)""",
    "assign_keys_far": """
        SELECT doc_id, i AS gidx, printf('%05d%04d', i // 10000, i % 10000) AS key, printf('%05d', i // 10000) AS shard
        FROM (SELECT doc_id, 999999999 + row_number() OVER (ORDER BY doc_id) AS i FROM documents)""",
    "fetch_status": """
        SELECT r.key, r.url, r.original_key, CASE WHEN p.html IS NOT NULL THEN sha256(p.html) END AS sha256,
          CAST(strlen(p.html) AS BIGINT) AS n_bytes,
          CASE WHEN p.html IS NOT NULL THEN 'success' ELSE 'failed_to_download' END AS status
        FROM shard_rows r LEFT JOIN page_assets p ON r.key = p.key""",
    "fetch_files": """
        SELECT r.key, r.shard, CASE WHEN p.html IS NOT NULL THEN 'success' ELSE 'failed_to_download' END AS status,
          CAST(CASE WHEN p.html IS NOT NULL THEN 1 ELSE 4 END AS INT) AS attempts,
          CASE WHEN p.html IS NOT NULL THEN sha256(p.html) END AS sha256, r.original_key, r.md5
        FROM shard_rows r LEFT JOIN page_assets p ON r.key = p.key""",
    "fetch_incremental": """
        SELECT key, shard, url FROM shard_rows WHERE shard NOT IN (
          SELECT printf('%05d', doc_id // 100) FROM labels GROUP BY 1 HAVING sum(toxic) * 8 <= count(*))""",
    "payload_hash": """
        SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS n_bytes
        FROM documents""",
    "payload_sizes": """
        SELECT key, 64 AS width, CAST(CASE WHEN container = 'jpeg' THEN (lines + 7) // 8 * 8 ELSE lines END AS INT) AS height FROM walked""",
    "discover_shards": """
        SELECT DISTINCT split_part(path, '/', -2) AS shard FROM asset_files_dirs
        WHERE regexp_matches(split_part(path, '/', -2), '^[0-9]+$')""",
    "list_assets": "SELECT path, key, ext FROM asset_files WHERE ext IN ('jpg', 'jpeg', 'png', 'webp')",
    "list_shard_assets": "SELECT path, shard, key FROM asset_files_dirs WHERE ext = 'jpg' AND shard <> 'tmp'",
    "list_assets_any_dir": "SELECT path, shard, key FROM asset_files_dirs WHERE ext = 'jpg'",
    "limit_assets": "SELECT path FROM asset_files ORDER BY path LIMIT 100",
    "parse_path": """
        SELECT path, key AS stem, shard AS parent, key[1:5] AS key_shard, ext,
          replace(path, concat('.', ext), '.json') AS sidecar_path, shard = key[1:5] AS shard_agrees
        FROM asset_files_dirs""",
    "unify_shards": """
        SELECT key, caption, status, url, width, height,
          CASE WHEN CAST(shard AS INT) % 3 <> 2 THEN original_width END AS original_width,
          CASE WHEN CAST(shard AS INT) % 3 <> 2 THEN original_height END AS original_height,
          sha256, original_key, md5, tags, merged_tags, shard FROM shard_rows""",
    "unify_audit": """
        SELECT shard, count(*) AS rows, CAST(1 AS BIGINT) AS files_left_out FROM shard_rows GROUP BY shard""",
    "success_captions": "SELECT key, caption FROM shard_rows WHERE status = 'success'",
    "shard_status": "SELECT shard, status, count(*) AS rows FROM shard_rows GROUP BY ALL",
    "key_caption_last": "SELECT source AS key, arg_max(text, doc_id) AS caption FROM documents GROUP BY source",
    "ext_priority": "SELECT key, path FROM preferred",
    "manifest_validated": """
        SELECT f.path AS video, c.caption AS prompt FROM preferred f JOIN captions c ON f.key = c.key
        WHERE c.caption <> '' AND f.key IN (SELECT key FROM page_validity WHERE is_valid)""",
    "manifest_listing": """
        SELECT f.path AS video, c.caption AS prompt FROM asset_files f JOIN captions c ON f.key = c.key
        WHERE c.caption <> ''""",
    "manifest_sidecar": """
        SELECT f.path AS video,
          coalesce(CASE WHEN json_valid(s.body) THEN s.body ->> '$.caption' END, '') AS prompt
        FROM asset_files f LEFT JOIN sidecars s ON f.key = s.key""",
    "manifest_counters": """
        SELECT count(*) FILTER (told AND file) AS matched, count(*) FILTER (NOT told) AS missing_caption,
          count(*) FILTER (told AND NOT file) AS no_file
        FROM (SELECT coalesce(c.caption <> '', false) AS told, f.key IS NOT NULL AS file
          FROM (SELECT DISTINCT key FROM page_validity WHERE is_valid) v
          LEFT JOIN captions c ON v.key = c.key LEFT JOIN preferred f ON v.key = f.key)""",
    "manifest_file_counters": """
        SELECT count(*) FILTER (told AND valid) AS matched, count(*) FILTER (NOT told) AS missing_caption,
          count(*) FILTER (told AND NOT valid) AS corrupt
        FROM (SELECT coalesce(c.caption <> '', false) AS told, coalesce(v.is_valid, false) AS valid
          FROM asset_files f LEFT JOIN captions c ON f.key = c.key LEFT JOIN page_validity v ON f.key = v.key)""",
    "metadata_enrich": f"SELECT path, {_RECORD} FROM enriched",
    "enrich_rejects": """
        SELECT key, path, 'bad_sidecar' AS error FROM enriched_all
        WHERE NOT matched AND body IS NOT NULL AND good IS NULL""",
    "captioned_rows": f"""
        SELECT key, original_key, url, caption AS original_caption, {_first_words('caption')} AS vlm_caption,
          width, height, original_width, original_height, sha256, md5, tags, merged_tags
        FROM enriched WHERE key NOT IN (SELECT key FROM processed)""",
    "url_dataset": """
        SELECT key, url, caption AS original_caption, md5 AS vlm_caption,
          coalesce(width, 0) AS width, coalesce(height, 0) AS height FROM enriched""",
    "sidecar_caption": """
        SELECT event_id, CASE WHEN event_id % 17 = 0 OR event_type = 'error' THEN '' ELSE event_type END AS caption
        FROM events""",
    "validate_html": "SELECT page_id, key, is_valid FROM page_validity",
    "validate_split": "SELECT page_id, path, is_valid, error FROM page_validity",
    "validate_counts": "SELECT is_valid, count(*) AS rows FROM page_validity GROUP BY is_valid",
    "valid_keys": "SELECT DISTINCT key FROM page_validity WHERE is_valid",
    "corrupt_log": "SELECT path, error FROM page_validity WHERE NOT is_valid",
    "progress_counts": """
        SELECT bucket, valid, corrupt, CAST(sum(valid) OVER w AS BIGINT) AS valid_so_far,
          CAST(sum(corrupt) OVER w AS BIGINT) AS corrupt_so_far
        FROM (SELECT i // 50 AS bucket, count(*) FILTER (is_valid) AS valid, count(*) FILTER (NOT is_valid) AS corrupt
          FROM (SELECT is_valid, row_number() OVER (ORDER BY page_id) - 1 AS i FROM page_validity) GROUP BY 1)
        WINDOW w AS (ORDER BY bucket ROWS UNBOUNDED PRECEDING)""",
    "validate_content": "SELECT key, container AS format, problem IS NULL AS is_valid, problem AS error FROM walked",
    "validate_decode": """
        SELECT key, shard, problem IS NULL AND kind <> 'garbled' AS is_valid,
          CASE WHEN kind = 'garbled' THEN 'undecodable' ELSE problem END AS error,
          CASE WHEN container = 'webp' THEN 'structural' ELSE 'decode' END AS check_level FROM walked""",
    "delete_plan_all": """
        SELECT path FROM asset_files WHERE key IN (SELECT key FROM page_validity WHERE NOT is_valid)""",
    "delete_plan_pair": """
        SELECT path FROM page_validity WHERE NOT is_valid
        UNION SELECT concat('images/', shard, '/', key, '.json') FROM sidecars
        WHERE key IN (SELECT key FROM page_validity WHERE NOT is_valid)""",
    "checkpoint_keys": "SELECT key FROM processed",
    "checkpoint_files": "SELECT key FROM processed",
    "pending": "SELECT key FROM pending_keys",
    "skip_counts": """
        SELECT count(*) FILTER (done) AS skipped, count(*) FILTER (NOT done) AS to_do
        FROM (SELECT key IN (SELECT key FROM processed) AS done FROM shard_rows)""",
    "batch_assign": """
        SELECT i // 50 AS batch_id, count(*) AS rows
        FROM (SELECT row_number() OVER (ORDER BY key) - 1 AS i FROM shard_rows) GROUP BY 1""",
    "batch_names": """
        SELECT batch_id, rows,
          printf('intermediate_%08d', CASE WHEN rows = 50 THEN batch_id * 50 + 49 ELSE batch_id * 50 + rows END)
            AS checkpoint_name,
          CASE WHEN rows = 50 THEN printf('batch_%05d', batch_id + 1) END AS publish_name
        FROM (SELECT gidx // 50 AS batch_id, count(*) AS rows FROM pending_rows GROUP BY 1)""",
    "publish_manifest": """
        SELECT batch_id, count(*) FILTER (NOT failed) AS rows,
          printf('publish_name=batch_%05d', batch_id + 1) AS path
        FROM stored GROUP BY batch_id HAVING count(*) = 50""",
    "publish_complete": f"""
        SELECT key, original_key, url, caption AS original_caption, {_first_words('caption')} AS vlm_caption,
          width, height, original_width, original_height, sha256, md5, tags, merged_tags
        FROM stored WHERE NOT failed""",
    "rejected_rows": "SELECT key, batch_id FROM stored WHERE failed",
    "final_dedupe": f"""
        SELECT key, original_key, url, caption AS original_caption,
          concat({_first_words('caption')}, ' (again)') AS vlm_caption,
          width, height, original_width, original_height, sha256, md5, tags, merged_tags
        FROM stored WHERE NOT failed""",
    "caption_rows_udf": f"SELECT doc_id, {_first_words('text')} AS vlm_caption FROM documents",
    "caption_error_empty": f"""
        SELECT doc_id, CASE WHEN contains(text, ' the ') THEN '' ELSE {_first_words('text')} END AS vlm_caption
        FROM documents""",
    "caption_reject": f"""
        SELECT doc_id, {_first_words('text')} AS vlm_caption FROM documents WHERE NOT contains(text, ' the ')""",
    "stream_ingest": "SELECT key, caption FROM shard_rows WHERE status = 'success'",
    "stream_dedupe": "SELECT key, url, status, sha256 FROM shard_rows",
}

# A sink read back gives what was written.
_BODIES |= {"csv_round_trip": _BODIES["manifest_validated"], "parquet_round_trip": _BODIES["source_projection"]}


def _with_views(body: str) -> str:
    return f"WITH {_VIEWS.strip()}\n{body.strip()}"


ORACLE = {name: _with_views(body) for name, body in _BODIES.items()}
