"""DuckDB oracle SQL for the ingest-snapshot queries."""

from __future__ import annotations

_MONTHS = ("['ENERO','FEBRERO','MARZO','ABRIL','MAYO','JUNIO','JULIO','AGOSTO','SEPTIEMBRE',"
           "'OCTUBRE','NOVIEMBRE','DICIEMBRE']")
_STATUSES = "['downloaded','unchanged','updated_version','recovered_copy']"

REC = f"""x AS (
  SELECT *, CASE lang WHEN 'en' THEN '.xlsx' WHEN 'fr' THEN '.xls' WHEN 'de' THEN '.csv' ELSE '.pdf' END AS ext,
         {_MONTHS}[doc_id % 12 + 1] AS mname, CAST(2000 + doc_id % 7 AS INTEGER) AS yr,
         n_chars < 200 AS failed,
         CASE WHEN lang = 'de' THEN 'v1' ELSE 'v2' END AS layout
  FROM documents),
x2 AS (SELECT *, 'informe_' || lower(mname) || '_' || CAST(yr AS VARCHAR) || ext AS fname FROM x),
rec AS (
  SELECT doc_id, source,
    'https://data.example.org/' || source || '/' || CAST(doc_id AS VARCHAR) || '/' || fname AS source_url,
    substr(sha256('https://data.example.org/' || source || '/' || CAST(doc_id AS VARCHAR) || '/' || fname), 1, 12)
      AS resource_id,
    'Informe ' || mname || ' ' || CAST(yr AS VARCHAR) AS anchor_text, fname AS original_filename,
    yr AS document_year, ext AS extension,
    CASE WHEN failed THEN 'failed' ELSE {_STATUSES}[doc_id % 4 + 1] END AS status,
    CASE WHEN NOT failed THEN '/raw/' || source || '/' || CAST(doc_id AS VARCHAR) || '/' || fname END AS stored_path,
    CASE WHEN NOT failed THEN CAST(strlen(text) AS BIGINT) END AS size_bytes,
    CASE WHEN NOT failed THEN sha256(text) END AS sha256,
    layout AS storage_layout_version,
    'manifest_' || source || '_' || layout || '_' || lpad(CAST(doc_id % 3 AS VARCHAR), 2, '0') || '.json'
      AS manifest_name
  FROM x2),
latest AS (SELECT source, max(manifest_name) AS manifest_name FROM rec
           WHERE storage_layout_version = 'v2' GROUP BY source),
lrec AS (SELECT * FROM rec WHERE (source, manifest_name) IN (SELECT (source, manifest_name) FROM latest))"""

_MTEXT = ("upper(trim(regexp_replace(strip_accents(concat_ws(' ', COALESCE(original_filename, ''), "
          "COALESCE(anchor_text, ''), COALESCE(source_url, ''))), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')))")
_MONTH_CASE = "CASE " + " ".join(
    f"WHEN regexp_matches({_MTEXT}, '\\b{m}\\b') THEN {i}" for i, m in enumerate(
        ["ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO", "JULIO", "AGOSTO", "SEPTIEMBRE",
         "OCTUBRE", "NOVIEMBRE", "DICIEMBRE"], 1)) + " END"

ELIG = f"""{REC},
el AS (SELECT *, {_MONTH_CASE} AS document_month FROM lrec
       WHERE status IN ('downloaded','unchanged','updated_version','recovered_copy')
         AND lower(extension) IN ('.xlsx', '.xls') AND stored_path IS NOT NULL AND sha256 IS NOT NULL
         AND document_year IS NOT NULL)"""

SQL: dict[str, str] = {}

SQL["s1_latest_manifest"] = f"""WITH {REC},
counts AS (SELECT source, manifest_name, COUNT(*) AS records FROM rec GROUP BY ALL)
SELECT l.source, l.manifest_name, c.records FROM latest l
LEFT JOIN counts c ON c.source = l.source AND c.manifest_name = l.manifest_name"""

SQL["s2_eligible_records"] = f"""WITH {ELIG}
SELECT source, source_url, document_year, document_month, stored_path, sha256 FROM el"""

SQL["s3_s4_period_selection"] = f"""WITH {ELIG},
lp AS (SELECT source, document_year, document_month FROM (
         SELECT *, row_number() OVER (PARTITION BY source ORDER BY document_year DESC, document_month DESC) AS rn
         FROM el WHERE document_month IS NOT NULL) WHERE rn = 1),
ch AS (SELECT el.* FROM el JOIN lp ON el.source = lp.source AND el.document_year = lp.document_year
       AND el.document_month = lp.document_month),
mu AS (SELECT source, min(source_url) AS mu FROM ch GROUP BY source),
pick AS (SELECT ch.source, min(ch.stored_path) AS mp FROM ch JOIN mu ON ch.source = mu.source
         AND ch.source_url = mu.mu GROUP BY ch.source),
g AS (SELECT source, document_year, document_month, COUNT(DISTINCT sha256) AS distinct_sha FROM ch GROUP BY ALL)
SELECT g.source, g.document_year, g.document_month, g.distinct_sha, g.distinct_sha > 1 AS ambiguous,
       mu.mu AS source_url, pick.mp AS stored_path,
       (SELECT min(sha256) FROM ch WHERE ch.source = g.source AND ch.source_url = mu.mu
          AND ch.stored_path = pick.mp) AS sha256
FROM g JOIN mu ON mu.source = g.source JOIN pick ON pick.source = g.source"""

SQL["s5_newest_file"] = f"""WITH {REC},
f AS (SELECT source, stored_path AS path,
             make_timestamp(document_year, CAST(doc_id % 12 + 1 AS INTEGER), CAST(doc_id % 28 + 1 AS INTEGER),
                            0, 0, 0) AS modificationTime
      FROM rec WHERE stored_path IS NOT NULL
        AND lower(regexp_extract(stored_path, '(\\.[A-Za-z0-9]+)$', 1)) IN ('.xlsx', '.xls'))
SELECT source, path, modificationTime, 'fallback_newest_file' AS selection_mode FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY modificationTime DESC, path DESC) AS rn FROM f)
WHERE rn = 1"""

SQL["s6_integrity"] = f"""WITH {REC},
sf AS (SELECT CASE WHEN d.doc_id % 11 = 0 THEN r.stored_path || '.partial' ELSE r.stored_path END AS path,
              sha256(CASE WHEN d.doc_id % 13 = 0 THEN d.text || chr(10) ELSE d.text END) AS actual_sha256
       FROM rec r JOIN documents d ON d.doc_id = r.doc_id
       WHERE r.stored_path IS NOT NULL),
fs AS (SELECT path, min(actual_sha256) AS actual_sha256 FROM sf GROUP BY path),
j AS (SELECT rec.*, fs.actual_sha256 FROM rec LEFT JOIN fs ON fs.path = rec.stored_path)
SELECT doc_id, source_url, status, stored_path, sha256, actual_sha256,
  CASE WHEN status = 'failed' THEN 'download_failed' WHEN stored_path IS NULL THEN 'missing_stored_path'
       WHEN actual_sha256 IS NULL THEN 'file_not_found' WHEN actual_sha256 <> sha256 THEN 'sha256_mismatch'
  END AS reason,
  (CASE WHEN status = 'failed' THEN 'download_failed' WHEN stored_path IS NULL THEN 'missing_stored_path'
       WHEN actual_sha256 IS NULL THEN 'file_not_found' WHEN actual_sha256 <> sha256 THEN 'sha256_mismatch'
  END) IS NULL AS verified
FROM j"""

SQL["s16_snapshot_status"] = f"""WITH {REC},
runs AS (SELECT CASE WHEN d.doc_id % 5 = 0 THEN r.source_url || '?v=old' ELSE r.source_url END AS source_url, r.storage_layout_version AS layout,
                sha256(CASE WHEN d.doc_id % 7 = 0 THEN d.text || ' ' ELSE d.text END) AS sha256, d.doc_id % 3 = 0 AS copied, '2025-12-01T00:00:00Z' AS seen_at
         FROM rec r JOIN documents d ON d.doc_id = r.doc_id
         UNION ALL
         SELECT CASE WHEN d.doc_id % 5 = 0 THEN r.source_url || '?v=old' ELSE r.source_url END, r.storage_layout_version,
                sha256(CASE WHEN d.doc_id % 4 = 0 THEN 'x ' || d.text ELSE d.text END), false, '2025-11-01T00:00:00Z'
         FROM rec r JOIN documents d ON d.doc_id = r.doc_id),
idx AS (SELECT source_url, arg_max(sha256, seen_at) AS ps, max(seen_at) AS pa FROM runs WHERE layout = 'v2' AND NOT copied GROUP BY 1),
stored AS (SELECT DISTINCT source_url, sha256 FROM runs),
q AS (SELECT c.*, ps, pa, st.sha256 IS NOT NULL AS stored FROM rec c LEFT JOIN idx USING (source_url)
      LEFT JOIN stored st ON st.source_url = c.source_url AND st.sha256 = c.sha256),
s AS (SELECT *, CASE WHEN status = 'failed' THEN 'failed' WHEN stored THEN 'unchanged'
             WHEN ps <> sha256 THEN 'updated_version' ELSE 'downloaded' END AS snapshot_status FROM q)
SELECT doc_id, source_url, snapshot_status,
       CASE WHEN snapshot_status = 'unchanged' AND ps IS NOT NULL THEN pa ELSE '2026-01-01T00:00:00Z' END AS downloaded_at_utc FROM s"""

SQL["s17_version_names"] = f"""WITH {REC},
v0 AS (SELECT doc_id, sha256,
             regexp_replace(original_filename, '\\.[A-Za-z0-9]+$', '') || '__src_' || substr(resource_id, 1, 12)
               || '__sha256_' || substr(sha256, 1, 12) || extension AS version_name,
             length(regexp_replace(original_filename, '\\.[A-Za-z0-9]+$', '')) + 39 + length(extension) AS expected_len
      FROM rec WHERE sha256 IS NOT NULL),
v AS (SELECT * FROM v0 UNION ALL SELECT v0.doc_id, sha256(d.text || chr(10)), version_name, expected_len
      FROM v0 JOIN documents d ON d.doc_id = v0.doc_id WHERE d.doc_id % 13 = 0),
iss AS (SELECT version_name, 'name_reused_for_other_content' AS issue FROM v GROUP BY version_name
        HAVING COUNT(DISTINCT sha256) > 1
        UNION ALL SELECT DISTINCT version_name, 'unexpected_length' FROM v WHERE length(version_name) <> expected_len)
SELECT v.doc_id, v.sha256, v.version_name, iss.issue FROM v LEFT JOIN iss ON iss.version_name = v.version_name"""
