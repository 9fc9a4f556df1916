"""DuckDB oracle SQL for the generic aggregate / set / join / ordering queries."""

from __future__ import annotations

from .oracle import CATALOGUE, RECON, SQL as BASE_SQL, SUBCODE, xs
from .oracle_market import BASE, HIST_BODY, WIDE
from .oracle_resources import REC

SQL: dict[str, str] = {}

SQL["a3_profile"] = f"""WITH {SUBCODE}
SELECT COUNT(*) AS rows, COUNT(DISTINCT subcode) AS distinct_subcode, COUNT(DISTINCT period_date) AS distinct_period_date,
       min(period_date) AS min_period_date, max(period_date) AS max_period_date,
       {xs('tonnes')} AS sum_tonnes, {xs('fob_usd')} AS sum_fob_usd FROM sf"""

SQL["a4_density"] = f"""WITH {SUBCODE}, p AS (SELECT period_date, COUNT(*) AS n FROM sf GROUP BY 1)
SELECT COUNT(*) AS keys, min(n) AS min_rows, max(n) AS max_rows,
       CAST(SUM(n) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_rows FROM p"""

_RCOLS = ["period_date", "year", "month", "qty_direct", "qty_matrix", "diff_abs_qty", "match_qty", "value_direct",
          "value_matrix", "diff_abs_value", "match_value", "reported_price_direct", "reconciliation_state"]
SQL["a5_null_cells"] = f"WITH {RECON}\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls FROM r" for c in _RCOLS)

SQL["a6_duplicate_keys"] = """SELECT sha256(text) AS text_sha, COUNT(*) AS count FROM documents
GROUP BY 1 HAVING COUNT(*) > 1"""

SQL["a7_conflicts"] = """SELECT source, COUNT(DISTINCT lang) AS n_distinct FROM documents
GROUP BY 1 HAVING COUNT(DISTINCT lang) > 1"""

SQL["a8_label_list"] = """SELECT source, array_to_string(list_sort(list_distinct(list(lang))), ' | ') AS languages
FROM documents GROUP BY source"""

SQL["a9_histogram"] = "SELECT event_type, COUNT(*) AS events FROM events GROUP BY 1"

SQL["a10_totals_rollup"] = f"""SELECT CASE WHEN GROUPING(event_type) = 1 THEN 'TOTAL' ELSE event_type END AS event_type,
       COUNT(*) AS events, {xs('value')} AS value_total FROM events GROUP BY ROLLUP (event_type)"""

SQL["a11_catalogue"] = f"""WITH {SUBCODE}
SELECT subcode, min(period_date) AS first_period, max(period_date) AS last_period, COUNT(*) AS rows
FROM sf GROUP BY subcode"""

SQL["a12_latest_by"] = f"WITH {WIDE} SELECT cut, max(year) AS latest_year FROM wide GROUP BY cut"

_A13 = "\nUNION ALL ".join(
    f"SELECT '{m}' AS measure, (SELECT {xs(m)} FROM sf) AS sum_source, (SELECT {xs(m)} FROM en) AS sum_target, "
    f"abs((SELECT {xs(m)} FROM sf) - (SELECT {xs(m)} FROM en)) AS abs_diff, "
    f"abs((SELECT {xs(m)} FROM sf) - (SELECT {xs(m)} FROM en)) <= {t} AS conserved"
    for m, t in [("tonnes", "1e-06"), ("fob_thousands", "1e-06"), ("fob_usd", "0.001")])
SQL["a13_conservation"] = f"WITH {SUBCODE}\n{_A13}"

SQL["a14_group_totals"] = f"""WITH {BASE}
SELECT cut, year, {xs('qty')} AS total_qty, {xs('value')} AS total_value FROM mb GROUP BY cut, year"""

SQL["u2_diff"] = f"""WITH {REC},
prev AS (SELECT CASE WHEN d.doc_id % 5 = 0 THEN r.source_url || '?v=old' ELSE r.source_url END AS source_url,
                sha256(CASE WHEN d.doc_id % 7 = 0 THEN d.text || ' ' ELSE d.text END) AS sha256
         FROM rec r JOIN documents d ON d.doc_id = r.doc_id),
cur AS (SELECT source_url, sha256 FROM rec WHERE sha256 IS NOT NULL),
ca AS (SELECT source_url, sha256, COUNT(*) AS na FROM cur GROUP BY ALL),
cb AS (SELECT source_url, sha256, COUNT(*) AS nb FROM prev GROUP BY ALL),
j AS (SELECT COALESCE(ca.source_url, cb.source_url) AS source_url, COALESCE(ca.sha256, cb.sha256) AS sha256,
             COALESCE(na, 0) AS na, COALESCE(nb, 0) AS nb
      FROM ca FULL OUTER JOIN cb ON ca.source_url IS NOT DISTINCT FROM cb.source_url
                                 AND ca.sha256 IS NOT DISTINCT FROM cb.sha256)
SELECT source_url, sha256, CASE WHEN na > nb THEN 'only_left' ELSE 'only_right' END AS side,
       abs(na - nb) AS copies FROM j WHERE na <> nb"""

SQL["u3_dedup_audit"] = """WITH d AS (SELECT source, lang, sha256(text) AS text_sha FROM documents),
ne AS (SELECT * FROM d WHERE NOT (source IS NULL AND lang IS NULL AND text_sha IS NULL))
SELECT (SELECT COUNT(*) FROM d) AS initial_rows, (SELECT COUNT(*) FROM d) - (SELECT COUNT(*) FROM ne) AS empty_removed,
       (SELECT COUNT(*) FROM ne) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM ne)) AS duplicates_removed,
       (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM ne)) AS final_rows"""

SQL["u4_dedup_subset"] = """SELECT sha256(text) AS text_sha, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang
FROM documents GROUP BY 1"""

SQL["u6_calendar_gaps"] = """WITH o AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period_date FROM orders),
b AS (SELECT o_custkey, min(period_date) AS a, max(period_date) AS z FROM o GROUP BY 1),
e AS (SELECT o_custkey, CAST(unnest(generate_series(a, z, INTERVAL 1 MONTH)) AS DATE) AS period_date FROM b)
SELECT o_custkey, period_date FROM e
WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.o_custkey = e.o_custkey AND o.period_date = e.period_date)"""

SQL["u7_coverage"] = f"""WITH {SUBCODE}, {CATALOGUE},
c AS (SELECT DISTINCT subcode FROM sf), k AS (SELECT DISTINCT subcode FROM cat)
SELECT subcode, 'code_without_label' AS issue FROM c WHERE subcode NOT IN (SELECT subcode FROM k)
UNION ALL SELECT subcode, 'label_without_code' FROM k WHERE subcode NOT IN (SELECT subcode FROM c)"""

SQL["j10_fk_orphans"] = """SELECT doc_id, source, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""

SQL["j11_reconcile_totals"] = f"""WITH {BASE}, {HIST_BODY},
s AS (SELECT cut, year, {xs('value')} AS detail_sum FROM mb GROUP BY cut, year),
t AS (SELECT cut, year, value AS reported_total FROM hg)
SELECT COALESCE(s.cut, t.cut) AS cut, COALESCE(s.year, t.year) AS year, detail_sum, reported_total,
       abs(detail_sum - reported_total) AS abs_diff, abs(detail_sum - reported_total) <= 1.0 AS within_tolerance
FROM s FULL OUTER JOIN t ON s.cut = t.cut AND s.year = t.year"""

SQL["l2_latest_row"] = f"""WITH k7 AS ({BASE_SQL['k7_national_monthly']})
SELECT period_date, qty, value, price, yoy_value FROM k7 WHERE period_date = (SELECT max(period_date) FROM k7)"""

SQL["l3_top_of_latest"] = f"""WITH {SUBCODE}
SELECT period_date, subcode, fob_usd FROM (
  SELECT *, row_number() OVER (ORDER BY fob_usd DESC NULLS LAST, subcode ASC) AS rn FROM en
  WHERE period_date = (SELECT max(period_date) FROM en)) WHERE rn = 1"""

SQL["p2_unpivot_indicators"] = f"""WITH {WIDE}
SELECT cut || '/' || dest AS market, 'value_' || CAST(year AS VARCHAR) AS indicator, value FROM wide
WHERE value IS NOT NULL AND dest IS NOT NULL"""

