"""DuckDB oracle SQL for the market family."""

from __future__ import annotations

from .oracle import MONTHS_SQL, NATIONAL_FACT, xs

NON_ANALYTIC = r"^(TOTAL\b.*|SUBTOTAL\b.*|OTROS\b.*|RESTO\b.*|MUNDO|GLOBAL)$"


def _ind(unit: str) -> str:
    return (f"CASE WHEN cut = 'MAYO' THEN '{unit}_' || CAST(year AS VARCHAR) || '_05' "
            f"ELSE '{unit}_ene_may_' || CAST(year AS VARCHAR) END")


CELLS = """mo AS (
  SELECT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         COUNT(*) AS n, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE month(o_orderdate) <= 5 GROUP BY 1, 2, 3),
mc AS (SELECT c_nationkey, 'MAYO' AS cut, year, n, v FROM mo WHERE month = 5
       UNION ALL SELECT c_nationkey, 'ACUM_ENE_MAY' AS cut, year, n, v FROM mo),
bn AS (SELECT c_nationkey, cut, year, SUM(n) AS n, SUM(v) AS v FROM mc GROUP BY ALL),
named AS (SELECT bn.*, n_name, r_name FROM bn JOIN nation ON c_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey),
cells AS (
  SELECT n_name AS label, cut, year, CAST(n AS DOUBLE) AS qty, CAST(v AS DOUBLE) AS value FROM named
  UNION ALL SELECT r_name, cut, year, CAST(SUM(n) AS DOUBLE), CAST(SUM(v) AS DOUBLE) FROM named
            GROUP BY r_name, cut, year
  UNION ALL SELECT 'TOTAL EXPORTACIONES', cut, year, CAST(SUM(n) AS DOUBLE), CAST(SUM(v) AS DOUBLE)
            FROM named GROUP BY cut, year)"""

LONG = f"""{CELLS},
lat0 AS (SELECT cut, max(year) AS year FROM cells GROUP BY cut),
cur AS (SELECT c.* FROM cells c JOIN lat0 l ON c.cut = l.cut AND c.year = l.year),
pub0 AS (
  SELECT cur.cut, cur.label, cur.qty, cur.value, p.value AS pv, p.qty AS pq, nt.n_nationkey, t.tq
  FROM cur LEFT JOIN cells p ON p.cut = cur.cut AND p.label = cur.label AND p.year + 1 = cur.year
  LEFT JOIN nation nt ON nt.n_name = cur.label
  LEFT JOIN (SELECT cut, qty AS tq FROM cur WHERE starts_with(label, 'TOTAL')) t ON t.cut = cur.cut),
pub1 AS (
  SELECT cut, label,
    CASE WHEN pv <> 0 THEN (value - pv) / pv + CASE WHEN n_nationkey % 7 = 0 THEN 0.05 ELSE 0.0 END END AS vd,
    CASE WHEN pq <> 0 THEN (qty - pq) / pq + CASE WHEN n_nationkey % 7 = 0 THEN 0.05 ELSE 0.0 END END AS vl,
    CASE WHEN tq > 0 THEN qty / tq END AS pl
  FROM pub0),
ml AS (
  SELECT cut, label, {_ind('dolares')} AS indicator, value FROM cells
  UNION ALL SELECT cut, label, {_ind('libras')} AS indicator, qty AS value FROM cells
  UNION ALL SELECT cut, label, 'variacion_dolares', vd FROM pub1 WHERE vd IS NOT NULL
  UNION ALL SELECT cut, label, 'variacion_libras', vl FROM pub1 WHERE vl IS NOT NULL
  UNION ALL SELECT cut, label, 'participacion_libras', pl FROM pub1 WHERE pl IS NOT NULL)"""

LABELLED = f"""{LONG},
lb0 AS (SELECT cut, label, indicator, value, upper(trim(label)) AS label_source FROM ml),
lb1 AS (SELECT * FROM lb0 WHERE label_source IS NOT NULL AND label_source <> ''
        AND NOT regexp_matches(label_source, '{NON_ANALYTIC}')),
lb2 AS (SELECT *, COALESCE(CASE label_source WHEN 'NATION_10' THEN 'NATION_TEN' END, label_source) AS dest
        FROM lb1),
lv AS (SELECT lb2.*, CASE WHEN dest IN (SELECT upper(trim(r_name)) FROM region)
                          THEN 'AGREGADO_REGIONAL' ELSE 'DETALLADO' END AS level FROM lb2)"""

WIDE = f"""{LABELLED},
uv AS (
  SELECT *,
    NULLIF(CASE WHEN cut = 'MAYO' THEN regexp_extract(indicator, '^(dolares|libras)_(\\d{{4}})_05$', 1)
                ELSE regexp_extract(indicator, '^(dolares|libras)_ene_may_(\\d{{4}})$', 1) END, '') AS unit,
    TRY_CAST(NULLIF(CASE WHEN cut = 'MAYO' THEN regexp_extract(indicator, '^(dolares|libras)_(\\d{{4}})_05$', 2)
                ELSE regexp_extract(indicator, '^(dolares|libras)_ene_may_(\\d{{4}})$', 2) END, '') AS INTEGER) AS uyear
  FROM lv),
srcs AS (SELECT cut, dest, level, array_to_string(list_sort(list_distinct(list(label_source))), ' | ')
                AS label_source FROM lv GROUP BY cut, dest, level),
w0 AS (SELECT dest, level, cut, uyear AS year,
              max(CASE WHEN unit = 'dolares' THEN value END) AS value,
              max(CASE WHEN unit = 'libras' THEN value END) AS qty
       FROM uv WHERE unit IS NOT NULL AND uyear IS NOT NULL GROUP BY dest, level, cut, uyear),
wide AS (SELECT s.label_source, w0.dest, w0.level, w0.cut, w0.year, w0.qty, w0.value
         FROM w0 LEFT JOIN srcs s ON s.cut = w0.cut AND s.dest = w0.dest AND s.level = w0.level),
pub AS (SELECT dest, cut,
               max(CASE WHEN indicator = 'variacion_dolares' THEN value END) AS pub_growth_value,
               max(CASE WHEN indicator = 'variacion_libras' THEN value END) AS pub_growth_qty,
               max(CASE WHEN indicator = 'participacion_libras' THEN value END) AS pub_share_qty
        FROM lv WHERE indicator IN ('variacion_dolares', 'variacion_libras', 'participacion_libras')
              AND level = 'DETALLADO' GROUP BY dest, cut)"""

BASE = f"""{WIDE},
mb0 AS (SELECT *, CASE WHEN qty IS NOT NULL AND qty > 0 AND value IS NOT NULL THEN value / qty END AS price
        FROM wide WHERE level = 'DETALLADO'),
tot AS (SELECT cut, year, {xs('qty')} AS t FROM mb0 GROUP BY cut, year),
mb1 AS (
  SELECT mb0.*, CASE WHEN tot.t > 0 AND mb0.qty IS NOT NULL THEN mb0.qty / tot.t END AS share_qty,
    CAST(dense_rank() OVER (PARTITION BY mb0.cut, mb0.year ORDER BY value DESC NULLS LAST, dest ASC) AS INTEGER) AS rank_value,
    CAST(dense_rank() OVER (PARTITION BY mb0.cut, mb0.year ORDER BY qty DESC NULLS LAST, dest ASC) AS INTEGER) AS rank_qty,
    lag(mb0.year) OVER (PARTITION BY dest, mb0.cut ORDER BY mb0.year) AS _py,
    lag(qty) OVER (PARTITION BY dest, mb0.cut ORDER BY mb0.year) AS _pq,
    lag(value) OVER (PARTITION BY dest, mb0.cut ORDER BY mb0.year) AS _pv
  FROM mb0 LEFT JOIN tot ON tot.cut = mb0.cut AND tot.year = mb0.year),
mb2 AS (
  SELECT * EXCLUDE (_py, _pq, _pv),
    CASE WHEN _pq IS NOT NULL AND _pq <> 0 AND qty IS NOT NULL AND _py = year - 1 THEN (qty - _pq) / _pq END AS yoy_qty,
    CASE WHEN _pv IS NOT NULL AND _pv <> 0 AND value IS NOT NULL AND _py = year - 1 THEN (value - _pv) / _pv END AS yoy_value
  FROM mb1),
lat AS (SELECT cut, max(year) AS ly FROM mb2 GROUP BY cut),
mb3 AS (
  SELECT mb2.*, CASE WHEN mb2.year = lat.ly THEN pub.pub_growth_value END AS pub_growth_value,
         CASE WHEN mb2.year = lat.ly THEN pub.pub_growth_qty END AS pub_growth_qty,
         CASE WHEN mb2.year = lat.ly THEN pub.pub_share_qty END AS pub_share_qty, lat.ly
  FROM mb2 LEFT JOIN pub ON pub.dest = mb2.dest AND pub.cut = mb2.cut LEFT JOIN lat ON lat.cut = mb2.cut),
mb AS (
  SELECT * EXCLUDE (ly),
    CASE WHEN year = ly AND pub_growth_value IS NOT NULL AND yoy_value IS NOT NULL
         THEN abs(pub_growth_value - yoy_value) END AS diff_growth_value,
    CASE WHEN year = ly AND pub_growth_qty IS NOT NULL AND yoy_qty IS NOT NULL
         THEN abs(pub_growth_qty - yoy_qty) END AS diff_growth_qty
  FROM mb3)"""


def _verdict(diff: str, ref: str) -> str:
    return (f"CASE WHEN {diff} IS NULL THEN 'NO_COMPARABLE' "
            f"WHEN {diff} <= greatest(1e-6, abs({ref}) * 1e-5) THEN 'COINCIDE' ELSE 'REVISAR' END")


HIST_BODY = f"""ht AS (SELECT * FROM cells WHERE starts_with(label, 'TOTAL')),
hg AS (
  SELECT c.year, c.cut, c.qty, c.value,
    CASE WHEN p.qty IS NOT NULL AND c.qty IS NOT NULL AND p.qty <> 0 THEN (c.qty - p.qty) / p.qty END
      + CASE WHEN c.year % 3 = 0 THEN 0.01 ELSE 0.0 END AS pub_growth_qty,
    CASE WHEN p.value IS NOT NULL AND c.value IS NOT NULL AND p.value <> 0 THEN (c.value - p.value) / p.value END
      + CASE WHEN c.year % 3 = 0 THEN 0.01 ELSE 0.0 END AS pub_growth_value
  FROM ht c LEFT JOIN ht p ON p.cut = c.cut AND p.year + 1 = c.year),
hc0 AS (
  SELECT *, lag(year) OVER w AS _py, lag(qty) OVER w AS _pq, lag(value) OVER w AS _pv
  FROM hg WINDOW w AS (PARTITION BY cut ORDER BY year)),
hc AS (
  SELECT * EXCLUDE (_py, _pq, _pv),
    CASE WHEN _pq <> 0 AND _py = year - 1 THEN (qty - _pq) / _pq END AS yoy_qty,
    CASE WHEN _pv <> 0 AND _py = year - 1 THEN (value - _pv) / _pv END AS yoy_value,
    CASE WHEN qty IS NOT NULL AND qty > 0 AND value IS NOT NULL THEN value / qty END AS price
  FROM hc0),
hcd AS (
  SELECT *,
    CASE WHEN pub_growth_qty IS NOT NULL AND yoy_qty IS NOT NULL THEN abs(pub_growth_qty - yoy_qty) END AS diff_growth_qty,
    CASE WHEN pub_growth_value IS NOT NULL AND yoy_value IS NOT NULL THEN abs(pub_growth_value - yoy_value) END AS diff_growth_value
  FROM hc)"""

HISTORY = f"{CELLS},\n{HIST_BODY}"

MARKET_SERVING_SELECT = f"""SELECT label_source, dest, level, cut, year, qty, value, price, share_qty,
       rank_value, rank_qty, yoy_qty, yoy_value, pub_growth_qty, pub_growth_value, pub_share_qty,
       diff_growth_qty, diff_growth_value,
       {_verdict('diff_growth_qty', 'yoy_qty')} AS check_growth_qty,
       {_verdict('diff_growth_value', 'yoy_value')} AS check_growth_value
FROM mb"""

COMPARATIVE_SERVING_SELECT = f"""SELECT cut, year, qty, value, price, yoy_qty, yoy_value, pub_growth_qty,
       pub_growth_value, diff_growth_qty, diff_growth_value,
       {_verdict('diff_growth_qty', 'yoy_qty')} AS check_growth_qty,
       {_verdict('diff_growth_value', 'yoy_value')} AS check_growth_value
FROM hcd"""

SQL: dict[str, str] = {}

SQL["k2_market_values"] = f"WITH {WIDE} SELECT * FROM wide"
SQL["k2_published_indicators"] = f"WITH {WIDE} SELECT * FROM pub"
SQL["k2_alias_collisions"] = f"""WITH {LABELLED}
SELECT cut, CASE WHEN label_source IN ('NATION_10', 'NATION_11') THEN 'NATION_TEN' ELSE label_source END AS dest, indicator,
       COUNT(DISTINCT label_source) AS n_distinct FROM lv
GROUP BY 1, 2, 3 HAVING COUNT(DISTINCT label_source) > 1"""
SQL["k3_market_base"] = f"WITH {BASE} SELECT * FROM mb"
SQL["k9_market_serving"] = f"WITH {BASE} {MARKET_SERVING_SELECT}"
SQL["k10_regional_serving"] = f"""WITH {WIDE},
rg0 AS (SELECT *, CASE WHEN qty IS NOT NULL AND qty > 0 AND value IS NOT NULL THEN value / qty END AS price
        FROM wide WHERE level = 'AGREGADO_REGIONAL'),
rg1 AS (SELECT *,
    CAST(dense_rank() OVER (PARTITION BY cut, year ORDER BY qty DESC NULLS LAST, dest ASC) AS INTEGER) AS rank_qty_regional,
    CAST(dense_rank() OVER (PARTITION BY cut, year ORDER BY value DESC NULLS LAST, dest ASC) AS INTEGER) AS rank_value_regional,
    lag(year) OVER w AS _py, lag(qty) OVER w AS _pq, lag(value) OVER w AS _pv
  FROM rg0 WINDOW w AS (PARTITION BY dest, cut ORDER BY year))
SELECT label_source, dest, level, cut, year, qty, value, price, rank_qty_regional, rank_value_regional,
  CASE WHEN _pq IS NOT NULL AND _pq <> 0 AND qty IS NOT NULL AND _py = year - 1 THEN (qty - _pq) / _pq END AS yoy_qty,
  CASE WHEN _pv IS NOT NULL AND _pv <> 0 AND value IS NOT NULL AND _py = year - 1 THEN (value - _pv) / _pv END AS yoy_value,
  'AGREGADO_REGIONAL_SEPARADO' AS analytic_use
FROM rg1"""
SQL["k4_comparative"] = f"WITH {HISTORY} SELECT * FROM hcd"
SQL["k9_comparative_serving"] = f"WITH {HISTORY} {COMPARATIVE_SERVING_SELECT}"
SQL["k5_dim_destination"] = f"""WITH {BASE}
SELECT sha256(dest) AS destination_key, dest,
       array_to_string(list_sort(list_distinct(list(label_source))), ' | ') AS source_labels,
       'DETALLADO' AS level
FROM mb GROUP BY dest"""
SQL["k5_date_spine"] = f"""WITH {NATIONAL_FACT}, {WIDE.replace('mo AS (', 'mo AS (', 1)},
h AS (SELECT DISTINCT cut, year FROM cells WHERE starts_with(label, 'TOTAL')),
sp AS (SELECT period_date FROM nb
       UNION SELECT make_date(year, 5, 1) FROM wide
       UNION SELECT make_date(year, 5, 1) FROM h)
SELECT CAST(year(period_date) * 10000 + month(period_date) * 100 + day(period_date) AS INTEGER) AS date_key,
       period_date, CAST(year(period_date) AS INTEGER) AS year, CAST(month(period_date) AS INTEGER) AS month,
       {MONTHS_SQL}[month(period_date)] AS month_name, CAST(quarter(period_date) AS INTEGER) AS quarter,
       CASE WHEN month(period_date) <= 6 THEN 1 ELSE 2 END AS semester,
       strftime(period_date, '%Y-%m') AS year_month
FROM sp"""
SQL["k6_market_fact"] = f"""WITH {BASE}
SELECT sha256(dest) AS destination_key,
       CASE WHEN cut = 'MAYO' THEN 1 WHEN cut = 'ACUM_ENE_MAY' THEN 2 END AS cut_key,
       CAST(year * 10000 + 501 AS INTEGER) AS date_key, year, qty, value, price, share_qty,
       rank_value, rank_qty, yoy_qty, yoy_value
FROM mb"""

SQL["k11_kpi_national"] = f"""WITH {NATIONAL_FACT}, {BASE}, {HIST_BODY},
lm AS (SELECT * FROM nf WHERE period_date = (SELECT max(period_date) FROM nf)),
lc AS (SELECT * FROM hcd WHERE cut = 'ACUM_ENE_MAY'
       AND year = (SELECT max(year) FROM hcd WHERE cut = 'ACUM_ENE_MAY')),
ty AS (SELECT max(year) AS y FROM mb WHERE cut = 'ACUM_ENE_MAY'),
tp AS (SELECT min(dest) AS dest, min(value) AS value FROM mb
       WHERE cut = 'ACUM_ENE_MAY' AND year = (SELECT y FROM ty) AND rank_value = 1)
SELECT min(year) AS first_year, max(year) AS latest_year,
       (SELECT period_date FROM lm) AS last_period, (SELECT qty FROM lm) AS qty_last_month,
       (SELECT value FROM lm) AS value_last_month, (SELECT price FROM lm) AS price_last_month,
       (SELECT year FROM lc) AS cumulative_year, (SELECT qty FROM lc) AS cumulative_qty,
       (SELECT value FROM lc) AS cumulative_value, (SELECT yoy_qty FROM lc) AS cumulative_yoy_qty,
       (SELECT yoy_value FROM lc) AS cumulative_yoy_value,
       (SELECT dest FROM tp) AS top_destination, (SELECT value FROM tp) AS top_destination_value
FROM nf"""
