"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the operator semantics, not generated from the Spark plans.
Shared CTE fragments mirror :mod:`mensura.plans.inputs`.
"""

from __future__ import annotations


def xs(col: str) -> str:
    """Decimal-exact SUM returned as DOUBLE (mirrors ``exact_sum``)."""
    return f"CAST(SUM(CAST({col} AS DECIMAL(38,6))) AS DOUBLE)"


MONTHS_SQL = ("['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto',"
              "'Septiembre','Octubre','Noviembre','Diciembre']")

# -- national series (source A) ---------------------------------------------
OM = f"""om AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_date,
         CAST(COUNT(*) AS DOUBLE) AS qty, {xs('o_totalprice')} AS value
  FROM orders GROUP BY 1)"""

DIRECT = """d AS (
  SELECT period_date, qty AS qty_direct,
         CASE WHEN month(period_date) = 7 THEN value + 1000.0 ELSE value END AS value_direct,
         (CASE WHEN month(period_date) = 7 THEN value + 1000.0 ELSE value END) / qty
           AS reported_price_direct
  FROM om WHERE year(period_date) >= 1997)"""

MATRIX = """mv AS (SELECT period_date, value AS value_matrix FROM om
               WHERE year(period_date) <= 2000 AND period_date <= DATE '2000-10-01'),
mq AS (SELECT period_date, qty AS qty_matrix FROM om
       WHERE year(period_date) <= 2000 AND period_date <= DATE '2000-10-01'),
m AS (SELECT COALESCE(mv.period_date, mq.period_date) AS period_date, value_matrix, qty_matrix
      FROM mv FULL OUTER JOIN mq ON mv.period_date = mq.period_date)"""

RECON = f"""{OM}, {DIRECT}, {MATRIX},
j AS (SELECT COALESCE(d.period_date, m.period_date) AS period_date, qty_direct, value_direct,
             reported_price_direct, qty_matrix, value_matrix
      FROM d FULL OUTER JOIN m ON d.period_date = m.period_date),
r0 AS (SELECT *,
  CASE WHEN qty_direct IS NOT NULL AND qty_matrix IS NOT NULL THEN abs(qty_direct - qty_matrix) END AS diff_abs_qty,
  CASE WHEN qty_direct IS NULL OR qty_matrix IS NULL THEN NULL
       ELSE abs(qty_direct - qty_matrix) <= greatest(1.0, abs(qty_direct) * 1e-9) END AS match_qty,
  CASE WHEN value_direct IS NOT NULL AND value_matrix IS NOT NULL THEN abs(value_direct - value_matrix) END AS diff_abs_value,
  CASE WHEN value_direct IS NULL OR value_matrix IS NULL THEN NULL
       ELSE abs(value_direct - value_matrix) <= greatest(1.0, abs(value_direct) * 1e-9) END AS match_value,
  COALESCE(qty_direct, qty_matrix) AS qty, COALESCE(value_direct, value_matrix) AS value,
  CASE WHEN qty_direct IS NOT NULL THEN 'exportaciones_mensuales' ELSE 'matriz_historica' END AS source_qty,
  CASE WHEN value_direct IS NOT NULL THEN 'exportaciones_mensuales' ELSE 'matriz_historica' END AS source_value,
  CAST(year(period_date) AS INTEGER) AS year, CAST(month(period_date) AS INTEGER) AS month
  FROM j),
r AS (SELECT *,
  CASE WHEN qty_direct IS NOT NULL AND qty_matrix IS NOT NULL AND value_direct IS NOT NULL
            AND value_matrix IS NOT NULL AND COALESCE(match_qty, false) AND COALESCE(match_value, false)
         THEN 'COINCIDE'
       WHEN qty_direct IS NOT NULL OR value_direct IS NOT NULL THEN
         CASE WHEN qty_matrix IS NOT NULL OR value_matrix IS NOT NULL THEN 'DIFIERE_PRIORIZA_DIRECTO'
              ELSE 'SOLO_DIRECTO' END
       ELSE 'SOLO_MATRIZ' END AS reconciliation_state,
  CASE WHEN qty IS NOT NULL AND qty > 0 AND value IS NOT NULL THEN value / qty END AS price
  FROM r0)"""

NATIONAL_FACT = f"""{RECON},
nb AS (SELECT period_date, year, month, qty, value, price, source_qty, source_value,
              reconciliation_state FROM r WHERE qty IS NOT NULL OR value IS NOT NULL),
nf AS (SELECT CAST(year(period_date) * 10000 + month(period_date) * 100 + day(period_date) AS INTEGER)
              AS date_key, * FROM nb)"""


SQL: dict[str, str] = {}

SQL["k1_reconciliation_audit"] = f"""WITH {RECON}
SELECT period_date, year, month, qty_direct, qty_matrix, diff_abs_qty, match_qty,
       value_direct, value_matrix, diff_abs_value, match_value, reported_price_direct,
       reconciliation_state FROM r"""

SQL["k1_national_base"] = f"""WITH {NATIONAL_FACT}
SELECT period_date, year, month, qty, value, price, source_qty, source_value,
       reconciliation_state FROM nb"""

SQL["k7_national_monthly"] = f"""WITH {NATIONAL_FACT}
SELECT f.period_date, f.year, f.month, {MONTHS_SQL}[f.month] AS month_name,
       strftime(f.period_date, '%Y-%m') AS year_month,
       CAST(quarter(f.period_date) AS INTEGER) AS quarter,
       CASE WHEN f.month <= 6 THEN 1 ELSE 2 END AS semester,
       f.qty, f.value, f.price,
       CASE WHEN pm.qty IS NOT NULL AND pm.qty <> 0 AND f.qty IS NOT NULL THEN (f.qty - pm.qty) / pm.qty END AS mom_qty,
       CASE WHEN pm.value IS NOT NULL AND pm.value <> 0 AND f.value IS NOT NULL THEN (f.value - pm.value) / pm.value END AS mom_value,
       CASE WHEN py.qty IS NOT NULL AND py.qty <> 0 AND f.qty IS NOT NULL THEN (f.qty - py.qty) / py.qty END AS yoy_qty,
       CASE WHEN py.value IS NOT NULL AND py.value <> 0 AND f.value IS NOT NULL THEN (f.value - py.value) / py.value END AS yoy_value,
       f.source_qty, f.source_value, f.reconciliation_state
FROM nf f
LEFT JOIN nf pm ON CAST(pm.period_date + INTERVAL 1 MONTH AS DATE) = f.period_date
LEFT JOIN nf py ON CAST(py.period_date + INTERVAL 12 MONTH AS DATE) = f.period_date"""

SQL["k8_national_annual"] = f"""WITH {NATIONAL_FACT},
a AS (SELECT year, {xs('qty')} AS qty_total, {xs('value')} AS value_total,
             COUNT(DISTINCT month) AS months_reported FROM nf GROUP BY year),
b AS (SELECT *, months_reported = 12 AS complete,
             CASE WHEN qty_total IS NOT NULL AND qty_total > 0 AND value_total IS NOT NULL
                  THEN value_total / qty_total END AS weighted_price FROM a)
SELECT c.year, c.months_reported, c.complete, c.qty_total, c.value_total, c.weighted_price,
  CASE WHEN c.complete AND p.complete AND p.qty_total IS NOT NULL AND p.qty_total <> 0 AND c.qty_total IS NOT NULL
       THEN (c.qty_total - p.qty_total) / p.qty_total END AS yoy_qty,
  CASE WHEN c.complete AND p.complete AND p.value_total IS NOT NULL AND p.value_total <> 0 AND c.value_total IS NOT NULL
       THEN (c.value_total - p.value_total) / p.value_total END AS yoy_value
FROM b c LEFT JOIN b p ON p.year + 1 = c.year"""

# -- sub-code fact (source B) -----------------------------------------------
PROD = "lpad(CAST(ascii(p_type) * 100 + ascii(substr(p_type, 2, 1)) AS VARCHAR), 6, '0')"

SUBCODE = f"""sf0 AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period_date, p_type, p_brand,
         {xs('l_quantity')} AS tonnes, {xs('l_extendedprice')} AS _fob
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
sf AS (
  SELECT strftime(period_date, '%Y') || ' / ' || strftime(period_date, '%m') || ' - '
           || {MONTHS_SQL}[month(period_date)] AS period_text,
         period_date, CAST(year(period_date) AS INTEGER) AS year,
         CAST(month(period_date) AS INTEGER) AS month,
         substr(prod, 1, 4) AS level3_code, 'GOODS' AS level3_label, prod AS product_code,
         p_type AS product_label,
         prod || lpad(regexp_extract(p_brand, '(\\d+)$', 1), 4, '0') AS subcode,
         concat_ws(' ', p_type, p_brand) AS subcode_label, tonnes,
         _fob / 1000.0 AS fob_thousands, _fob / 1000.0 * 1000.0 AS fob_usd
  FROM (SELECT *, {PROD} AS prod FROM sf0) x),
e0 AS (
  SELECT *, CAST(year * 10000 + month * 100 + 1 AS INTEGER) AS date_key,
         {MONTHS_SQL}[month] AS month_name, strftime(period_date, '%Y-%m') AS year_month,
         CAST(quarter(period_date) AS INTEGER) AS quarter,
         CASE WHEN month <= 6 THEN 1 ELSE 2 END AS semester,
         CASE WHEN tonnes * 1000.0 > 0 AND fob_usd IS NOT NULL THEN fob_usd / (tonnes * 1000.0) END
           AS unit_price_usd_kg
  FROM sf),
e1 AS (
  SELECT *, lag(year) OVER w AS _py, lag(tonnes) OVER w AS tonnes_prev_year,
         lag(fob_usd) OVER w AS fob_usd_prev_year
  FROM e0 WINDOW w AS (PARTITION BY subcode, month ORDER BY year)),
en AS (
  SELECT * EXCLUDE (_py),
         CASE WHEN tonnes_prev_year > 0 AND _py = year - 1 THEN tonnes / tonnes_prev_year - 1.0 END AS yoy_tonnes,
         CASE WHEN fob_usd_prev_year > 0 AND _py = year - 1 THEN fob_usd / fob_usd_prev_year - 1.0 END AS yoy_fob_usd
  FROM e1)"""

CATALOGUE = f"""cat AS (
  SELECT DISTINCT {PROD} || lpad(CAST(bn AS VARCHAR), 4, '0') AS subcode,
         upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2, 100)) || ' B' || CAST(bn AS VARCHAR)
           AS short_label
  FROM (SELECT p_type, TRY_CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) AS bn FROM part) p
  WHERE bn <= 20)"""

MONTHLY_B = f"""ms AS (
  SELECT date_key, period_date, year, month, month_name, year_month, quarter, semester,
         {xs('tonnes')} AS tonnes_total, {xs('fob_thousands')} AS fob_thousands_total,
         {xs('fob_usd')} AS fob_usd_total, COUNT(DISTINCT subcode) AS subcodes_reported
  FROM en GROUP BY ALL),
msp AS (SELECT *, CASE WHEN tonnes_total * 1000.0 > 0 AND fob_usd_total IS NOT NULL
                       THEN fob_usd_total / (tonnes_total * 1000.0) END AS weighted_price_usd_kg FROM ms)"""

ANNUAL_B = f"""ya AS (
  SELECT year, {xs('tonnes_total')} AS tonnes_total, {xs('fob_thousands_total')} AS fob_thousands_total,
         {xs('fob_usd_total')} AS fob_usd_total, COUNT(DISTINCT month) AS months_reported
  FROM msp GROUP BY year),
yb AS (SELECT *, CASE WHEN tonnes_total * 1000.0 > 0 AND fob_usd_total IS NOT NULL
                      THEN fob_usd_total / (tonnes_total * 1000.0) END AS weighted_price_usd_kg,
              months_reported = 12 AS complete FROM ya),
yc AS (SELECT c.year, c.tonnes_total, c.fob_thousands_total, c.fob_usd_total, c.months_reported,
              c.complete, c.weighted_price_usd_kg,
              CASE WHEN c.complete AND p.complete AND p.tonnes_total > 0
                   THEN c.tonnes_total / p.tonnes_total - 1.0 END AS yoy_tonnes,
              CASE WHEN c.complete AND p.complete AND p.fob_usd_total > 0
                   THEN c.fob_usd_total / p.fob_usd_total - 1.0 END AS yoy_fob_usd
       FROM yb c LEFT JOIN yb p ON p.year + 1 = c.year)"""

SERVING_B = f"""{SUBCODE}, {CATALOGUE}, {MONTHLY_B}, {ANNUAL_B},
sv0 AS (
  SELECT en.*, cat.short_label,
    CASE WHEN CAST(SUM(CAST(tonnes AS DECIMAL(38,6))) OVER (PARTITION BY period_date) AS DOUBLE) > 0
         THEN tonnes / CAST(SUM(CAST(tonnes AS DECIMAL(38,6))) OVER (PARTITION BY period_date) AS DOUBLE) END
      AS share_tonnes_period,
    CASE WHEN CAST(SUM(CAST(fob_usd AS DECIMAL(38,6))) OVER (PARTITION BY period_date) AS DOUBLE) > 0
         THEN fob_usd / CAST(SUM(CAST(fob_usd AS DECIMAL(38,6))) OVER (PARTITION BY period_date) AS DOUBLE) END
      AS share_fob_period,
    CAST(row_number() OVER (PARTITION BY period_date ORDER BY tonnes DESC NULLS LAST, en.subcode ASC) AS INTEGER)
      AS rank_tonnes_period,
    CAST(row_number() OVER (PARTITION BY period_date ORDER BY fob_usd DESC NULLS LAST, en.subcode ASC) AS INTEGER)
      AS rank_fob_period
  FROM en LEFT JOIN cat ON en.subcode = cat.subcode),
sv AS (
  SELECT sv0.period_date, period_text, sv0.year, month, month_name, year_month, quarter, semester,
         yc.months_reported, CASE WHEN yc.complete THEN 'COMPLETO' ELSE 'PARCIAL' END AS year_coverage,
         sv0.period_date = (SELECT max(period_date) FROM en) AS is_last_period,
         level3_code, level3_label, product_code, product_label, subcode,
         short_label AS subcode_label, tonnes, fob_thousands, fob_usd, unit_price_usd_kg,
         share_tonnes_period, share_fob_period, rank_tonnes_period, rank_fob_period,
         tonnes_prev_year, fob_usd_prev_year, sv0.yoy_tonnes, sv0.yoy_fob_usd
  FROM sv0 LEFT JOIN yc ON sv0.year = yc.year)"""

SQL["k12_enriched_subcode"] = f"WITH {SUBCODE} SELECT * FROM en"

SQL["k12_dim_date"] = f"""WITH {SUBCODE}
SELECT date_key, min(period_date) AS period_date, min(year) AS year, min(month) AS month,
       min(month_name) AS month_name, min(year_month) AS year_month, min(quarter) AS quarter,
       min(semester) AS semester FROM en GROUP BY date_key"""

SQL["k12_dim_product"] = f"""WITH {SUBCODE}
SELECT product_code AS product_key, min(level3_code) AS level3_code, min(level3_label) AS level3_label,
       product_code, min(product_label) AS product_label FROM sf GROUP BY product_code"""

SQL["k12_dim_subcode"] = f"""WITH {SUBCODE}, {CATALOGUE},
g AS (SELECT subcode AS subcode_key, min(subcode_label) AS official_label,
             min(product_code) AS product_code FROM sf GROUP BY subcode)
SELECT subcode_key, subcode_key AS subcode, official_label, short_label, product_code
FROM g LEFT JOIN cat ON g.subcode_key = cat.subcode"""

SQL["k13_fact_subcode"] = f"""WITH {SUBCODE}
SELECT date_key, product_code AS product_key, subcode AS subcode_key, tonnes, fob_thousands, fob_usd,
       unit_price_usd_kg FROM en"""

SQL["k14_monthly_summary"] = f"WITH {SUBCODE}, {MONTHLY_B} SELECT * FROM msp"

SQL["k14_annual_summary"] = f"WITH {SUBCODE}, {MONTHLY_B}, {ANNUAL_B} SELECT * FROM yc"

SQL["k15_flat_serving"] = f"WITH {SERVING_B} SELECT * FROM sv"

SQL["k16_kpi_subcode"] = f"""WITH {SERVING_B},
lp AS (SELECT max(period_date) AS p FROM msp),
lm AS (SELECT max(CASE WHEN period_date = (SELECT p FROM lp) THEN tonnes_total END) AS lt,
              max(CASE WHEN period_date = (SELECT p FROM lp) THEN fob_usd_total END) AS lf,
              max(CASE WHEN period_date = CAST((SELECT p FROM lp) - INTERVAL 12 MONTH AS DATE) THEN tonnes_total END) AS pt,
              max(CASE WHEN period_date = CAST((SELECT p FROM lp) - INTERVAL 12 MONTH AS DATE) THEN fob_usd_total END) AS pf
       FROM msp),
top AS (SELECT max(subcode) AS c, max(subcode_label) AS l FROM sv
        WHERE period_date = (SELECT p FROM lp) AND rank_fob_period = 1)
SELECT min(period_date) AS period_min, max(period_date) AS period_max,
       CAST(COUNT(DISTINCT period_date) AS INTEGER) AS periods,
       CAST(COUNT(DISTINCT subcode) AS INTEGER) AS subcodes,
       {xs('tonnes')} AS tonnes_total_all, {xs('fob_usd')} AS fob_usd_total_all,
       COALESCE((SELECT lt FROM lm), 0.0) AS tonnes_last_period,
       COALESCE((SELECT lf FROM lm), 0.0) AS fob_usd_last_period,
       CASE WHEN (SELECT pt FROM lm) > 0 THEN COALESCE((SELECT lt FROM lm), 0.0) / (SELECT pt FROM lm) - 1.0 END
         AS yoy_tonnes_last_comparable,
       CASE WHEN (SELECT pf FROM lm) > 0 THEN COALESCE((SELECT lf FROM lm), 0.0) / (SELECT pf FROM lm) - 1.0 END
         AS yoy_fob_last_comparable,
       (SELECT c FROM top) AS top_fob_subcode_last_period,
       (SELECT l FROM top) AS top_fob_subcode_label_last_period
FROM en"""
