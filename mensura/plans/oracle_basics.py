"""DuckDB oracle SQL for the single-operator queries of ``basics`` and R7."""

from __future__ import annotations

from .oracle import MONTHS_SQL, OM, RECON
from .oracle_audits import row_text
from .oracle_market import LONG, NON_ANALYTIC
from .oracle_resources import REC

_UNIT = {g: (f"CASE WHEN cut = 'MAYO' THEN regexp_extract(indicator, '^(dolares|libras)_(\\d{{4}})_05$', {g}) "
             f"ELSE regexp_extract(indicator, '^(dolares|libras)_ene_may_(\\d{{4}})$', {g}) END") for g in (1, 2)}
_ORDERS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "order_date": "date", "o_orderpriority": "string"}

SQL: dict[str, str] = {
    "o15_code_labels": "SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'CUMPLIDO' WHEN 'O' THEN 'ABIERTO' END AS label FROM orders",
    "o19_years_in_names": f"WITH {REC} SELECT doc_id, original_filename, TRY_CAST(NULLIF(regexp_extract(original_filename, '(\\d{{4}})', 1), '') AS INTEGER) AS year FROM rec",
    "o26_o27_months": f"""WITH {OM} SELECT period_date, CAST(period_date - INTERVAL 12 MONTH AS DATE) AS year_before,
  make_date(CAST(year(period_date) AS INTEGER), 5, 1) AS cut_date FROM om""",
    "o29_row_hashes": f"SELECT o_orderkey, sha256({row_text(_ORDERS)}) AS row_sha FROM (SELECT * EXCLUDE (o_orderdate), CAST(o_orderdate AS DATE) AS order_date FROM orders)",
    "f3_null_observations": f"WITH {RECON} SELECT count(*) AS \"rows\", count_if(qty_direct IS NULL) AS null_obs, count(qty_direct) AS kept_obs FROM r",
    "f4_f5_analytic_labels": f"""WITH {LONG} SELECT cut, label, indicator, contains(upper(label), 'NATION_1') AS has_token FROM ml
WHERE label IS NOT NULL AND trim(label) <> '' AND NOT regexp_matches(label, '{NON_ANALYTIC}')""",
    "f8_contract_projection": "SELECT o_orderkey AS pedido, CAST(o_orderdate AS DATE) AS fecha, o_totalprice AS valor FROM orders",
    "p3_units": f"""WITH {LONG}, u AS (SELECT *, {_UNIT[1]} AS unit, TRY_CAST(NULLIF({_UNIT[2]}, '') AS INTEGER) AS year FROM ml)
SELECT cut, label, year, max(CASE WHEN unit = 'dolares' THEN value END) AS dolares, max(CASE WHEN unit = 'libras' THEN value END) AS libras
FROM u WHERE unit <> '' AND year IS NOT NULL GROUP BY 1, 2, 3""",
    "p4_indicators": f"""WITH {LONG} SELECT cut, label, max(CASE WHEN indicator = 'variacion_dolares' THEN value END) AS pub_growth_value,
  max(CASE WHEN indicator = 'variacion_libras' THEN value END) AS pub_growth_qty, max(CASE WHEN indicator = 'participacion_libras' THEN value END) AS pub_share_qty
FROM ml WHERE indicator IN ('variacion_dolares', 'variacion_libras', 'participacion_libras') GROUP BY 1, 2""",
    "p5_calendar": f"""WITH {OM} SELECT period_date, qty, value, CAST(year(period_date) * 10000 + month(period_date) * 100 + 1 AS INTEGER) AS date_key,
  CAST(year(period_date) AS INTEGER) AS year, CAST(month(period_date) AS INTEGER) AS month, {MONTHS_SQL}[month(period_date)] AS month_name,
  strftime(period_date, '%Y-%m') AS year_month, CAST(quarter(period_date) AS INTEGER) AS quarter, CASE WHEN month(period_date) <= 6 THEN 1 ELSE 2 END AS semester,
  CASE WHEN qty > 0 AND value IS NOT NULL THEN value / qty END AS price FROM om""",
    "j3_j6_customers": """SELECT o_orderkey, o_custkey, c_nationkey AS n_nationkey, n_name FROM orders JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "r7_schema_contracts": "SELECT * FROM (VALUES " + ", ".join(
        f"('{t}', '{c}', '{k}', true, 'PASS')" for t, c, k in (
            ("flat_serving", "period_date", "required"), ("flat_serving", "subcode", "required"), ("flat_serving", "fob_usd", "required"),
            ("flat_serving", "country", "forbidden"), ("flat_serving", "pais", "forbidden"), ("market_serving", "dest", "required"), ("market_serving", "level", "required"),
            ("market_serving", "cut", "required"), ("market_serving", "year", "required"), ("market_serving", "pais", "forbidden"))) + ") t(\"table\", \"column\", kind, ok, status)",
}
