"""DuckDB oracle SQL for the refined pipelines (K18): the pipeline over the
cells must reproduce the sub-code fact, with each row's source row."""

from __future__ import annotations

from .oracle import NATIONAL_FACT, SUBCODE
from .oracle_market import HISTORY, WIDE

SQL: dict[str, str] = {}

SQL["k18_refined_subcode"] = f"""WITH {SUBCODE}
SELECT period_text, period_date, year, month, level3_code, level3_label, product_code, product_label,
       subcode, subcode_label, tonnes, fob_thousands, fob_usd,
       CAST(8 + ((year - 1990) * 12 + month - 1) * 300 + CAST(substr(subcode, 7, 4) AS INTEGER) * 11
            + CAST(product_code AS INTEGER) % 11 AS INTEGER) AS _source_row
FROM sf"""

SQL["r6_expected_rows"] = f"""WITH {NATIONAL_FACT}, {SUBCODE}, {WIDE},
c AS (SELECT 'national_monthly' AS "table", (SELECT COUNT(*) FROM nb) AS n
      UNION ALL SELECT 'national_annual', (SELECT COUNT(DISTINCT year) FROM nb)
      UNION ALL SELECT 'flat_serving', (SELECT COUNT(*) FROM en)
      UNION ALL SELECT 'annual_summary', (SELECT COUNT(DISTINCT year) FROM en)
      UNION ALL SELECT 'market_serving', (SELECT COUNT(*) FROM (SELECT DISTINCT dest, cut, year FROM wide WHERE level = 'DETALLADO')))
SELECT "table", CAST(n AS BIGINT) AS expected_rows, CAST(n AS BIGINT) AS rows, 'PASS' AS status FROM c"""

SQL["k6_national_fact"] = f"WITH {NATIONAL_FACT} SELECT * FROM nf"

SQL["k6_comparative_fact"] = f"""WITH {HISTORY}
SELECT CASE WHEN cut = 'MAYO' THEN 1 WHEN cut = 'ACUM_ENE_MAY' THEN 2 END AS cut_key,
       CAST(year * 10000 + 501 AS INTEGER) AS date_key, year, qty, value, price, yoy_qty, yoy_value,
       pub_growth_qty, pub_growth_value
FROM hcd"""
