"""DuckDB oracle SQL for the fingerprints (R1), the A/B comparison (R8) and the
expected rows (R6): the same typed row text and sums, over the oracle's rows."""

from __future__ import annotations

import hashlib
import json

from . import oracle, oracle_market

#: Columns of the gold serving tables with their types (the schema contract).
SCHEMAS = {
    "national_monthly": "period_date:date year:int month:int month_name:string year_month:string quarter:int semester:int qty:double value:double "
                        "price:double mom_qty:double mom_value:double yoy_qty:double yoy_value:double source_qty:string source_value:string reconciliation_state:string",
    "national_annual": "year:int months_reported:bigint complete:boolean qty_total:double value_total:double weighted_price:double yoy_qty:double yoy_value:double",
    "market_serving": "label_source:string dest:string level:string cut:string year:int qty:double value:double price:double share_qty:double rank_value:int "
                      "rank_qty:int yoy_qty:double yoy_value:double pub_growth_qty:double pub_growth_value:double pub_share_qty:double diff_growth_qty:double "
                      "diff_growth_value:double check_growth_qty:string check_growth_value:string",
    "flat_serving": "period_date:date period_text:string year:int month:int month_name:string year_month:string quarter:int semester:int months_reported:bigint "
                    "year_coverage:string is_last_period:boolean level3_code:string level3_label:string product_code:string product_label:string subcode:string "
                    "subcode_label:string tonnes:double fob_thousands:double fob_usd:double unit_price_usd_kg:double share_tonnes_period:double "
                    "share_fob_period:double rank_tonnes_period:int rank_fob_period:int tonnes_prev_year:double fob_usd_prev_year:double yoy_tonnes:double yoy_fob_usd:double",
    "annual_summary": "year:int tonnes_total:double fob_thousands_total:double fob_usd_total:double months_reported:bigint complete:boolean "
                      "weighted_price_usd_kg:double yoy_tonnes:double yoy_fob_usd:double",
}
ROWS = {"national_monthly": oracle.SQL["k7_national_monthly"], "national_annual": oracle.SQL["k8_national_annual"],
        "market_serving": oracle_market.SQL["k9_market_serving"], "flat_serving": oracle.SQL["k15_flat_serving"],
        "annual_summary": oracle.SQL["k14_annual_summary"]}


def _double(c: str) -> str:
    guess = f"floor(log2(abs({c})))"
    exponent = (f"({guess} + CASE WHEN abs({c}) * pow(2.0::DOUBLE, -{guess}) >= 2 THEN 1 WHEN abs({c}) * pow(2.0::DOUBLE, -{guess}) < 1 THEN -1 ELSE 0 END)")
    return (f"CASE WHEN isnan({c}) THEN 'nan' WHEN abs({c}) < 1e-300 THEN '0' WHEN isinf({c}) THEN CASE WHEN {c} < 0 THEN '-inf' ELSE 'inf' END "
            f"ELSE CASE WHEN {c} < 0 THEN '-' ELSE '' END || CAST(CAST(abs({c}) * pow(2.0::DOUBLE, -{exponent}) * 4503599627370496.0::DOUBLE AS BIGINT) AS VARCHAR) "
            f"|| 'e' || CAST(CAST({exponent} AS BIGINT) AS VARCHAR) END")


def _value(c: str, kind: str) -> str:
    text = {"string": f"'S' || CAST(length({c}) AS VARCHAR) || ':' || {c}", "double": f"'F' || {_double(c)}",
            "boolean": f"'B' || CASE WHEN {c} THEN '1' ELSE '0' END", "date": f"'D' || CAST({c} AS VARCHAR)"}.get(kind, f"'I' || CAST({c} AS VARCHAR)")
    return f"CASE WHEN {c} IS NULL THEN '~' ELSE {text} END"


def row_text(columns: dict[str, str]) -> str:
    """The typed row text of columns with their types."""
    return " || '|' || ".join(_value(c, kind) for c, kind in sorted(columns.items()))


def _table(name: str) -> tuple[str, str]:
    """(CTEs, fingerprint row) of a table."""
    columns = sorted(x.split(":") for x in SCHEMAS[name].split())
    schema = hashlib.sha256(json.dumps([tuple(x) for x in columns], separators=(",", ":")).encode()).hexdigest()
    row = row_text(dict(columns))
    ctes = f"""{name}_r AS ({ROWS[name]}),
{name}_h AS (SELECT sha256({row}) AS h FROM {name}_r),
{name}_s AS (SELECT count(*) AS n, coalesce(sum(CAST('0x' || h[1:15] AS BIGINT)), 0) AS s1, coalesce(sum(CAST('0x' || h[16:30] AS BIGINT)), 0) AS s2 FROM {name}_h)"""
    return ctes, (f"SELECT '{name}' AS \"table\", CAST(n AS BIGINT) AS \"rows\", '{','.join(c for c, _ in columns)}' AS columns, '{schema}' AS schema_sha, "
                  f"sha256(CAST(n AS VARCHAR) || ':' || CAST(s1 AS VARCHAR) || ':' || CAST(s2 AS VARCHAR)) AS content_sha FROM {name}_s")


_PARTS = [_table(name) for name in SCHEMAS]
PRINTS = "WITH " + ",\n".join(c for c, _ in _PARTS) + ",\nprints AS (" + "\nUNION ALL ".join(r for _, r in _PARTS) + ")"
_FIELDS = ("rows", "columns", "schema_sha", "content_sha")

SQL: dict[str, str] = {
    "r1_fingerprints": f"{PRINTS}\nSELECT * FROM prints",
    "r8_compare_runs": PRINTS + "\nSELECT '*run*' AS \"table\", 'run_id' AS \"check\", 'run-A' AS run_a, 'run-B' AS run_b, false AS equal, 'PASS' AS status\n"
    + "\n".join(f"UNION ALL SELECT \"table\", '{f}', CAST(\"{f}\" AS VARCHAR), CAST(\"{f}\" AS VARCHAR), true, 'PASS' FROM prints" for f in _FIELDS),
}
