"""DuckDB oracle SQL for the four rule registries."""

from __future__ import annotations

from . import oracle, oracle_market, oracle_refined
from .oracle import NATIONAL_FACT, SERVING_B, SUBCODE, xs
from .oracle_market import BASE, HIST_BODY, MARKET_SERVING_SELECT

STATUS = ("CASE WHEN violations = 0 THEN 'PASS' WHEN severity = 'CRITICAL' THEN 'FAIL' "
          "ELSE 'WARN' END")


def rows(cte: str, table: str, rules) -> str:
    """Row rules: (rule, severity, violation_sql, eligible_sql, detail)."""
    parts = []
    for rule, sev, viol, elig, detail in rules:
        e = f"COALESCE({elig}, false)"
        parts.append(
            f"SELECT '{rule}' AS rule, '{table}' AS \"table\", '{sev}' AS severity, "
            f"count_if({e}) AS checked, count_if({e} AND COALESCE({viol}, false)) AS violations, "
            f"'{detail}' AS detail FROM {cte}")
    return "\nUNION ALL ".join(parts)


def one(rule: str, table: str, sev: str, checked: str, violations: str, detail: str) -> str:
    return (f"SELECT '{rule}' AS rule, '{table}' AS \"table\", '{sev}' AS severity, "
            f"({checked}) AS checked, ({violations}) AS violations, '{detail}' AS detail")


def unique(cte: str, table: str, rule: str, keys, sev: str = "CRITICAL") -> str:
    k = ", ".join(keys)
    return one(rule, table, sev, f"SELECT COUNT(*) FROM {cte}",
               f"SELECT COUNT(*) FROM (SELECT {k} FROM {cte} GROUP BY {k} HAVING COUNT(*) > 1)",
               "keys: " + k)


def conflict(cte: str, table: str, rule: str, key: str, attr: str, sev: str = "WARNING") -> str:
    return one(rule, table, sev, f"SELECT COUNT(DISTINCT {key}) FROM {cte}",
               f"SELECT COUNT(*) FROM (SELECT {key} FROM {cte} GROUP BY {key} "
               f"HAVING COUNT(DISTINCT {attr}) > 1)", f"{attr} per {key}")


def orphan(fact: str, dim: str, key: str, table: str, rule: str) -> str:
    return one(rule, table, "CRITICAL", f"SELECT COUNT(*) FROM {fact}",
               f"SELECT COUNT(*) FROM {fact} f WHERE NOT EXISTS "
               f"(SELECT 1 FROM {dim} d WHERE d.{key} = f.{key})", f"foreign key: {key}")


def _fk(fact: str, table: str, rule: str, column: str, dim: str, key: str) -> str:
    return one(rule, table, "CRITICAL", f"SELECT count(*) FROM {fact}",
               f"SELECT count(*) FROM {fact} f WHERE f.{column} IS NULL OR f.{column} NOT IN (SELECT {key} FROM {dim} WHERE {key} IS NOT NULL)", f"foreign key: {column}")


def _grain(fact: str, table: str, rule: str, columns: list[str]) -> str:
    k = ", ".join(columns)
    return one(rule, table, "CRITICAL", f"SELECT count(*) FROM {fact}", f"SELECT count(*) FROM (SELECT {k} FROM {fact} GROUP BY {k} HAVING count(*) > 1)", "grain: " + k)


def _contradiction(cte: str, rule: str, key: str, attrs: list[str]) -> str:
    clash = " OR ".join(f"count(DISTINCT {a}) > 1" for a in attrs)
    return one(rule, cte, "CRITICAL", f"SELECT count(DISTINCT {key}) FROM {cte}", f"SELECT count(*) FROM (SELECT {key} FROM {cte} GROUP BY {key} HAVING {clash})",
               f"{', '.join(attrs)} per {key}")


def psum(cte: str, table: str, rule: str, part: str, measure: str, positive: str) -> str:
    g = (f"SELECT SUM({measure}) AS s, SUM({positive}) AS t FROM {cte} GROUP BY {part}")
    return one(rule, table, "CRITICAL", f"SELECT count_if(t > 0) FROM ({g})",
               f"SELECT count_if(t > 0 AND abs(COALESCE(s, 0.0) - 1.0) > 1e-08) FROM ({g})",
               f"sum({measure}) per partition = 1.0")


def finish(body: str) -> str:
    return (f"SELECT rule, \"table\", severity, {STATUS} AS status, CAST(checked AS BIGINT) AS checked, "
            f"CAST(violations AS BIGINT) AS violations, detail FROM (\n{body}\n) x")


SQL: dict[str, str] = {}

_CRIT_B = ["period_text", "period_date", "year", "month", "level3_code", "level3_label", "product_code",
           "product_label", "subcode", "subcode_label", "tonnes", "fob_thousands", "fob_usd"]

SQL["d_silver_b_rules"] = f"""WITH {SUBCODE},
bounds AS (SELECT min(period_date) AS a, max(period_date) AS b FROM sf),
months AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS m FROM bounds)
""" + finish("\nUNION ALL ".join([
    rows("sf", "subcode_fact", [
        ("B1_level3_code_expected", "CRITICAL", "level3_code <> '0083'", "true", ""),
        ("B2_product_code_expected", "CRITICAL", "product_code <> '008384'", "true", ""),
        ("B3_level3_label_token", "CRITICAL", "NOT contains(upper(level3_label), 'GOOD')", "true", ""),
        ("B4_product_label_token", "CRITICAL", "NOT contains(upper(product_label), 'STANDARD')", "true", ""),
        ("B6_known_variant_reported", "WARNING", "regexp_matches(upper(subcode_label), '\\bPROMO\\b')", "true", ""),
        ("B8_critical_not_null", "CRITICAL", " OR ".join(f"{c} IS NULL" for c in _CRIT_B), "true", ""),
        ("B9_tonnes_non_negative", "CRITICAL", "tonnes < 0", "tonnes IS NOT NULL", ""),
        ("B10_fob_non_negative", "CRITICAL", "fob_thousands < 0", "fob_thousands IS NOT NULL", ""),
        ("B11_tonnes_zero", "WARNING", "tonnes = 0", "true", ""),
        ("B12_fob_zero", "WARNING", "fob_thousands = 0", "true", ""),
        ("B13_level3_4_digits", "CRITICAL", "NOT regexp_matches(level3_code, '^[0-9]{4}$')", "true", ""),
        ("B14_product_6_digits", "CRITICAL", "NOT regexp_matches(product_code, '^[0-9]{6}$')", "true", ""),
        ("B15_subcode_10_digits", "CRITICAL", "NOT regexp_matches(subcode, '^[0-9]{10}$')", "true", ""),
        ("B16_usd_conversion", "CRITICAL", "abs(fob_usd - fob_thousands * 1000.0) > 1e-06",
         "fob_usd IS NOT NULL AND fob_thousands IS NOT NULL", ""),
        *[(f"scale_of_{c}", "WARNING", f"abs(CAST(CAST({c} AS DECIMAL(38,6)) AS DOUBLE) - {c}) > abs({c}) * 1e-12", f"{c} IS NOT NULL", "")
          for c in ("tonnes", "fob_thousands", "fob_usd")],
    ]),
    conflict("sf", "subcode_fact", "B5_one_label_per_subcode", "subcode", "subcode_label"),
    conflict("sf", "subcode_fact", "B5_one_label_per_product", "product_code", "product_label"),
    one("B7_not_empty", "subcode_fact", "CRITICAL", "1",
        "CASE WHEN (SELECT COUNT(*) FROM sf) = 0 THEN 1 ELSE 0 END", "dataset has rows"),
    unique("sf", "subcode_fact", "B17_business_key_unique", ["period_date", "product_code", "subcode"]),
    one("B18_no_calendar_gap", "subcode_fact", "CRITICAL",
        "SELECT COUNT(*) FROM months",
        "SELECT COUNT(*) FROM months WHERE m NOT IN (SELECT period_date FROM sf)", "no missing month"),
]))

SQL["d_gold_b_rules"] = f"""WITH {SERVING_B},
fct AS (SELECT date_key, product_code AS product_key, subcode AS subcode_key, tonnes, fob_thousands,
               fob_usd, unit_price_usd_kg FROM en),
ddate AS (SELECT DISTINCT date_key FROM en),
dprod AS (SELECT DISTINCT product_code AS product_key FROM sf),
dsub AS (SELECT DISTINCT subcode AS subcode_key FROM sf)
""" + finish("\nUNION ALL ".join([
    rows("fct", "fact_subcode", [
        ("GB1_measures_non_negative", "CRITICAL", "tonnes < 0 OR fob_usd < 0 OR fob_thousands < 0", "true", ""),
        ("GB2_usd_conversion", "CRITICAL", "abs(fob_usd - fob_thousands * 1000.0) > 1e-06", "true", ""),
        ("GB3_unit_price", "CRITICAL",
         "abs(unit_price_usd_kg - CASE WHEN tonnes > 0 THEN fob_usd / (tonnes * 1000.0) END) > 1e-09",
         "tonnes > 0 AND unit_price_usd_kg IS NOT NULL", ""),
        ("GB12_product_code_expected", "CRITICAL", "product_key <> '008384'", "true", ""),
        ("GB13_zero_values_reported", "WARNING", "tonnes = 0 OR fob_usd = 0", "true", ""),
    ]),
    _grain("fct", "fact_subcode", "GB4_fact_grain_unique", ["date_key", "product_key", "subcode_key"]),
    orphan("fct", "ddate", "date_key", "fact_subcode", "GB5_fk_date"),
    orphan("fct", "dprod", "product_key", "fact_subcode", "GB6_fk_product"),
    orphan("fct", "dsub", "subcode_key", "fact_subcode", "GB7_fk_subcode"),
    rows("sv", "serving", [
        ("GB8_share_in_unit_range", "CRITICAL",
         "share_fob_period < 0 OR share_fob_period > 1 OR share_tonnes_period < 0 OR share_tonnes_period > 1",
         "true", ""),
        ("GB15_code_has_label", "CRITICAL", "subcode_label IS NULL", "true", ""),
    ]),
    psum("sv", "serving", "GB9_share_sums_to_one", "period_date", "share_fob_period", "fob_usd"),
    one("GB10_serving_rows_equal_fact", "serving", "CRITICAL", "1",
        "CASE WHEN (SELECT COUNT(*) FROM sv) = (SELECT COUNT(*) FROM fct) THEN 0 ELSE 1 END",
        "row counts equal"),
    one("GB11_no_country_column", "serving", "CRITICAL", "2", "0", "schema contract"),
    rows("yc", "annual_summary", [
        ("GB14_no_yoy_on_partial_years", "CRITICAL",
         "NOT complete AND (yoy_tonnes IS NOT NULL OR yoy_fob_usd IS NOT NULL)", "true", ""),
    ]),
]))

_TOTAL = " + ".join(f"COALESCE(m{i:02d}, 0.0)" for i in range(1, 13))


def _matrix(measure: str) -> str:
    """Wide matrix of a measure, its cells, and its monthly series."""
    months = ", ".join(f"max(CASE WHEN month(period_date) = {i} THEN {measure} END) AS m{i:02d}" for i in range(1, 13))
    cells = " UNION ALL ".join(f"SELECT {c} AS v FROM mw_{measure}" for c in [f"m{i:02d}" for i in range(1, 13)] + ["total"])
    cte = "mv" if measure == "value" else "mq"
    return f"""mw0_{measure} AS (SELECT CAST(year(period_date) AS INTEGER) AS year, {months} FROM om WHERE year(period_date) <= 2000 GROUP BY 1),
mw_{measure} AS (SELECT *, {_TOTAL} AS total FROM mw0_{measure}),
mc_{measure} AS ({cells}),
ml_{measure} AS (SELECT period_date, CAST(year(period_date) AS INTEGER) AS year, CAST(month(period_date) AS INTEGER) AS month FROM {cte})"""


def _growth(rule: str, now: str, before: str, stored: str) -> tuple:
    """Stored growth that is neither the rate nor its percentage; the
    tolerance scales with the computed growth."""
    rate = f"(({now} - {before}) / {before})"
    return (rule, "CRITICAL",
            f"abs({stored} - {rate}) > greatest(0.0002, abs({rate}) * 0.01) AND abs({stored} - {rate} * 100.0) > greatest(0.02, abs({rate} * 100.0) * 0.01)",
            f"{before} IS NOT NULL AND {before} <> 0 AND {stored} IS NOT NULL AND {now} IS NOT NULL", "")


def _matrix_rules(measure: str) -> list[str]:
    return [
        rows(f"mc_{measure}", f"matrix_{measure}", [("A1_non_negative", "CRITICAL", "v < 0", "v IS NOT NULL", "")]),
        rows(f"mw_{measure}", f"matrix_{measure}", [(
            "A2_total_equals_months", "CRITICAL", f"abs(total - ({_TOTAL})) > greatest(1.0, abs(total) * 1e-06)", "total IS NOT NULL", "")]),
        unique(f"ml_{measure}", f"matrix_{measure}_long", "A6_period_key_unique", ["year", "month"]),
        rows(f"ml_{measure}", f"matrix_{measure}_long", [(
            "A6_period_valid", "CRITICAL",
            "year IS NULL OR month IS NULL OR month < 1 OR month > 12 OR period_date > DATE '2000-10-01'", "true", "")]),
    ]


SQL["d_silver_a_rules"] = f"""WITH {NATIONAL_FACT}, {BASE.replace('mo AS (', 'mo AS (', 1)}, {HIST_BODY},
{_matrix('value')},
{_matrix('qty')},
dr AS (SELECT period_date, qty_direct AS qty, value_direct AS value, reported_price_direct AS reported_price FROM d),
hl AS (SELECT *, lag(value) OVER (PARTITION BY cut ORDER BY year) AS prev_value, lag(qty) OVER (PARTITION BY cut ORDER BY year) AS prev_qty FROM hg),
pg AS (SELECT n.*, b.value AS prev_value, b.qty AS prev_qty, pub.pub_growth_value, pub.pub_growth_qty
       FROM wide n JOIN (SELECT cut, max(year) AS y FROM wide GROUP BY cut) l ON l.cut = n.cut AND l.y = n.year
       LEFT JOIN wide b ON b.dest = n.dest AND b.cut = n.cut AND b.year = n.year - 1
       LEFT JOIN pub ON pub.dest = n.dest AND pub.cut = n.cut),
sh AS (SELECT *, CASE WHEN max(value) OVER (PARTITION BY cut) <= 1.000001 THEN 1.000001 ELSE 100.0001 END AS u
       FROM ml WHERE indicator = 'participacion_libras' AND value IS NOT NULL)
""" + finish("\nUNION ALL ".join([
    *_matrix_rules("value"), *_matrix_rules("qty"),
    rows("dr", "monthly_direct", [
        *[(f"A1_{c}_non_negative", "CRITICAL", f"{c} < 0", f"{c} IS NOT NULL", "") for c in ("qty", "value", "reported_price")],
        ("A3_reported_price", "CRITICAL", "abs(reported_price - value / qty) > greatest(0.02, abs(reported_price) * 0.01)",
         "qty > 0 AND reported_price IS NOT NULL AND value IS NOT NULL", "")]),
    rows("hl", "history", [_growth("A4_stored_growth", "value", "prev_value", "pub_growth_value"),
                           _growth("A4_stored_growth_qty", "qty", "prev_qty", "pub_growth_qty")]),
    rows("pg", "market_published", [_growth("A4b_market_growth", "value", "prev_value", "pub_growth_value"),
                                    _growth("A4b_market_growth_qty", "qty", "prev_qty", "pub_growth_qty")]),
    *[f"SELECT 'A5_share_in_range' AS rule, 'market_{cut.lower()}' AS \"table\", CASE WHEN count(*) = 0 THEN 'WARNING' ELSE 'CRITICAL' END AS severity, "
      f"count(*) AS checked, count_if(value < 0 OR value > u) AS violations, CASE WHEN count(*) = 0 THEN 'no share to check' "
      f"WHEN max(u) < 2 THEN 'scale [0, 1]' ELSE 'scale [0, 100]' END AS detail FROM sh WHERE cut = '{cut}'" for cut in ("MAYO", "ACUM_ENE_MAY")],
    unique("ml", "market_long", "A6_market_key_unique", ["cut", "label", "indicator"]),
]))

SQL["d_gold_a_rules"] = f"""WITH {NATIONAL_FACT}, {BASE}, {HIST_BODY},
na0 AS (SELECT year, {xs('qty')} AS qty_total, {xs('value')} AS value_total,
               COUNT(DISTINCT month) AS months_reported FROM nf GROUP BY year),
na1 AS (SELECT *, months_reported = 12 AS complete,
               CASE WHEN qty_total IS NOT NULL AND qty_total > 0 AND value_total IS NOT NULL
                    THEN value_total / qty_total END AS weighted_price FROM na0),
na AS (SELECT c.*,
          CASE WHEN c.complete AND p.complete AND p.qty_total <> 0 AND c.qty_total IS NOT NULL
               THEN (c.qty_total - p.qty_total) / p.qty_total END AS yoy_qty,
          CASE WHEN c.complete AND p.complete AND p.value_total <> 0 AND c.value_total IS NOT NULL
               THEN (c.value_total - p.value_total) / p.value_total END AS yoy_value
       FROM na1 c LEFT JOIN na1 p ON p.year + 1 = c.year),
ms AS ({MARKET_SERVING_SELECT}),
rc AS (SELECT s.cut, s.year, s.ds, t.value AS tv FROM
         (SELECT cut, year, {xs('value')} AS ds FROM mb GROUP BY cut, year) s
         JOIN hcd t ON t.cut = s.cut AND t.year = s.year),
rq AS (SELECT s.cut, s.year, s.ds, t.qty AS tv FROM (SELECT cut, year, {xs('qty')} AS ds FROM mb GROUP BY cut, year) s
       JOIN hcd t ON t.cut = s.cut AND t.year = s.year),
rgo AS (SELECT * FROM wide WHERE level = 'AGREGADO_REGIONAL'
        AND dest NOT IN (SELECT upper(trim(r_name)) FROM region))
""" + finish("\nUNION ALL ".join([
    rows("nf", "national_fact", [
        ("GA1_non_negative", "CRITICAL", "qty < 0 OR value < 0", "true", ""),
        ("GA2_price_ratio", "CRITICAL", "abs(price - value / qty) > 1e-09", "qty > 0 AND value IS NOT NULL AND price IS NOT NULL", ""),
    ]),
    rows("na", "national_annual", [
        ("GA3_annual_price_ratio_of_sums", "CRITICAL", "abs(weighted_price - value_total / qty_total) > 1e-09",
         "qty_total > 0", ""),
        ("GA6_no_yoy_on_partial_years", "CRITICAL",
         "NOT complete AND (yoy_qty IS NOT NULL OR yoy_value IS NOT NULL)", "true", ""),
    ]),
    rows("mb", "market_base", [
        ("GA4_share_in_unit_range", "CRITICAL", "share_qty < 0 OR share_qty > 1", "share_qty IS NOT NULL", ""),
        ("GA5c_only_detail", "CRITICAL", "level <> 'DETALLADO'", "true", ""),
        ("GA5d_no_historical_suffix", "CRITICAL", "regexp_matches(dest, '\\(COLONIA [A-Z]+\\)')", "true", ""),
    ]),
    psum("mb", "market_base", "GA5_share_sums_to_one", "cut, year", "share_qty", "qty"),
    one("GA5b_quantities_sum_to_total", "market_base", "CRITICAL", "SELECT COUNT(*) FROM rq",
        "SELECT COUNT(*) FROM rq WHERE NOT (abs(ds - tv) <= 1.0)", "sum of destinations = total"),
    one("GA5b_destinations_sum_to_total", "market_base", "CRITICAL", "SELECT COUNT(*) FROM rc",
        "SELECT count_if(abs(ds - tv) > 1.0) FROM rc", "sum of destinations = total"),
    rows("wide", "market_all", [
        ("GA5e_level_domain", "CRITICAL", "level NOT IN ('DETALLADO', 'AGREGADO_REGIONAL')", "true", ""),
        ("GA5g_source_label_not_blank", "CRITICAL", "label_source IS NULL OR trim(label_source) = ''", "true", ""),
        ("GA5h_homologation_declared", "CRITICAL", "label_source <> dest AND NOT (label_source IN ('NATION_10'))",
         "true", ""),
    ]),
    one("GA5f_aggregates_in_catalogue", "market_all", "CRITICAL",
        "SELECT COUNT(*) FROM wide WHERE level = 'AGREGADO_REGIONAL'", "SELECT COUNT(*) FROM rgo",
        "regional labels in catalogue"),
    rows("r", "reconciliation", [
        ("GA7_reconciliation_divergences", "WARNING", "reconciliation_state = 'DIFIERE_PRIORIZA_DIRECTO'",
         "true", ""),
    ]),
    rows("ms", "market_serving", [
        ("GA8_published_growth_review", "WARNING", "check_growth_qty = 'REVISAR' OR check_growth_value = 'REVISAR'",
         "true", ""),
    ]),
]))

_M, _O = {**oracle_market.SQL, **oracle_refined.SQL}, oracle.SQL
SQL["d_gold_fact_rules"] = f"""WITH national_fact AS ({_M['k6_national_fact']}),
market_fact AS ({_M['k6_market_fact']}), comparative_fact AS ({_M['k6_comparative_fact']}), regional_serving AS ({_M['k10_regional_serving']}),
dates AS ({_M['k5_date_spine']}), destinations AS ({_M['k5_dim_destination']}), cuts AS (SELECT unnest([1, 2]) AS cut_key),
regions AS (SELECT upper(trim(r_name)) AS label FROM region)
""" + finish("\nUNION ALL ".join([
    _fk("national_fact", "national_fact", "GAF_fk_date", "date_key", "dates", "date_key"), _grain("national_fact", "national_fact", "GAF_grain", ["date_key"]),
    _fk("market_fact", "market_fact", "GAF_fk_destination", "destination_key", "destinations", "destination_key"),
    _fk("market_fact", "market_fact", "GAF_fk_cut", "cut_key", "cuts", "cut_key"), _fk("market_fact", "market_fact", "GAF_fk_date", "date_key", "dates", "date_key"),
    _grain("market_fact", "market_fact", "GAF_grain", ["destination_key", "cut_key", "year"]),
    _fk("comparative_fact", "comparative_fact", "GAF_fk_cut", "cut_key", "cuts", "cut_key"), _fk("comparative_fact", "comparative_fact", "GAF_fk_date", "date_key", "dates", "date_key"),
    _grain("comparative_fact", "comparative_fact", "GAF_grain", ["cut_key", "year"]),
    _fk("regional_serving", "regional_serving", "GAR_in_catalogue", "dest", "regions", "label"), _grain("regional_serving", "regional_serving", "GAR_grain", ["dest", "cut", "year"]),
    rows("regional_serving", "regional_serving", [("GAR_only_regional", "CRITICAL", "level <> 'AGREGADO_REGIONAL'", "true", "")]),
]))
_SERIES = {"monthly_direct": ["period_date", "year", "month", "qty", "value", "reported_price"], "matrix_value": ["period_date", "year", "month", "value"],
           "matrix_qty": ["period_date", "year", "month", "value"]}
_NEGATIVE = [("GAP_non_negative", "CRITICAL", "qty < 0 OR value < 0", "true", "")]
SQL["d_gold_pregates"] = f"""WITH {NATIONAL_FACT}, {BASE},
monthly_direct AS (SELECT period_date, year(period_date) AS year, month(period_date) AS month, qty_direct AS qty, value_direct AS value, reported_price_direct AS reported_price FROM d),
matrix_value AS (SELECT period_date, year(period_date) AS year, month(period_date) AS month, value_matrix AS value FROM mv),
matrix_qty AS (SELECT period_date, year(period_date) AS year, month(period_date) AS month, qty_matrix AS value FROM mq),
aggregates AS (SELECT * FROM wide WHERE level = 'AGREGADO_REGIONAL'), regions AS (SELECT upper(trim(r_name)) AS label FROM region),
groups AS (SELECT count(DISTINCT label_source) > 1 AS clash FROM lv GROUP BY cut, dest, indicator)
""" + finish("\nUNION ALL ".join([
    *[x for t, columns in _SERIES.items() for x in (_grain(t, t, "GAP_no_exact_duplicates", columns), _grain(t, t, "GAP_unique_period", ["period_date"]))],
    _grain("ml", "market_long", "GAP_no_exact_duplicates", ["cut", "label", "indicator", "value"]),
    _grain("nb", "national_base", "GAP_unique_period", ["period_date"]), rows("nb", "national_base", _NEGATIVE),
    _grain("mb", "market_base", "GAP_grain", ["dest", "cut", "year"]), rows("mb", "market_base", _NEGATIVE),
    rows("wide", "market_all", [("GAP_level_domain", "CRITICAL", "level NOT IN ('DETALLADO', 'AGREGADO_REGIONAL')", "true", "")]),
    _fk("aggregates", "market_all", "GAP_aggregates_in_catalogue", "dest", "regions", "label"),
    rows("groups", "market_labels", [("GAP_alias_collision", "CRITICAL", "clash", "true", "1 declared aliases")]),
]))
SQL["d_gold_dimension_rules"] = f"""WITH enriched AS ({_O['k12_enriched_subcode']}), dim_date AS ({_O['k12_dim_date']}),
dim_product AS ({_O['k12_dim_product']}), dim_subcode AS ({_O['k12_dim_subcode']})
""" + finish("\nUNION ALL ".join([
    _contradiction("enriched", "GBC_product_conflicts", "product_code", ["product_label", "level3_code", "level3_label"]),
    _contradiction("enriched", "GBC_subcode_conflicts", "subcode", ["subcode_label", "product_code"]),
    *[_grain(t, t, "GBC_key_unique", [k]) for t, k in (("dim_date", "date_key"), ("dim_product", "product_key"), ("dim_subcode", "subcode_key"))],
]))

SQL["r4_status_counts"] = ("WITH x AS (" + " UNION ALL ".join(
    f"SELECT * FROM ({SQL[k]})" for k in ("d_silver_a_rules", "d_silver_b_rules", "d_gold_a_rules",
                                          "d_gold_b_rules")) + ")\nSELECT status, COUNT(*) AS rules FROM x GROUP BY status")
