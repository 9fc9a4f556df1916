"""DuckDB oracle SQL for K17: the seven tables, their rules and their audits,
computed from the base tables (no workbook in between)."""

from __future__ import annotations

from .oracle import DIRECT, OM
from .oracle_market import CELLS
from .oracle_rules import finish, one, rows, unique

MC = [f"m{i:02d}" for i in range(1, 13)]
CUTOFF = "DATE '2000-10-01'"


def _num(c: str, digits: int) -> str:
    """What a reader gets from a number written with so many decimals."""
    return f"CAST(CAST(CAST({c} AS DECIMAL(24,{digits})) AS VARCHAR) AS DOUBLE)"


def _matrix(name: str, measure: str) -> str:
    cells = ", ".join(f"max(CASE WHEN month(period_date) = {i} THEN {_num(measure, 2)} END) AS {m}" for i, m in enumerate(MC, 1))
    return f"""w_{name} AS (SELECT CAST(year(period_date) AS INTEGER) AS year, {cells},
    CAST(CAST(SUM(CAST({measure} AS DECIMAL(20,2))) AS VARCHAR) AS DOUBLE) AS total FROM om GROUP BY 1),
b_{name} AS (SELECT make_date(year, month, 1) AS period_date, year, CAST(month AS INTEGER) AS month, value
  FROM (SELECT year, unnest(range(1, 13)) AS month, unnest([{', '.join(MC)}]) AS value FROM w_{name})),
t_{name} AS (SELECT * FROM b_{name} WHERE value IS NOT NULL AND period_date <= {CUTOFF})"""


def _history(name: str, cut: str, key: str) -> str:
    return f"""w_{name} AS (SELECT {key}, {_num('qty', 0)} AS qty, {_num('value', 2)} AS value, {_num('gq', 9)} AS growth_qty, {_num('gv', 9)} AS growth_value
  FROM hg WHERE cut = '{cut}')"""


def _market(name: str, cut: str, unit: str) -> str:
    return f"""w_{name} AS (SELECT upper(trim(label)) AS label, {_num('va', 2)} AS value_2000_{unit}, {_num('qa', 0)} AS qty_2000_{unit},
    {_num('vb', 2)} AS value_2001_{unit}, {_num('qb', 0)} AS qty_2001_{unit}, {_num('CASE WHEN va <> 0 THEN (vb - va) / va END', 9)} AS growth_value,
    {_num('CASE WHEN qa <> 0 THEN (qb - qa) / qa END', 9)} AS growth_qty,
    {_num("CASE WHEN (SELECT qb FROM mk t WHERE t.cut = mk.cut AND starts_with(t.label, 'TOTAL')) > 0 THEN qb / (SELECT qb FROM mk t WHERE t.cut = mk.cut AND starts_with(t.label, 'TOTAL')) END", 9)} AS share_qty
  FROM mk WHERE cut = '{cut}'),
t_{name} AS (SELECT * FROM (UNPIVOT w_{name} ON COLUMNS(* EXCLUDE (label)) INTO NAME indicator VALUE value))"""


BODY = f"""{OM}, {DIRECT}, {CELLS},
w_monthly AS (SELECT period_date, {_num('qty_direct', 0)} AS qty, {_num('value_direct', 2)} AS value, {_num('reported_price_direct', 6)} AS reported_price FROM d),
t_monthly AS (SELECT *, CAST(year(period_date) AS INTEGER) AS year, CAST(month(period_date) AS INTEGER) AS month FROM w_monthly WHERE period_date <= {CUTOFF}),
{_matrix('matrix_value', 'value')},
{_matrix('matrix_qty', 'qty')},
hg AS (SELECT cut, year, qty, value, CASE WHEN pq <> 0 THEN (qty - pq) / pq END AS gq, CASE WHEN pv <> 0 THEN (value - pv) / pv END AS gv
  FROM (SELECT *, lag(qty) OVER w AS pq, lag(value) OVER w AS pv FROM cells WHERE starts_with(label, 'TOTAL') WINDOW w AS (PARTITION BY cut ORDER BY year))),
{_history('history_month', 'MAYO', 'CAST(year AS INTEGER) AS year')},
{_history('history_cumulative', 'ACUM_ENE_MAY', "'Ene - May ' || CAST(year AS VARCHAR) AS period")},
mk AS (SELECT cut, label, max(CASE WHEN year = 2000 THEN value END) AS va, max(CASE WHEN year = 2000 THEN qty END) AS qa,
         max(CASE WHEN year = 2001 THEN value END) AS vb, max(CASE WHEN year = 2001 THEN qty END) AS qb
       FROM cells WHERE year IN (2000, 2001) GROUP BY 1, 2),
{_market('market_month', 'MAYO', '05')},
{_market('market_cumulative', 'ACUM_ENE_MAY', 'ene_may')}"""


def _wide(name: str, label: str, date: str, columns: list[str], cte: str) -> str:
    """A wide table in the long form of the query, without nulls."""
    pairs = ", ".join(f"'{c}'" for c in columns)
    return (f"SELECT '{name}' AS \"table\", {date} AS period_date, {label} AS label, unnest([{pairs}]) AS indicator, unnest([{', '.join(columns)}]) AS value FROM {cte}")


_H = ["qty", "value", "growth_qty", "growth_value"]
SQL: dict[str, str] = {}
SQL["k17_refined_a"] = f"""WITH {BODY}
SELECT * FROM (
{_wide('monthly', 'NULL', 'period_date', ['qty', 'value', 'reported_price'], 't_monthly')}
UNION ALL SELECT 'matrix_value', period_date, NULL, 'value', value FROM t_matrix_value
UNION ALL SELECT 'matrix_qty', period_date, NULL, 'value', value FROM t_matrix_qty
UNION ALL {_wide('history_month', 'CAST(year AS VARCHAR)', 'NULL', _H, 'w_history_month')}
UNION ALL {_wide('history_cumulative', 'period', 'NULL', _H, 'w_history_cumulative')}
UNION ALL SELECT 'market_month', NULL, label, indicator, value FROM t_market_month
UNION ALL SELECT 'market_cumulative', NULL, label, indicator, value FROM t_market_cumulative) x
WHERE value IS NOT NULL"""


def _off(now: str, before: str, rate: str) -> tuple[str, str]:
    g = f"(({now} - {before}) / {before})"
    return (f"abs({rate} - {g}) > greatest(0.0002, abs({g}) * 0.01) AND abs({rate} - {g} * 100.0) > greatest(0.02, abs({g} * 100.0) * 0.01)",
            f"{now} IS NOT NULL AND {before} IS NOT NULL AND {before} <> 0 AND {rate} IS NOT NULL")


def _series_rules(name: str, measures: list[str], extra: list) -> list[str]:
    own = [(f"A1_{m}_non_negative", "CRITICAL", f"{m} < 0", f"{m} IS NOT NULL", "") for m in measures]
    wrong = f"year IS NULL OR month IS NULL OR month NOT BETWEEN 1 AND 12 OR period_date > {CUTOFF}"
    return [rows(f"t_{name}", name, [*own, *extra, ("A6_period_valid", "CRITICAL", wrong, "true", "")]),
            unique(f"t_{name}", name, "A6_period_key_unique", ["year", "month"])]


def _market_rules(name: str, unit: str) -> list[str]:
    off = {m: _off(f"{m}_2001_{unit}", f"{m}_2000_{unit}", f"growth_{m}") for m in ("value", "qty")}
    top = f"(SELECT max(share_qty) FROM w_{name})"
    none = f"(SELECT count(share_qty) FROM w_{name}) = 0"
    share = (f"SELECT 'A5_share_in_range' AS rule, '{name}' AS \"table\", CASE WHEN {none} THEN 'WARNING' ELSE 'CRITICAL' END AS severity, "
             f"count(share_qty) AS checked, count_if(share_qty < 0 OR share_qty > CASE WHEN {top} <= 1.000001 THEN 1.000001 ELSE 100.0001 END) AS violations, "
             f"CASE WHEN {none} THEN 'no share to check' WHEN {top} <= 1.000001 THEN 'scale [0, 1]' ELSE 'scale [0, 100]' END AS detail FROM w_{name}")
    return [rows(f"w_{name}", name, [(f"A4b_market_growth_{m}", "CRITICAL", *off[m], "") for m in ("value", "qty")]), share,
            unique(f"t_{name}", name, "A6_market_key_unique", ["label", "indicator"])]


_TOTAL = " + ".join(f"coalesce({m}, 0.0)" for m in MC)
_PRICE = ("A3_reported_price", "CRITICAL", "abs(reported_price - value / qty) > greatest(0.02, abs(reported_price) * 0.01)",
          "qty > 0 AND value IS NOT NULL AND reported_price IS NOT NULL", "")
SQL["k17_rules"] = f"""WITH {BODY},
hl AS (SELECT *, lag(qty) OVER (ORDER BY year) AS before_qty, lag(value) OVER (ORDER BY year) AS before_value FROM w_history_month)
""" + finish("\nUNION ALL ".join([
    *_series_rules("monthly", ["qty", "value", "reported_price"], [_PRICE]),
    *_series_rules("matrix_value", ["value"], []), *_series_rules("matrix_qty", ["value"], []),
    *[rows(f"w_{n}", n, [("A2_total_equals_months", "CRITICAL", f"abs(total - ({_TOTAL})) > greatest(1.0, abs(total) * 1e-06)", "total IS NOT NULL", "")])
      for n in ("matrix_value", "matrix_qty")],
    rows("hl", "history_month", [(f"A4_stored_growth_{m}", "CRITICAL", *_off(m, f"before_{m}", f"growth_{m}"), "") for m in ("qty", "value")]),
    *_market_rules("market_month", "05"), *_market_rules("market_cumulative", "ene_may"),
]))

_COLUMNS = {
    "monthly": ["period_date", "qty", "value", "reported_price"], "matrix_value": ["year", *MC, "total"], "history_month": ["year", *_H],
    "history_cumulative": ["period", *_H], "matrix_qty": ["year", *MC, "total"],
    **{n: ["label", f"value_2000_{u}", f"qty_2000_{u}", f"value_2001_{u}", f"qty_2001_{u}", "growth_value", "growth_qty", "share_qty"]
       for n, u in (("market_month", "05"), ("market_cumulative", "ene_may"))},
}
_DECLARED = {"monthly": 200, "market_month": 100, "market_cumulative": 100}


def _audit(name: str) -> list[str]:
    """Counts of a table at every step; the markets' total row stands twice."""
    def row(metric: str, n: str, column: str = "NULL") -> str:
        return f"SELECT '{name}' AS \"table\", {column} AS \"column\", '{metric}' AS metric, CAST(({n}) AS BIGINT) AS n"

    twice = 1 if name.startswith("market") else 0
    declared, own = _DECLARED.get(name, 40), f"SELECT count(*) FROM w_{name}"
    final = "t" if name.startswith(("monthly", "matrix", "market")) else "w"
    out = [row("rows_initial", str(declared)), row("rows_empty", f"{declared} - {twice} - ({own})"), row("rows_repeated", str(twice)), row("rows_refined", own)]
    for c in _COLUMNS[name]:
        again = f" + (SELECT count({c}) FROM w_{name} WHERE starts_with(label, 'TOTAL'))" if twice else ""
        out += [row("non_null_source", f"SELECT count({c}){again} FROM w_{name}", f"'{c}'"), row("failures", "0", f"'{c}'")]
    kept = ["period_date", "year", "month", "value"] if name.startswith("matrix") else ["label", "indicator", "value"] if twice else [
        *_COLUMNS[name], *(["year", "month"] if name == "monthly" else [])]
    nulls = " + ".join(f"count_if({c} IS NULL)" for c in kept)
    out += [row("rows", f"SELECT count(*) FROM {final}_{name}"), row("null_cells", f"SELECT {nulls} FROM {final}_{name}")]
    if name.startswith("matrix"):
        before = f"FROM b_{name} WHERE period_date <= {CUTOFF}"
        out += [row("rows_before_null_filter", f"SELECT count(*) {before}"), row("null_observations", f"SELECT count_if(value IS NULL) {before}")]
    return out


SQL["k17_audit"] = f"WITH {BODY}\n" + "\nUNION ALL ".join(x for name in _COLUMNS for x in _audit(name))

_FINAL = {n: ("t_" if n.startswith(("monthly", "matrix", "market")) else "w_") + n for n in _COLUMNS}
_KEPT = {n: ["period_date", "year", "month", "value"] if n.startswith("matrix") else ["label", "indicator", "value"] if n.startswith("market")
         else ["period_date", "year", "month", "qty", "value", "reported_price"] if n == "monthly" else _COLUMNS[n] for n in _COLUMNS}
_DATED = ["monthly", "matrix_value", "matrix_qty"]
SQL["d_qa_published"] = f"WITH {BODY}\n" + "\nUNION ALL ".join(
    f"""SELECT '{n}' AS "table", 'readable' AS test, 'PASS' AS status, '' AS detail
UNION ALL SELECT '{n}', 'rows', 'PASS', CAST(count(*) AS VARCHAR) FROM {_FINAL[n]}
UNION ALL SELECT '{n}', 'columns', 'PASS', '{','.join(_KEPT[n])}'
UNION ALL SELECT '{n}', 'exact_duplicates', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(count(*) AS VARCHAR) FROM (SELECT 1 FROM {_FINAL[n]} GROUP BY {', '.join(_KEPT[n])} HAVING count(*) > 1)
UNION ALL SELECT '{n}', 'lineage', 'PASS', 'lineage.input_sha256,lineage.report_period,pipeline.run_id'""" for n in _COLUMNS)
_CHECKS = [("expected", k) for k in ("pipeline.layer", "pipeline.version", "source.value_unit", "canonical.value_unit")] + [
    ("single", k) for k in ("pipeline.run_id", "lineage.input_sha256", "lineage.report_period")]
_LATE = " UNION ALL ".join(f"SELECT max(period_date) AS last FROM {_FINAL[n]}" for n in _DATED)
SQL["d_c_layer_contract"] = f"WITH {BODY}\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"check\", '{k}' AS \"key\", CAST(7 AS BIGINT) AS tables, CAST(0 AS BIGINT) AS violations, 'PASS' AS status" for c, k in _CHECKS) + f"""
UNION ALL SELECT 'bounds', 'lineage.report_period', count(*), count_if(strftime(last, '%Y-%m') > '2000-10'),
  CASE WHEN count_if(strftime(last, '%Y-%m') > '2000-10') = 0 THEN 'PASS' ELSE 'FAIL' END FROM ({_LATE})"""

_GATE = ["exists", "columns", *[f"property:{k}" for c, k in _CHECKS if c == "expected"], "non_blank:pipeline.run_id", "non_blank:lineage.input_sha256"]
SQL["s18_open_refined"] = f"WITH {BODY}\n" + "\nUNION ALL ".join(
    [f"SELECT '{n}' AS \"table\", '{c}' AS \"check\", true AS ok, 'PASS' AS status" for n in _COLUMNS for c in _GATE]
    + [f"SELECT '{n}', 'not_empty', count(*) > 0, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END FROM {_FINAL[n]}" for n in _COLUMNS])
