"""DuckDB oracle SQL for the workbook queries."""

from __future__ import annotations

from .oracle import OM
from .oracle_scalars import WS, identifier_sql, parse_number_sql

_MONTHS = ["ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO", "JULIO", "AGOSTO", "SEPTIEMBRE",
           "OCTUBRE", "NOVIEMBRE", "DICIEMBRE"]
_MC = [f"m{i:02d}" for i in range(1, 13)]
NAMES = ["year"] + _MC + ["total"]


def _norm(c: str) -> str:
    return f"upper(trim(regexp_replace(strip_accents({c}), '{WS}', ' ', 'g')))"


def _layout(sheet: str) -> str:
    rows = [(1, 1, f"EXPORTACIONES MENSUALES - {sheet}"), (2, 1, "Fuente: registro de pedidos"),
            (2, 2, "2001-02-03 04:05:06"), (3, 1, "Período:"), (4, 1, "AÑO")] + [(4, i + 2, m) for i, m in enumerate(_MONTHS)] + [(4, 14, "TOTAL")]
    return ", ".join(f"('exportaciones.xlsx', '{sheet}', {r}, {c}, '{v}')" for r, c, v in rows)


def _sheet(sheet: str, measure: str) -> str:
    return f"""SELECT 'exportaciones.xlsx' AS file, '{sheet}' AS sheet, CAST(year(period_date) - 1990 AS INTEGER) AS row,
         CAST(month(period_date) + 1 AS INTEGER) AS col, CAST(CAST({measure} AS DECIMAL(20,2)) AS VARCHAR) AS value FROM om
  UNION ALL SELECT DISTINCT 'exportaciones.xlsx', '{sheet}', CAST(year(period_date) - 1990 AS INTEGER), 1,
         CAST(year(period_date) AS VARCHAR) || '.0' FROM om
  UNION ALL SELECT 'exportaciones.xlsx', '{sheet}', CAST(year(period_date) - 1990 AS INTEGER), 14,
         CAST(SUM(CAST({measure} AS DECIMAL(20,2))) AS VARCHAR) FROM om GROUP BY year(period_date)
  UNION ALL SELECT * FROM (VALUES {_layout(sheet)})
  UNION ALL SELECT 'exportaciones.xlsx', '{sheet}', 3, 2, strftime(max(period_date), '%Y-%m') FROM om"""


CELLS = f"""{OM},
cells AS (
  {_sheet('VALOR', 'value')}
  UNION ALL {_sheet('CANTIDAD', 'qty')}
  UNION ALL SELECT 'exportaciones.xlsx', 'NOTAS', 1, 1, 'Notas metodológicas')"""

_PIV = ", ".join(f"max(CASE WHEN col = {i} THEN value END) AS {n}" for i, n in enumerate(NAMES, 1))
RAW = f"""{CELLS},
sheets AS (SELECT * FROM (VALUES ('VALOR', 'matrix_value'), ('CANTIDAD', 'matrix_qty')) t(sheet, name)),
rw AS (SELECT name, row, {_PIV} FROM cells JOIN sheets USING (sheet) WHERE row BETWEEN 5 AND 12 AND col BETWEEN 1 AND 14 GROUP BY 1, 2),
raw AS (SELECT s.name, CAST(r.row AS INTEGER) AS _source_row, {', '.join('rw.' + n for n in NAMES)}
        FROM sheets s CROSS JOIN range(5, 13) r(row) LEFT JOIN rw ON rw.row = r.row AND rw.name = s.name)"""

_TYPED_COLS = ", ".join([f"TRY_CAST(trunc({parse_number_sql('year')}) AS INTEGER) AS year"]
                        + [f"{parse_number_sql(n)} AS {n}" for n in _MC + ['total']])
TYPED = f"""{RAW},
ty0 AS (SELECT name, {_TYPED_COLS} FROM raw),
ty AS (SELECT * FROM ty0 WHERE NOT ({' AND '.join(f'{n} IS NULL' for n in NAMES)}))"""

SQL: dict[str, str] = {}

SQL["s7_read_range"] = f"WITH {RAW} SELECT (SELECT max(file) FROM cells WHERE sheet = 'VALOR') AS file, * FROM raw"
SQL["f7_typed_projection"] = f"WITH {TYPED} SELECT * FROM ty"
SQL["f7_conversion_audit"] = f"""WITH {TYPED},
tya AS (SELECT {_TYPED_COLS}, {', '.join(f'{n} AS s_{n}' for n in NAMES)} FROM raw)
""" + "\nUNION ALL ".join(
    f"SELECT '{n}' AS column, '{'int' if n == 'year' else 'double'}' AS type, "
    f"CAST(count_if(s_{n} IS NOT NULL) AS BIGINT) AS non_null_source, "
    f"CAST(count_if(s_{n} IS NOT NULL AND {n} IS NULL) AS BIGINT) AS failures FROM tya"
    for n in NAMES)
SQL["p1_unpivot_months"] = f"""WITH {TYPED},
u AS (SELECT name, year, CAST(unnest(range(1, 13)) AS INTEGER) AS month,
             unnest([{', '.join(_MC)}]) AS value FROM ty)
SELECT name, make_date(year, month, 1) AS period_date, year, month, value FROM u
WHERE make_date(year, month, 1) <= DATE '2000-10-01' AND value IS NOT NULL"""

_CONTRACTS = """ct AS (SELECT * FROM (VALUES
  (1, 'matrix_value', 'VALOR', 4, 1, 4, 14, 5, 1, 12, 14, 14, ['ANO', 'ENERO', 'TOTAL']),
  (2, 'matrix_qty', 'CANTIDAD', 4, 1, 4, 14, 5, 1, 12, 14, 14, ['ANO', 'ENERO', 'TOTAL']),
  (3, 'prices', 'PRECIOS', 4, 1, 4, 3, 5, 1, 12, 3, 3, ['PRECIO']),
  (4, 'matrix_value_narrow', 'VALOR', 4, 1, 4, 14, 5, 1, 12, 14, 13, ['ANO', 'JULIO']))
  t(id_table, name, sheet, hdr_r1, hdr_c1, hdr_r2, hdr_c2, r1, c1, r2, c2, n_names, required_tokens))"""

SQL["s8_check_ranges"] = f"""WITH {CELLS}, {_CONTRACTS},
hd AS (SELECT ct.id_table, {_norm("string_agg(value, ' ' ORDER BY row, col)")} AS header_text
       FROM ct JOIN cells c ON c.sheet = ct.sheet AND c.row BETWEEN ct.hdr_r1 AND ct.hdr_r2
        AND c.col BETWEEN ct.hdr_c1 AND ct.hdr_c2 GROUP BY ct.id_table),
dt AS (SELECT ct.id_table, count_if(trim(value) <> '') AS nb
       FROM ct JOIN cells c ON c.sheet = ct.sheet AND c.row BETWEEN ct.r1 AND ct.r2
        AND c.col BETWEEN ct.c1 AND ct.c2 GROUP BY ct.id_table),
j AS (SELECT ct.*, wb.file, wb.file IS NOT NULL AS sheet_exists, (c2 - c1 + 1) = n_names AS width_ok,
             hd.header_text, COALESCE(dt.nb, 0) AS nonblank_cells
      FROM ct LEFT JOIN (SELECT DISTINCT file, sheet FROM cells) wb ON wb.sheet = ct.sheet
      LEFT JOIN hd ON hd.id_table = ct.id_table LEFT JOIN dt ON dt.id_table = ct.id_table),
k AS (SELECT *, list_bool_and(list_transform(required_tokens, lambda t: COALESCE(instr(header_text, t) > 0, false)))
                  AS tokens_ok FROM j)
SELECT file, id_table, name, sheet, sheet_exists, width_ok, tokens_ok, CAST(nonblank_cells AS BIGINT) AS nonblank_cells,
       CASE WHEN sheet_exists AND width_ok AND tokens_ok AND nonblank_cells > 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM k"""

_ALIASES = ", ".join(
    [f"('year', '{a}')" for a in ("AÑO", "ANO", "ANIO", "YEAR")]
    + [f"('{c}', '{m}')" for c, m in zip(_MC, _MONTHS)] + ["('total', 'TOTAL')", "('total', 'TOTAL ANUAL')"])

HEADERS = f"""{CELLS},
al AS (SELECT DISTINCT canonical, {_norm('alias')} AS a FROM (VALUES {_ALIASES}) t(canonical, alias)),
mt AS (SELECT c.file, c.sheet, c.row, c.col, al.canonical FROM cells c JOIN al ON {_norm('c.value')} = al.a
       WHERE c.row <= 40),
pr AS (SELECT file, sheet, row FROM mt GROUP BY file, sheet, row
       HAVING COUNT(DISTINCT canonical) = (SELECT COUNT(DISTINCT canonical) FROM al)),
fd AS (SELECT file, sheet, COUNT(*) AS matches, min(row) AS header_row FROM pr GROUP BY file, sheet),
hm AS (SELECT mt.file, mt.sheet, string_agg(canonical || ':' || CAST(c AS VARCHAR), ',' ORDER BY canonical) AS header_map
       FROM (SELECT mt.file, mt.sheet, canonical, min(col) AS c FROM mt JOIN fd ON fd.file = mt.file
               AND fd.sheet = mt.sheet AND fd.header_row = mt.row GROUP BY ALL) mt GROUP BY ALL),
sh AS (SELECT DISTINCT file, sheet FROM cells),
hdr AS (SELECT sh.file, sh.sheet,
               CASE WHEN fd.matches IS NULL THEN 'NOT_FOUND' WHEN fd.matches > 1 THEN 'AMBIGUOUS' ELSE 'FOUND' END
                 AS status, COALESCE(fd.matches, 0) AS matches,
               CASE WHEN fd.matches = 1 THEN fd.header_row END AS header_row,
               CASE WHEN fd.matches = 1 THEN hm.header_map END AS header_map
        FROM sh LEFT JOIN fd ON fd.file = sh.file AND fd.sheet = sh.sheet
        LEFT JOIN hm ON hm.file = sh.file AND hm.sheet = sh.sheet),
hcols AS (SELECT mt.file, mt.sheet, canonical, min(col) AS col FROM mt JOIN hdr ON hdr.file = mt.file
          AND hdr.sheet = mt.sheet AND hdr.header_row = mt.row WHERE hdr.status = 'FOUND' GROUP BY ALL),
lst AS (SELECT c.file, c.sheet, max(c.row) AS last_row FROM cells c JOIN hdr h ON h.file = c.file
        AND h.sheet = c.sheet AND h.status = 'FOUND'
        WHERE c.row > h.header_row AND trim(c.value) <> ''
          AND c.col IN (SELECT col FROM hcols WHERE hcols.file = c.file AND hcols.sheet = c.sheet)
        GROUP BY ALL),
pl AS (SELECT c.file, c.sheet, c.row, string_agg(trim(regexp_replace(c.value, '\\s+', ' ', 'g')), ' | ' ORDER BY c.col) AS line,
         arg_min(CASE WHEN regexp_matches(c.value, '^\\d{{4}}-\\d{{2}}-\\d{{2}}[ T]\\d{{2}}:\\d{{2}}') THEN c.value END, c.col) AS moment FROM cells c
       JOIN hdr h ON h.file = c.file AND h.sheet = c.sheet AND h.status = 'FOUND'
       WHERE c.row < h.header_row GROUP BY ALL),
pf AS (SELECT *, {_norm('line')} AS folded FROM pl),
pls AS (SELECT file, sheet, coalesce(arg_min(line, row) FILTER (contains(folded, 'EXPORTACIONES')), '') AS title,
               coalesce(arg_min(line, row) FILTER (contains(folded, 'PERIODO:')), '') AS scope,
               arg_min(moment, row) FILTER (moment IS NOT NULL) AS generated_at, COUNT(*) AS preamble_lines,
               concat_ws(',', CASE WHEN NOT bool_or(contains(folded, 'EXPORTACIONES')) THEN 'Exportaciones' END,
                 CASE WHEN NOT bool_or(contains(folded, 'REGISTRO')) THEN 'registro' END,
                 CASE WHEN NOT bool_or(contains(folded, 'ADUANA')) THEN 'Aduana' END) AS missing_tokens
        FROM pf GROUP BY ALL),
ext AS (SELECT h.file, h.sheet, h.header_row, h.header_map, l.last_row, p.title, p.scope, p.generated_at, p.preamble_lines, p.missing_tokens
        FROM hdr h LEFT JOIN lst l ON l.file = h.file AND l.sheet = h.sheet
        LEFT JOIN pls p ON p.file = h.file AND p.sheet = h.sheet WHERE h.status = 'FOUND')"""

SQL["s9_locate_header"] = f"WITH {HEADERS} SELECT * FROM hdr"
SQL["s10_sheet_extent"] = f"""WITH {HEADERS}
SELECT file, sheet, header_row, last_row, title, scope, generated_at, preamble_lines, missing_tokens FROM ext"""
SQL["s11_structure_hash"] = f"""WITH {HEADERS}
SELECT file, sheet, sha256(concat_ws('|', sheet, CAST(header_row AS VARCHAR), CAST(last_row AS VARCHAR), header_map,
                                     COALESCE(title, ''), COALESCE(scope, ''))) AS structure_sha256 FROM ext"""

_REC_PIV = ", ".join(f"max(CASE WHEN canonical = '{n}' THEN value END) AS {n}" for n in NAMES)
_READ = ", ".join([f"{identifier_sql('year', 4)} AS year"] + [f"trim({n}) AS {n}" for n in _MC + ['total']])
SQL["s12_extract_records"] = f"""WITH {HEADERS},
rc AS (SELECT c.file, c.sheet, c.row AS _source_row, hc.canonical, c.value FROM cells c
       JOIN ext e ON e.file = c.file AND e.sheet = c.sheet
       JOIN hcols hc ON hc.file = c.file AND hc.sheet = c.sheet AND hc.col = c.col
       WHERE c.row > e.header_row AND c.row <= e.last_row),
pv AS (SELECT file, sheet, _source_row, {_REC_PIV} FROM rc GROUP BY ALL),
rd AS (SELECT file, sheet, _source_row, {_READ} FROM pv),
bl AS (SELECT file, sheet, _source_row, {', '.join(f"CASE WHEN trim({n}) = '' THEN NULL ELSE {n} END AS {n}" for n in NAMES)}
       FROM rd)
SELECT * FROM bl WHERE NOT ({' AND '.join(f'{n} IS NULL' for n in NAMES)})"""
