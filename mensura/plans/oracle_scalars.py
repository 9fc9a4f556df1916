"""DuckDB oracle SQL for the scalar-function queries."""

from __future__ import annotations

from .oracle import SUBCODE

WS = r"[ \t\n\x0B\f\r]+"  # Java's \s class
INVISIBLE = r"[\x{200B}\x{200C}\x{200D}\x{FEFF}\x{00A0}]"


def clean_sql(col: str, tokens=("", "NULL", "NONE", "NAN", "N/A", "NA")) -> str:
    t = f"trim(regexp_replace(regexp_replace({col}, '{INVISIBLE}', '', 'g'), '{WS}', ' ', 'g'))"
    toks = ", ".join(f"'{x}'" for x in tokens)
    return f"CASE WHEN upper({t}) IN ({toks}) THEN NULL ELSE {t} END"


def parse_number_sql(col: str) -> str:
    s = f"regexp_replace(trim({col}), '[%$]', '', 'g')"
    return (f"TRY_CAST(CASE WHEN regexp_matches({s}, '^-?\\d{{1,3}}(,\\d{{3}})+(\\.\\d+)?$') "
            f"THEN replace({s}, ',', '') ELSE replace({s}, ',', '.') END AS DOUBLE)")


def identifier_sql(col: str, width: int) -> str:
    s = f"trim({col})"
    s2 = (f"CASE WHEN regexp_matches({s}, '^[0-9]+\\.0+$') THEN "
          f"regexp_replace(regexp_replace({s}, '\\.0+$', ''), '^0+([0-9])', '\\1') ELSE {s} END")
    return (f"CASE WHEN regexp_matches({s2}, '^[0-9]+$') AND length({s2}) < {width} "
            f"THEN lpad({s2}, {width}, '0') ELSE {s2} END")


SQL: dict[str, str] = {}

SQL["o1_clean_text"] = f"""WITH c AS (SELECT doc_id, {clean_sql('text')} AS c FROM documents)
SELECT doc_id, CAST(length(c) AS INTEGER) AS clean_len, sha256(c) AS clean_sha, c IS NULL AS is_null FROM c"""

SQL["o2_normalize_match"] = f"""WITH f AS (
  SELECT doc_id, trim(regexp_replace(strip_accents(text), '{WS}', ' ', 'g')) AS f FROM documents)
SELECT doc_id, CAST(length(f) AS INTEGER) AS folded_len, sha256(f) AS folded_sha FROM f"""

_C3 = f"translate(upper({clean_sql('p_name', ('', 'NULL', 'NONE', 'NAN', 'N/A', 'NA', '-'))}), 'ÁÉÍÓÚÜÑ', 'AEIOUUN')"
SQL["o3_canonical_label"] = f"""WITH c AS (SELECT p_partkey, {_C3} AS s FROM part)
SELECT p_partkey, CASE s WHEN 'EEUU' THEN 'ESTADOS UNIDOS' WHEN 'USA' THEN 'ESTADOS UNIDOS'
                         WHEN 'US' THEN 'ESTADOS UNIDOS' ELSE s END AS label FROM c"""

SQL["o4_number_tokens"] = f"""WITH t AS (
  SELECT doc_id, regexp_extract_all(text, '[-$]?[0-9][0-9.,%]*') AS toks FROM documents),
u AS (SELECT doc_id, CAST(unnest(range(len(toks))) AS INTEGER) AS pos, unnest(toks) AS token FROM t),
n AS (SELECT *, {parse_number_sql('token')} AS number FROM u)
SELECT doc_id, pos, token, number, TRY_CAST(trunc(number) AS INTEGER) AS integer,
       {identifier_sql('token', 10)} AS code FROM n"""

SQL["o6_parse_date"] = """WITH r AS (
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                                     WHEN 1 THEN strftime(ts, '%Y-%m-%d')
                                     WHEN 2 THEN strftime(ts, '%d/%m/%Y') ELSE props END AS raw
  FROM events)
SELECT event_id, raw, COALESCE(CAST(try_strptime(raw, '%Y-%m-%d %H:%M:%S') AS DATE),
                               CAST(try_strptime(raw, '%Y-%m-%d') AS DATE),
                               CAST(try_strptime(raw, '%d/%m/%Y') AS DATE)) AS parsed FROM r"""

_P = r"'^(\d{4})\s*/\s*(\d{2})\s*-\s*(.+)$'"
SQL["o11_parse_period"] = f"""WITH {SUBCODE},
p AS (SELECT DISTINCT period_text FROM sf),
q AS (SELECT period_text,
             TRY_CAST(NULLIF(regexp_extract(period_text, {_P}, 1), '') AS INTEGER) AS year,
             TRY_CAST(NULLIF(regexp_extract(period_text, {_P}, 2), '') AS INTEGER) AS month FROM p)
SELECT period_text, year, month, CASE WHEN month BETWEEN 1 AND 12 THEN make_date(year, month, 1) END
  AS period_date FROM q"""

_FN = ("regexp_replace(regexp_replace(regexp_replace(regexp_extract(url_decode(replace(regexp_replace(url, "
       "'[?#].*$', ''), '+', '%2B')), '([^/]*)$', 1), '[<>:\"/\\\\|?*\\x00-\\x1f]', '_', 'g'), '" + WS + "', ' ', 'g'), "
       "'^[ .]+|[ .]+$', '', 'g')")
SQL["o25_safe_filename"] = f"""WITH f AS (SELECT page_id, url, {_FN} AS fn FROM pages)
SELECT page_id, substr(sha256(url), 1, 12) AS resource_id,
       CASE WHEN fn IS NULL OR fn = '' THEN 'archivo_descargado' ELSE fn END AS file_name FROM f"""
