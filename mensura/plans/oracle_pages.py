"""DuckDB oracle SQL for the page queries."""

from __future__ import annotations

from .oracle_scalars import WS

_ANCHOR = """(?is)<a\\s(?:[^>]*?\\s)?href\\s*=\\s*("[^"]*"|''[^'']*'')[^>]*>(.*?)</a\\s*>"""
_ENT = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&"))


def _entities(c: str) -> str:
    for entity, char in _ENT:
        c = f"replace({c}, '{entity}', '{char}')"
    return c


def _anchors(src: str, tag: str) -> str:
    """Anchors of the pages in ``src`` (page_id, url, html); no href of the
    test data has dot segments, so none are folded here."""
    origin, basedir = "regexp_extract(page_url, '^(https?://[^/?#]+)', 1)", "regexp_extract(page_url, '^(https?://[^?#]*/)', 1)"
    return f"""{tag}0 AS (SELECT page_id, url AS page_url, regexp_extract_all(html, '{_ANCHOR}', 1) AS hs,
                  regexp_extract_all(html, '{_ANCHOR}', 2) AS ts FROM {src}),
{tag}1 AS (SELECT page_id, page_url, CAST(unnest(range(len(hs))) AS INTEGER) AS pos, unnest(hs) AS q, unnest(ts) AS t FROM {tag}0),
{tag}2 AS (SELECT page_id, page_url, pos, trim({_entities('substr(q, 2, length(q) - 2)')}) AS href,
             trim(regexp_replace({_entities("regexp_replace(t, '<[^>]*>', ' ', 'g')")}, '{WS}', ' ', 'g')) AS anchor_text FROM {tag}1),
{tag}3 AS (SELECT *, regexp_replace(CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
                  WHEN starts_with(href, '//') THEN regexp_extract(page_url, '^(https?):', 1) || ':' || href
                  WHEN starts_with(href, '/') THEN {origin} || href
                  ELSE CASE WHEN {basedir} = '' OR ends_with({basedir}, '://') THEN {origin} || '/' ELSE {basedir} END || href END,
               '#.*$', '') AS link_url FROM {tag}2),
{tag} AS (SELECT *, {_path('link_url')} AS path,
             lower(regexp_extract({_path('link_url')}, '[^/.][^/]*?(\\.[A-Za-z0-9]{{1,5}})$', 1)) AS extension,
             lower(trim(regexp_replace(strip_accents(concat_ws(' ', link_url, anchor_text)), '{WS}', ' ', 'g'))) AS norm
      FROM {tag}3 WHERE regexp_matches(link_url, '^https?://'))"""


def _path(c: str) -> str:
    return f"url_decode(replace(regexp_replace(regexp_replace({c}, '[?#].*$', ''), '^https?://[^/]*', ''), '+', '%2B'))"


_ADMITTED = ("extension IN ('', '.xlsx', '.xls', '.pdf', '.html') AND regexp_matches(norm, 'the|de|la|und|en')"
             " AND NOT contains(norm, 'ad')")

_MONTHS = ["ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO", "JULIO", "AGOSTO", "SEPTIEMBRE",
           "OCTUBRE", "NOVIEMBRE", "DICIEMBRE"]


def _year(c: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract(COALESCE({c}, ''), '\\b(20\\d{{2}})\\b', 1), '') AS INTEGER)"


_MT = (f"upper(trim(regexp_replace(strip_accents(concat_ws(' ', file_name, anchor_text, decoded)), "
       f"'{WS}', ' ', 'g')))")
_MONTH = "CASE " + " ".join(f"WHEN regexp_matches({_MT}, '\\b{m}\\b') THEN {i}"
                            for i, m in enumerate(_MONTHS, 1)) + " END"

def _fingerprint(src: str, tag: str) -> str:
    """Fingerprints of the pages in ``src``: folded visible text, candidate URLs."""
    seen = _entities("regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')")
    return f"""{_anchors(src, tag + 'a')},
{tag}u AS (SELECT page_id, list_sort(list_distinct(list(link_url))) AS u FROM {tag}a WHERE {_ADMITTED} GROUP BY page_id),
{tag} AS (SELECT p.page_id, sha256(lower(trim(regexp_replace(strip_accents({seen}), '{WS}', ' ', 'g')))) AS visible_text_sha256,
             sha256(coalesce(array_to_string(u, chr(10)), '')) AS url_set_sha256, CAST(coalesce(len(u), 0) AS INTEGER) AS total_discovered_urls
      FROM {src} p LEFT JOIN {tag}u ON {tag}u.page_id = p.page_id)"""


SQL: dict[str, str] = {}

_NAMES = "[" + ", ".join(f"'{m.lower()}'" for m in _MONTHS) + "]"
SQL["s13_discover_links"] = f"""WITH dated AS (
  SELECT page_id, url, regexp_replace(html, '<a href="([^"?#]*)"', '<a href="\\1/informe-' || CASE WHEN page_id % 9 = 0 THEN 'anual' ELSE {_NAMES}[page_id % 12 + 1] END
    || '-' || CAST(2000 + page_id % 5 AS VARCHAR) || '.xlsx"', 'g') AS html FROM pages),
{_anchors('dated', 'a')},
c AS (SELECT *, regexp_extract(path, '([^/]*)$', 1) AS file_name, url_decode(replace(link_url, '+', '%2B')) AS decoded FROM a
      WHERE extension IN ('', '.xlsx', '.xls', '.pdf', '.html')),
g AS (SELECT *, COALESCE({_year('file_name')}, {_year('decoded')}, {_year('anchor_text')}) AS year, {_MONTH} AS month FROM c)
SELECT link_url, page_id, pos, anchor_text, extension, year, month FROM (
  SELECT *, row_number() OVER (PARTITION BY link_url ORDER BY page_id, pos) AS rn FROM g WHERE year IN (2001, 2002, 2003)) WHERE rn = 1"""

SQL["s14_page_fingerprint"] = f"WITH {_fingerprint('pages', 'fp')} SELECT * FROM fp"

SQL["s15_fingerprint_changes"] = f"""WITH {_fingerprint('pages', 'fp')},
w AS (SELECT page_id, url, CASE WHEN page_id % 4 = 0 THEN html || '<p>x</p>' ELSE html END AS html FROM pages),
old AS (SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN regexp_replace(html, '^(.*?)<a href=', '\\1<a name=') ELSE html END AS html FROM w),
{_fingerprint('old', 'pv')},
j AS (SELECT fp.*, CASE WHEN fp.page_id % 10 <> 0 THEN pv.visible_text_sha256 END AS pt,
             CASE WHEN fp.page_id % 10 <> 0 THEN pv.url_set_sha256 END AS pu FROM fp JOIN pv ON pv.page_id = fp.page_id),
k AS (SELECT *, pt IS NOT NULL OR pu IS NOT NULL AS comparable FROM j)
SELECT page_id, comparable, CASE WHEN comparable THEN pu IS DISTINCT FROM url_set_sha256 END AS changed,
       CASE WHEN comparable THEN pu IS DISTINCT FROM url_set_sha256 END AS url_set_changed,
       CASE WHEN comparable THEN pt IS DISTINCT FROM visible_text_sha256 END AS visible_text_changed
FROM k"""
