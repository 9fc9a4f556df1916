"""Link discovery and page fingerprints over raw HTML.

Anchors are pulled from the whole HTML of every page with
``regexp_extract_all`` (JVM-side), resolved to absolute URLs, filtered by
extension / keywords / year and de-duplicated to the first occurrence per
URL with ``min_by`` (partially aggregated, so a URL linked from a third of
all pages is combined map-side).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import infer_month, infer_year
from ..functions.text import normalize_match

# An anchor with a quoted href (either quote, any case, over line breaks); the
# groups are the quoted href and what stands between the tags.
ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*')[^>]*>(.*?)</a\s*>"""
# HTML entities decoded in visible text (fixed values; "&amp;" last).
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


@dataclass(frozen=True)
class LinkConfig:
    extensions: tuple = ("", ".xlsx", ".xls", ".pdf", ".html")
    include: tuple = ()
    exclude: tuple = ()
    years: tuple | None = None


def decode_entities(c: Column) -> Column:
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def fold_dots(url: Column) -> Column:
    """Path segments ``.`` and ``..`` of an absolute URL resolved."""
    head = F.regexp_extract(url, r"^(https?://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"^https?://[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(url, r"^[^?#]*(.*)$", 1)
    nothing = F.array().cast("array<string>")
    walked = F.aggregate(F.split(path, "/"), nothing, lambda done, x: F.when(
        x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).when(x == ".", done).otherwise(F.concat(done, F.array(x))))
    closed = F.when(F.rlike(path, F.lit(r"/\.{1,2}$")), F.lit("/")).otherwise(F.lit(""))
    return F.when(F.rlike(path, F.lit(r"/\.{1,2}(/|$)")), F.concat(head, F.array_join(walked, "/"), closed, tail)).otherwise(url)


def resolve(base_url, href) -> Column:
    """Absolute URL of ``href`` relative to the page URL (fragment removed,
    dot segments folded); other schemes than http(s) stay as they are."""
    b, h = (F.col(base_url) if isinstance(base_url, str) else base_url), (F.col(href) if isinstance(href, str) else href)
    origin = F.regexp_extract(b, r"^(https?://[^/?#]+)", 1)
    scheme = F.regexp_extract(b, r"^(https?):", 1)
    basedir = F.regexp_extract(b, r"^(https?://[^?#]*/)", 1)
    rel_base = F.when(basedir.endswith("://") | (basedir == ""), F.concat(origin, F.lit("/"))).otherwise(basedir)
    out = (F.when(F.rlike(h, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), h)
           .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
           .when(h.startswith("/"), F.concat(origin, h))
           .when(h.startswith("?"), F.concat(F.regexp_extract(b, r"^([^?#]*)", 1), h))
           .when(F.rlike(h, F.lit("^(#|$)")), F.regexp_extract(b, "^([^#]*)", 1))
           .otherwise(F.concat(rel_base, h)))
    return fold_dots(F.regexp_replace(out, "(?s)#.*$", ""))


def anchor_list(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every page with ``anchors``: array of (pos, href, anchor_text, link_url)
    in the row, for http(s) targets only."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR), 1)
    texts = F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR), 2)
    p = pages.select("page_id", F.col(url_col).alias("page_url"), F.col(html_col).alias("html"),
                     F.arrays_zip(hrefs.alias("h"), texts.alias("t")).alias("_a"))
    p = p.select("page_id", "page_url", "html", F.transform("_a", lambda a, i: F.struct(
        i.alias("pos"), F.trim(decode_entities(a["h"].substr(F.lit(2), F.char_length(a["h"]) - 2))).alias("href"),
        F.trim(F.regexp_replace(decode_entities(F.regexp_replace(a["t"], "<[^>]*>", " ")), r"\s+", " ")).alias("anchor_text"))).alias("_a"))
    p = p.select("page_id", "page_url", "html", F.transform("_a", lambda a: F.struct(
        a["pos"].alias("pos"), a["href"].alias("href"), a["anchor_text"].alias("anchor_text"),
        resolve(F.col("page_url"), a["href"]).alias("link_url"))).alias("_a"))
    return p.select("page_id", "page_url", "html", F.filter("_a", lambda a: F.rlike(a["link_url"], F.lit("^https?://"))).alias("anchors"))


def anchors(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every anchor of every page: (page_id, page_url, pos, href, anchor_text, link_url)."""
    return anchor_list(pages, url_col, html_col).select("page_id", "page_url", F.explode("anchors").alias("a")).select("page_id", "page_url", "a.*")


def unquoted(c) -> Column:
    """Percent-decoded, a ``+`` kept; undecodable text as it stands."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def path_of(link_url: Column) -> Column:
    return unquoted(F.regexp_replace(F.regexp_replace(link_url, r"[?#].*$", ""), "^https?://[^/]*", ""))


def extension_of(link_url: Column) -> Column:
    return F.lower(F.regexp_extract(path_of(link_url), r"[^/.][^/]*?(\.[A-Za-z0-9]{1,5})$", 1))


def admitted(link_url: Column, anchor_text: Column, cfg: LinkConfig) -> Column:
    """Whether a link is a candidate: extension, keywords, exclusions, year."""
    norm = normalize_match(F.concat_ws(" ", link_url, anchor_text), case="lower")
    keep = extension_of(link_url).isin(list(cfg.extensions))
    if cfg.include:
        keep = keep & F.rlike(norm, F.lit("|".join(map(re.escape, cfg.include))))
    if cfg.exclude:
        keep = keep & ~F.rlike(norm, F.lit("|".join(map(re.escape, cfg.exclude))))
    if cfg.years is not None:
        keep = keep & F.coalesce(year_of(link_url, anchor_text).isin(list(cfg.years)), F.lit(False))
    return keep


def year_of(link_url: Column, anchor_text: Column) -> Column:
    """Document year: of the decoded file name, the decoded URL, the text."""
    return infer_year(F.regexp_extract(path_of(link_url), r"([^/]*)$", 1), unquoted(link_url), anchor_text)


def discover_links(pages: DataFrame, cfg: LinkConfig) -> DataFrame:
    """Candidate document links, first occurrence per absolute URL."""
    a = anchors(pages)
    a = a.filter(admitted(F.col("link_url"), F.col("anchor_text"), cfg)).withColumns({
        "extension": extension_of(F.col("link_url")),
        "year": year_of(F.col("link_url"), F.col("anchor_text")),
        "month": infer_month(F.concat_ws(" ", F.regexp_extract(path_of(F.col("link_url")), r"([^/]*)$", 1), "anchor_text", unquoted("link_url"))),
    })
    first = a.groupBy("link_url").agg(F.min_by(
        F.struct("page_id", "pos", "anchor_text", "extension", "year", "month"),
        F.struct("page_id", "pos")).alias("f"))
    return first.select("link_url", "f.*")


def visible_text(html) -> Column:
    """Text a reader sees: scripts, styles, comments and tags removed, basic
    entities decoded, whitespace collapsed."""
    s = F.col(html) if isinstance(html, str) else html
    s = F.regexp_replace(s, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    s = F.regexp_replace(s, r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(decode_entities(s), r"\s+", " "))


def page_fingerprint(pages: DataFrame, cfg: LinkConfig, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page SHA-256 of the folded, lower-cased visible text, of the
    sorted distinct candidate URLs joined by newlines, and their number.

    All in the page's row: no explode, no shuffle.
    """
    p = anchor_list(pages, url_col, html_col)
    p = p.select("page_id", "html", F.sort_array(F.array_distinct(F.transform(
        F.filter("anchors", lambda a: admitted(a["link_url"], a["anchor_text"], cfg)), lambda a: a["link_url"]))).alias("_u"))
    return p.select("page_id", F.sha2(normalize_match(visible_text("html"), case="lower"), 256).alias("visible_text_sha256"),
                    F.sha2(F.array_join("_u", "\n"), 256).alias("url_set_sha256"),
                    F.size("_u").alias("total_discovered_urls"))


def compare_fingerprints(prev: DataFrame, cur: DataFrame, key: str = "page_id") -> DataFrame:
    """No previous -> not comparable (NULL flags); changed = URL set changed."""
    p = prev.select(key, F.col("visible_text_sha256").alias("_pt"), F.col("url_set_sha256").alias("_pu"))
    j = cur.join(p, key, "left")
    comparable = F.col("_pt").isNotNull() | F.col("_pu").isNotNull()
    url_changed = F.when(comparable, ~F.col("_pu").eqNullSafe(F.col("url_set_sha256")))
    text_changed = F.when(comparable, ~F.col("_pt").eqNullSafe(F.col("visible_text_sha256")))
    return j.select(key, comparable.alias("comparable"), url_changed.alias("changed"),
                    url_changed.alias("url_set_changed"), text_changed.alias("visible_text_changed"))
