"""Web-page queries (S13–S15) over the whole ``pages`` table.

Previous capture (test-data instance): pages with ``page_id % 10 == 0`` were
not captured (NULL fingerprints); the first anchor of ``page_id % 3 == 0`` had
no href; the text of ``page_id % 4 == 0`` had one word more.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import MONTHS_UPPER
from ..sources.links import LinkConfig, compare_fingerprints, discover_links, page_fingerprint
from . import inputs

CONFIG = LinkConfig(extensions=("", ".xlsx", ".xls", ".pdf", ".html"),
                    include=("the", "de", "la", "und", "en"), exclude=("ad",), years=None)


#: Years whose documents S13 is to find.
DATED = replace(CONFIG, include=(), exclude=(), years=(2001, 2002, 2003))


def dated_pages(spark: SparkSession, d: str) -> DataFrame:
    p = inputs.table(spark, d, "pages").select("page_id", "url", "html")
    month = F.element_at(F.array(*[F.lit(m.lower()) for m in MONTHS_UPPER]), (F.col("page_id") % 12 + 1).cast("int"))
    name = F.concat(F.lit("informe-"), F.when(F.col("page_id") % 9 == 0, F.lit("anual")).otherwise(month), F.lit("-"), (F.lit(2000) + F.col("page_id") % 5).cast("string"), F.lit(".xlsx"))
    return p.withColumn("html", F.regexp_replace("html", F.lit('<a href="([^"?#]*)"'), F.concat(F.lit('<a href="$1/'), name, F.lit('"'))))


def links(spark: SparkSession, d: str) -> DataFrame:
    """S13 with O7/O8: document links of the configured years, the year and
    month that each carries."""
    return discover_links(dated_pages(spark, d), DATED)


def fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """S14 over every page."""
    return page_fingerprint(inputs.table(spark, d, "pages"), CONFIG)


def fingerprint_changes(spark: SparkSession, d: str) -> DataFrame:
    """Current fingerprints against the previous capture."""
    p = inputs.table(spark, d, "pages").select("page_id", "url", "html")
    # the last capture lacked a paragraph on every fourth page, and the first
    # link of every third had no target yet
    old = F.when(F.col("page_id") % 4 == 0, F.concat("html", F.lit("<p>x</p>"))).otherwise(F.col("html"))
    old = F.when(F.col("page_id") % 3 == 0, F.regexp_replace(old, "^(.*?)<a href=", "$1<a name=")).otherwise(old)
    prev = page_fingerprint(p.withColumn("html", old), CONFIG)
    captured = F.col("page_id") % 10 != 0
    prev = prev.select("page_id", *[F.when(captured, F.col(c)).alias(c) for c in ("visible_text_sha256", "url_set_sha256")])
    return compare_fingerprints(prev, fingerprints(spark, d))
