"""Scalar function queries (O1–O29) over whole driver tables.

Each query applies one family of Column functions to every row (and, for
text, to the whole text) of a driver table; results are per-row values or
hashes of long outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_date, parse_period
from ..functions.hashing import resource_id
from ..functions.numbers import identifier, parse_int, parse_number
from ..functions.text import canonical_label, clean_text, normalize_match, safe_filename
from . import inputs

NUMBER_TOKEN = r"[-$]?[0-9][0-9.,%]*"


def clean_documents(spark: SparkSession, d: str) -> DataFrame:
    """O1 over every document text: cleaned length, SHA-256, null-token flag."""
    t = inputs.table(spark, d, "documents").select("doc_id", clean_text("text").alias("c"))
    return t.select("doc_id", F.length("c").alias("clean_len"),
                    F.sha2("c", 256).alias("clean_sha"), F.col("c").isNull().alias("is_null"))


def fold_documents(spark: SparkSession, d: str) -> DataFrame:
    """O2 (accent fold + whitespace collapse + trim, native) over every text."""
    t = inputs.table(spark, d, "documents").select("doc_id", normalize_match("text", case=None).alias("f"))
    return t.select("doc_id", F.length("f").alias("folded_len"), F.sha2("f", 256).alias("folded_sha"))


def canonical_part_names(spark: SparkSession, d: str) -> DataFrame:
    """O3 on part names (clean, upper, Spanish capitals folded, aliases)."""
    p = inputs.table(spark, d, "part")
    return p.select("p_partkey", canonical_label("p_name").alias("label"))


def number_tokens(spark: SparkSession, d: str) -> DataFrame:
    """O4/O5/O9 on every numeric-looking token of every document."""
    t = inputs.table(spark, d, "documents").select(
        "doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(NUMBER_TOKEN), 0)).alias("pos", "token"))
    return t.select("doc_id", "pos", "token", parse_number("token").alias("number"),
                    parse_int("token").alias("integer"), identifier("token", 10).alias("code"))


def event_dates(spark: SparkSession, d: str) -> DataFrame:
    """O6 on event timestamps rendered in the three accepted formats (and junk)."""
    e = inputs.table(spark, d, "events").select("event_id", "ts", "props")
    k = F.col("event_id") % 4
    raw = (F.when(k == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
           .when(k == 1, F.date_format("ts", "yyyy-MM-dd"))
           .when(k == 2, F.date_format("ts", "dd/MM/yyyy"))
           .otherwise(F.col("props")))
    return e.select("event_id", raw.alias("raw"), parse_date(raw).alias("parsed"))


def period_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """O11 on the refined period texts: year, month, first-of-month date."""
    f = inputs.subcode_fact(spark, d).select("period_text").distinct()
    y, m, dt = parse_period("period_text")
    return f.select("period_text", y.alias("year"), m.alias("month"), dt.alias("period_date"))


def page_file_names(spark: SparkSession, d: str) -> DataFrame:
    """O24 resource ids and O25 safe file names of every page URL."""
    p = inputs.table(spark, d, "pages").select("page_id", "url")
    return p.select("page_id", resource_id("url").alias("resource_id"),
                    safe_filename("url").alias("file_name"))
