"""Ingest-snapshot queries (S1–S6, S16, S17) over resources derived from
``documents``: every document is one downloaded resource whose content is
its whole text.

Derivation rules (test-data instance):
  extension by language (en .xlsx, fr .xls, de .csv, es .pdf); file name
  ``informe_<mes>_<year><ext>`` with month ``doc_id % 12 + 1`` and year
  ``2000 + doc_id % 7``; status ``failed`` for texts under 200 chars,
  otherwise cycling over the success statuses; storage layout ``v2`` except
  German sources (``v1``); three manifests per source and layout.
  Two earlier runs: every document, under a former address when
  ``doc_id % 5 == 0``; in the last with a text that differs (one extra space)
  when ``doc_id % 7 == 0``, in the one before (one word more) when
  ``doc_id % 4 == 0``.  Storage listing: every stored file, left under a
  ``.partial`` name when ``doc_id % 11 == 0``; files of ``doc_id % 13 == 0``
  were altered after download.  No rule removes rows: every query reads
  the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import MONTHS_UPPER
from ..functions.hashing import resource_id, version_name
from ..session import per_session
from ..sources import manifests as M
from . import inputs

RUN_TS = "2026-01-01T00:00:00Z"


def _resources(spark: SparkSession, d: str) -> DataFrame:
    """Every document as a downloaded resource, its text still beside it: what
    is derived from content is hashed in this one scan."""
    doc = inputs.table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    ext = (F.when(F.col("lang") == "en", ".xlsx").when(F.col("lang") == "fr", ".xls")
           .when(F.col("lang") == "de", ".csv").otherwise(".pdf"))
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS_UPPER]), (F.col("doc_id") % 12 + 1).cast("int"))
    year = (F.lit(2000) + F.col("doc_id") % 7).cast("int")
    fname = F.concat(F.lit("informe_"), F.lower(month), F.lit("_"), year.cast("string"), ext)
    url = F.concat(F.lit("https://data.example.org/"), F.col("source"), F.lit("/"),
                   F.col("doc_id").cast("string"), F.lit("/"), fname)
    failed = F.col("n_chars") < 200
    status = F.when(failed, F.lit("failed")).otherwise(
        F.element_at(F.array(*[F.lit(s) for s in M.SUCCESS_STATUSES]), (F.col("doc_id") % 4 + 1).cast("int")))
    layout = F.when(F.col("lang") == "de", F.lit("v1")).otherwise(F.lit("v2"))
    r = doc.select(
        "doc_id", "source", url.alias("source_url"), resource_id(url).alias("resource_id"),
        F.concat(F.lit("Informe "), month, F.lit(" "), year.cast("string")).alias("anchor_text"),
        fname.alias("original_filename"), year.alias("document_year"), ext.alias("extension"),
        status.alias("status"),
        F.when(~failed, F.concat(F.lit("/raw/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit("/"), fname)).alias("stored_path"),
        F.when(~failed, F.octet_length("text").cast("bigint")).alias("size_bytes"),
        F.when(~failed, F.sha2("text", 256)).alias("sha256"),
        layout.alias("storage_layout_version"),
        F.concat(F.lit("manifest_"), F.col("source"), F.lit("_"), layout, F.lit("_"),
                 F.lpad((F.col("doc_id") % 3).cast("string"), 2, "0"), F.lit(".json")).alias("manifest_name"), "text")
    return r


@per_session
def records(spark: SparkSession, d: str) -> DataFrame:
    return _resources(spark, d).drop("text")


def latest_manifests(spark: SparkSession, d: str) -> DataFrame:
    """Latest v2 manifest per source and how many records it lists."""
    r = records(spark, d)
    latest = M.latest_manifest(r.select("source", "storage_layout_version", "manifest_name").distinct(),
                               layout="v2")
    counts = r.groupBy("source", "manifest_name").agg(F.count(F.lit(1)).alias("records"))
    return latest.join(counts, ["source", "manifest_name"], "left")


def _latest_records(spark: SparkSession, d: str) -> DataFrame:
    r = records(spark, d)
    latest = M.latest_manifest(r.select("source", "storage_layout_version", "manifest_name").distinct(),
                               layout="v2")
    return r.join(latest, ["source", "manifest_name"], "left_semi")


def eligible(spark: SparkSession, d: str) -> DataFrame:
    """S2 on the records of the latest manifests."""
    return M.eligible_records(_latest_records(spark, d)).select(
        "source", "source_url", "document_year", "document_month", "stored_path", "sha256")


def chosen_period(spark: SparkSession, d: str) -> DataFrame:
    """S3 + S4: latest period per source and its single-content verdict."""
    e = M.eligible_records(_latest_records(spark, d))
    return M.require_single_content(M.select_period(e))


def newest_files(spark: SparkSession, d: str) -> DataFrame:
    """Newest supported stored file per source (no-manifest fallback)."""
    r = records(spark, d).filter(F.col("stored_path").isNotNull())
    files = r.select("source", F.col("stored_path").alias("path"), F.make_timestamp_ntz(
        F.col("document_year"), (F.col("doc_id") % 12 + 1).cast("int"), (F.col("doc_id") % 28 + 1).cast("int"),
        F.lit(0), F.lit(0), F.lit(0)).alias("modificationTime"))
    return M.newest_file(files)


def storage_files(spark: SparkSession, d: str) -> DataFrame:
    f = _resources(spark, d).filter(F.col("stored_path").isNotNull())
    content = F.when(F.col("doc_id") % 13 == 0, F.concat("text", F.lit("\n"))).otherwise(F.col("text"))
    # an interrupted copy left the file of doc_id % 11 == 0 under a ".partial" name
    path = F.when(F.col("doc_id") % 11 == 0, F.concat("stored_path", F.lit(".partial"))).otherwise(F.col("stored_path"))
    return f.select(path.alias("path"), F.sha2(content, 256).alias("actual_sha256"),
                    F.octet_length(content).cast("bigint").alias("actual_size"))


def integrity(spark: SparkSession, d: str) -> DataFrame:
    """Verify every record against the storage listing."""
    v = M.verify_files(records(spark, d), storage_files(spark, d))
    return v.select("doc_id", "source_url", "status", "stored_path", "sha256", "actual_sha256",
                    "reason", "verified")


def _run_records(spark: SparkSession, d: str, at: str, text: Column, status: Column) -> DataFrame:
    # resources of doc_id % 5 == 0 were published under a former address
    url = F.when(F.col("doc_id") % 5 == 0, F.concat("source_url", F.lit("?v=old"))).otherwise(F.col("source_url"))
    return _resources(spark, d).select(url.alias("source_url"), F.sha2(text, 256).alias("sha256"), "storage_layout_version",
                                       status.alias("status"), F.lit(at).alias("downloaded_at_utc"))


def previous_run(spark: SparkSession, d: str) -> DataFrame:
    """Records of the run before this one."""
    text = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(" "))).otherwise(F.col("text"))
    # every third resource of the last run was copied back, not downloaded
    status = F.when(F.col("doc_id") % 3 == 0, F.lit("recovered_copy")).otherwise(F.lit("downloaded"))
    return _run_records(spark, d, "2025-12-01T00:00:00Z", text, status)


def earlier_runs(spark: SparkSession, d: str) -> DataFrame:
    """Records of the two runs before this one, every resource in each."""
    text = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("x "), F.col("text"))).otherwise(F.col("text"))
    return _run_records(spark, d, "2025-11-01T00:00:00Z", text, F.lit("downloaded")).unionByName(previous_run(spark, d))


def snapshot_status(spark: SparkSession, d: str) -> DataFrame:
    """Classify the current run against the two before it."""
    cur = records(spark, d).select(
        "doc_id", "source_url", "sha256",
        F.when(F.col("status") == "failed", F.lit("download failed")).alias("error"))
    out = M.classify_snapshot(earlier_runs(spark, d), cur, F.lit(RUN_TS), layout="v2")
    return out.select("doc_id", "source_url", "snapshot_status",
                      F.col("downloaded_at_utc_new").alias("downloaded_at_utc"))


def version_names(spark: SparkSession, d: str) -> DataFrame:
    """Immutable version names and the name/content conflicts among them.

    Files of ``doc_id % 13 == 0`` were altered in place: their name stands for
    two contents.
    """
    r = _resources(spark, d).filter(F.col("sha256").isNotNull())
    stem = F.regexp_replace("original_filename", r"\.[A-Za-z0-9]+$", "")
    contents = F.when(F.col("doc_id") % 13 == 0, F.array("sha256", F.sha2(F.concat("text", F.lit("\n")), 256))).otherwise(F.array("sha256"))
    v = r.select("doc_id", F.explode(contents).alias("sha256"), version_name(stem, "resource_id", "sha256", "extension").alias("version_name"),
                 (F.length(stem) + F.lit(len("__src_") + 12 + len("__sha256_") + 12) + F.length("extension"))
                 .alias("expected_len"))
    issues = M.check_versions(v, expected_len=F.col("expected_len"))
    return v.join(issues, "version_name", "left").select("doc_id", "sha256", "version_name", "issue")
