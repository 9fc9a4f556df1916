"""Manifest, file and snapshot operators.

Inputs are DataFrames of manifest records (one row per resource of an
ingest run) and file listings (path, size, content hash, modification
time); on a cluster they come from ``spark.read.json(manifests,
multiLine=True)`` exploded over ``files``/``records`` and from
``spark.read.format("binaryFile")``.  Every selection is an aggregate
(``max_by``/``min_by``) or a join — no driver-side loops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import infer_month

# --- fixed values ---------------------------------------------------------
SUCCESS_STATUSES = ("downloaded", "unchanged", "updated_version", "recovered_copy")
INDEXED_STATUSES = ("downloaded", "updated_version", "unchanged")
SPREADSHEET_EXTS = (".xlsx", ".xls")
# --------------------------------------------------------------------------

RECORD_FIELDS = [
    ("source", T.StringType()), ("source_url", T.StringType()), ("resource_id", T.StringType()),
    ("anchor_text", T.StringType()), ("original_filename", T.StringType()),
    ("document_year", T.IntegerType()), ("extension", T.StringType()), ("status", T.StringType()),
    ("stored_path", T.StringType()), ("size_bytes", T.LongType()), ("sha256", T.StringType()),
    ("downloaded_at_utc", T.StringType()),
]
MANIFEST_SCHEMA = T.StructType([
    T.StructField("manifest_schema_version", T.StringType()),
    T.StructField("storage_layout_version", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("files", T.ArrayType(T.StructType([T.StructField(n, t) for n, t in RECORD_FIELDS]))),
])


def read_manifests(spark: SparkSession, path: str, list_key: str = "files") -> DataFrame:
    """Scan manifest JSON files (explicit schema, bad files tolerated) to one
    row per manifest with its name."""
    schema = MANIFEST_SCHEMA
    if list_key != "files":
        schema = T.StructType([f if f.name != "files" else T.StructField(list_key, f.dataType)
                               for f in MANIFEST_SCHEMA.fields])
    df = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return df.withColumn("manifest_name", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1))


def latest_manifest(manifests: DataFrame, source=None, layout=None,
                    name_col: str = "manifest_name", allow_blank_layout: bool = False) -> DataFrame:
    """Per source, the greatest manifest name whose source/layout match."""
    m = manifests
    if source is not None:
        m = m.filter(F.col("source") == source)
    if layout is not None:
        ok = F.col("storage_layout_version") == layout
        if allow_blank_layout:
            ok = ok | F.col("storage_layout_version").isNull() | (F.trim("storage_layout_version") == "")
        m = m.filter(ok)
    return m.groupBy("source").agg(F.max(name_col).alias(name_col))


def eligible_records(records: DataFrame, statuses=SUCCESS_STATUSES, exts=SPREADSHEET_EXTS) -> DataFrame:
    """Success status, supported extension, path+sha+year present; month inferred."""
    r = records.filter(F.col("status").isin(list(statuses)) & F.lower("extension").isin(list(exts))
                       & F.col("stored_path").isNotNull() & F.col("sha256").isNotNull()
                       & F.col("document_year").isNotNull())
    text = F.concat_ws(" ", F.coalesce("original_filename", F.lit("")),
                       F.coalesce("anchor_text", F.lit("")), F.coalesce("source_url", F.lit("")))
    return r.withColumn("document_month", infer_month(text))


def select_period(records: DataFrame, year: int | None = None, month: int | None = None,
                  by: str = "source", guard: bool = False) -> DataFrame:
    """S3: records of the target (year, month) or of the greatest period per ``by``.

    With ``guard`` a selection without records fails when it is read, and the
    error lists the periods that there are (none: no month could be inferred).
    """
    if year is not None and month is not None:
        chosen = records.filter((F.col("document_year") == year) & (F.col("document_month") == month))
        what = f"period {year}-{month:02d}"
    else:
        latest = records.filter(F.col("document_month").isNotNull()).groupBy(by).agg(
            F.max(F.struct("document_year", "document_month")).alias("_p"))
        chosen = records.join(latest, by, "inner").filter(
            (F.col("document_year") == F.col("_p.document_year"))
            & (F.col("document_month") == F.col("_p.document_month"))).drop("_p")
        what = "latest period"
    if not guard:
        return chosen
    period = F.concat(F.col("document_year").cast("string"), F.lit("-"), F.coalesce(F.lpad(F.col("document_month").cast("string"), 2, "0"), F.lit("?")))
    there = records.select(F.array_join(F.sort_array(F.collect_set(period)), ", ")).scalar()
    found = chosen.select(F.count(F.lit(1))).scalar()
    return chosen.unionByName(_asserted(records, found > 0, F.concat(F.lit(f"{what}: no records; periods found: "), there)))


def _asserted(like: DataFrame, holds: Column, message: Column) -> DataFrame:
    """No rows of ``like``'s columns; reading them fails where ``holds`` does not."""
    row = like.sparkSession.range(1).filter(F.assert_true(holds, message).isNotNull())
    return row.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def require_single_content(chosen: DataFrame, by: str = "source", guard: bool = False) -> DataFrame:
    """Per ``by``: distinct content hashes of the chosen period; ambiguous
    when >1; otherwise the record with the smallest (url, path).

    With ``guard`` an ambiguous period fails when it is read, and the error
    names the source, the period and two of the clashing hashes with their
    addresses.
    """
    g = chosen.groupBy(by, "document_year", "document_month").agg(
        F.count_distinct("sha256").alias("distinct_sha"),
        F.min_by(F.struct("source_url", "stored_path", "sha256"),
                 F.struct("source_url", "stored_path")).alias("_r"),
        F.min(F.struct("sha256", "source_url")).alias("_low"), F.max(F.struct("sha256", "source_url")).alias("_high"))
    ambiguous = F.col("distinct_sha") > 1
    if guard:
        clash = F.concat(F.lit("different contents for "), F.col(by).cast("string"), F.lit(" "), F.col("document_year").cast("string"), F.lit("-"),
                         F.col("document_month").cast("string"), F.lit(": "), F.col("distinct_sha").cast("string"), F.lit(" hashes, among them "),
                         F.col("_low.sha256"), F.lit(" ("), F.coalesce("_low.source_url", F.lit("?")), F.lit(") and "),
                         F.col("_high.sha256"), F.lit(" ("), F.coalesce("_high.source_url", F.lit("?")), F.lit(")"))
        ambiguous = F.when(ambiguous, F.raise_error(clash).cast("boolean")).otherwise(F.lit(False))
    return g.select(by, "document_year", "document_month", "distinct_sha", ambiguous.alias("ambiguous"),
                    F.col("_r.source_url").alias("source_url"), F.col("_r.stored_path").alias("stored_path"),
                    F.col("_r.sha256").alias("sha256"))


def newest_file(files: DataFrame, exts=SPREADSHEET_EXTS, by: str = "source") -> DataFrame:
    """Per ``by``, the newest supported file (ties: greatest path)."""
    f = files.filter(F.lower(F.regexp_extract("path", r"(\.[A-Za-z0-9]+)$", 1)).isin(list(exts)))
    return f.groupBy(by).agg(F.max_by(F.struct("path", "modificationTime"),
                                      F.struct("modificationTime", "path")).alias("_f")) \
        .select(by, F.col("_f.path").alias("path"), F.col("_f.modificationTime").alias("modificationTime"),
                F.lit("fallback_newest_file").alias("selection_mode"))


def verify_files(records: DataFrame, files: DataFrame) -> DataFrame:
    """Integrity of manifest records against files on storage.

    ``files``: (path, actual_sha256, actual_size).  Reason is
    ``download_failed`` / ``missing_stored_path`` / ``file_not_found`` /
    ``sha256_mismatch`` or NULL when the file verifies.
    """
    f = files.select(F.col("path").alias("_path"), "actual_sha256", "actual_size")
    # Failed records have no path: they are not sent through the join, where
    # they would all meet in one partition.
    kept = records.filter(F.col("stored_path").isNotNull()).join(f, F.col("stored_path") == F.col("_path"), "left").drop("_path")
    none = {c: F.lit(None).cast(files.schema[c].dataType) for c in ("actual_sha256", "actual_size")}
    j = kept.unionByName(records.filter(F.col("stored_path").isNull()).withColumns(none))
    reason = (F.when(F.col("status") == "failed", F.lit("download_failed"))
              .when(F.col("stored_path").isNull(), F.lit("missing_stored_path"))
              .when(F.col("actual_sha256").isNull(), F.lit("file_not_found"))
              .when(F.col("actual_sha256") != F.col("sha256"), F.lit("sha256_mismatch")))
    return j.withColumn("reason", reason).withColumn("verified", F.col("reason").isNull())


def snapshot_index(history: DataFrame) -> DataFrame:
    """The last valid record of each URL and storage layout, over any
    number of runs: (source_url, storage_layout_version, sha256, status,
    downloaded_at_utc).

    Valid are records with a URL and a status of ``INDEXED_STATUSES``; last is
    by download time, then hash.  The reduction is associative: adding a run
    to an index (:func:`updated_index`) equals indexing the whole history.
    """
    valid = history.filter(F.col("source_url").isNotNull() & F.col("status").isin(list(INDEXED_STATUSES)))
    last = F.max_by(F.struct("sha256", "status", "downloaded_at_utc"), F.struct("downloaded_at_utc", "sha256")).alias("_r")
    return valid.groupBy("source_url", "storage_layout_version").agg(last).select("source_url", "storage_layout_version", "_r.*")


def updated_index(index: DataFrame, run: DataFrame) -> DataFrame:
    """An index with a further run's records."""
    return snapshot_index(index.unionByName(run.select(*index.columns)))


def classify_snapshot(previous: DataFrame, current: DataFrame, run_ts: Column, layout: str | None = None) -> DataFrame:
    """Idempotent-ingest status of each current resource vs earlier runs.

    failed -> ``failed``; content already stored for this resource (same URL
    and hash: the versioned name exists) -> ``unchanged``; other content than
    the previous record of this URL -> ``updated_version``; otherwise
    ``downloaded`` - also for known content under another URL.  ``previous``
    may hold many runs: a URL's previous record is its one in
    :func:`snapshot_index` for the same storage ``layout`` (None: of any), and
    its download time is kept.
    """
    one = previous if layout is not None else previous.withColumn("storage_layout_version", F.lit(None).cast("string"))
    indexed = snapshot_index(one)
    if layout is not None:
        indexed = indexed.filter(F.col("storage_layout_version") == layout)
    prev = indexed.select(F.col("source_url").alias("_url"), F.col("sha256").alias("_prev_sha"), F.col("downloaded_at_utc").alias("_prev_at"))
    stored = previous.filter(F.col("sha256").isNotNull()).select(
        F.col("source_url").alias("_stored_url"), F.col("sha256").alias("_stored_sha")).distinct()
    # Failed records have no content: they take no part in the joins.
    ok = current.filter(F.col("error").isNull())
    j = ok.join(prev, F.col("source_url") == F.col("_url"), "left").join(
        stored, (F.col("source_url") == F.col("_stored_url")) & (F.col("sha256") == F.col("_stored_sha")), "left")
    status = (F.when(F.col("_stored_sha").isNotNull(), F.lit("unchanged"))
              .when(F.col("_prev_sha").isNotNull() & (F.col("_prev_sha") != F.col("sha256")), F.lit("updated_version"))
              .otherwise(F.lit("downloaded")))
    at = F.when(status == "unchanged", F.coalesce(F.col("_prev_at"), run_ts)).otherwise(run_ts)
    done = j.select(*current.columns, status.alias("snapshot_status"), at.alias("downloaded_at_utc_new"))
    return done.unionByName(current.filter(F.col("error").isNotNull()).select(
        *current.columns, F.lit("failed").alias("snapshot_status"), run_ts.alias("downloaded_at_utc_new")))


def check_versions(df: DataFrame, name_col: str = "version_name", sha_col: str = "sha256",
                   expected_len: Column | None = None) -> DataFrame:
    """Version names that map to more than one content hash, or whose
    length differs from the declared one."""
    conflicts = df.groupBy(name_col).agg(F.count_distinct(sha_col).alias("distinct_sha")) \
        .filter(F.col("distinct_sha") > 1).select(name_col, F.lit("name_reused_for_other_content").alias("issue"))
    if expected_len is None:
        return conflicts
    bad_len = df.filter(F.length(name_col) != expected_len).select(
        name_col, F.lit("unexpected_length").alias("issue")).distinct()
    return conflicts.unionByName(bad_len)
