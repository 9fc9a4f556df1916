"""Sinks (W1–W6): table overwrite, lineage properties, verified flat export,
run log and conditional compaction.

Writes are plain Spark writers (parquet tables; no table-format jar is
assumed).  Checks after a write re-read what was written; nothing is pulled
to the driver except one-row counts.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import verify_write


def _q(s: str) -> str:
    """SQL string literal with backslash escaping (Spark SQL lexer rules)."""
    return "'" + str(s).replace("\\", "\\\\").replace("'", "\\'") + "'"


def overwrite(df: DataFrame, name: str, partition_by=None, fmt: str = "parquet") -> None:
    """Replace a managed table and its schema."""
    w = df.write.mode("overwrite").format(fmt).option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def set_lineage(spark: SparkSession, name: str, props: dict) -> None:
    """Set table properties (values quoted and escaped)."""
    if not props:
        return
    body = ", ".join(f"{_q(k)} = {_q(v)}" for k, v in props.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({body})")


def get_lineage(spark: SparkSession, name: str) -> DataFrame:
    """Table properties as (key, value) rows."""
    return spark.sql(f"SHOW TBLPROPERTIES {name}")


def write_verified(df: DataFrame, name: str, props: dict | None = None) -> DataFrame:
    """W1 + W2 + W3: overwrite, set lineage, re-read and verify; returns checks."""
    spark = df.sparkSession
    overwrite(df, name)
    if props:
        set_lineage(spark, name, props)
    return verify_write(df, spark.table(name))


def export_flat(df: DataFrame, path: str, order, fmt: str = "csv", single_file: bool = False,
                allowed: tuple | None = None, name: str | None = None) -> DataFrame:
    """Deterministic, ordered export of a serving table, verified after write.

    ``single_file`` is meant for bounded serving tables (one ordered file for
    spreadsheet users); otherwise the sort is range-partitioned into many
    files whose names follow the order.  Returns (rows, columns, status).
    """
    if allowed is not None and name not in allowed:
        raise ValueError(f"{name!r} is not an exportable serving table")
    out = df.orderBy(*order)
    if single_file:
        out = out.coalesce(1)
    w = out.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    w.save(path)
    spark = df.sparkSession
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", "true")
    back = r.load(path)
    n_src = df.select(F.count(F.lit(1))).scalar()
    return back.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(back.columns)).alias("columns"),
        F.when((F.col("rows") == n_src) & (F.col("rows") > 0) & F.lit(len(back.columns) == len(df.columns)),
               F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))


def append_run(spark: SparkSession, path: str, record: dict) -> DataFrame:
    """Append one run record to a run log partitioned by layer; returns the
    re-read record.  Raises unless exactly one row of the run is there then."""
    rec = dict(record)
    rec.setdefault("logged_at_utc", _dt.datetime.now(_dt.timezone.utc).isoformat())
    cols = sorted(rec)
    df = spark.createDataFrame([tuple(str(rec[c]) if rec[c] is not None else None for c in cols)],
                               ", ".join(f"`{c}` string" for c in cols))
    df.write.mode("append").partitionBy("layer").parquet(path)
    back = spark.read.parquet(path).filter((F.col("run_id") == rec["run_id"]) & (F.col("layer") == rec["layer"]))
    found = back.count()
    if found != 1:
        raise RuntimeError(f"run log {path} holds {found} records of run {rec['run_id']!r} in layer {rec['layer']!r}")
    return back


def run_record(spark: SparkSession, run_id: str, layer: str, rules: DataFrame, config,
               lineage: dict | None = None, started_at: str | None = None, metrics: dict | None = None) -> dict:
    """The run record of a layer — ids, versions, duration, config hash,
    lineage, the rules' results (a bounded list; counts per status besides)
    and the metrics that were observed while the tables were written
    (extraction, cleaning, conversion, normalisation, rows and null cells).
    Status is FAIL when any CRITICAL rule failed."""
    import json

    from ..operators.audit import config_hash

    now = _dt.datetime.now(_dt.timezone.utc)
    start = _dt.datetime.fromisoformat(started_at) if started_at else now
    shown = [c for c in ("table", "rule", "severity", "status", "checked", "violations") if c in rules.columns]
    found = [r.asDict() for r in rules.select(*shown).orderBy(*shown).collect()]
    counts = {s: sum(r["status"] == s for r in found) for s in ("PASS", "WARN", "FAIL")}
    return {
        "run_id": run_id, "layer": layer, "spark_version": spark.version,
        "started_at_utc": start.isoformat(), "duration_seconds": round((now - start).total_seconds(), 3),
        "config_sha256": config_hash(config), "lineage": json.dumps(lineage or {}, sort_keys=True),
        "rules": json.dumps(found), "metrics": json.dumps(metrics or {}, sort_keys=True),
        "rules_pass": counts["PASS"], "rules_warn": counts["WARN"],
        "rules_fail": counts["FAIL"], "status": "FAIL" if counts["FAIL"] else "OK",
    }


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Number of data files and bytes under ``path`` (metadata only; the
    binaryFile source does not read content when it is not selected)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def compact_if(spark: SparkSession, path: str, out: str, min_files: int, min_bytes: int,
               zcol: str | None = None, target_bytes: int = 128 * 1024 * 1024) -> dict:
    """Rewrite a parquet table into fewer, clustered files only when it has
    at least ``min_files`` files **or** ``min_bytes`` bytes; otherwise
    ``SKIPPED_SMALL_TABLE``.  With ``zcol`` rows are range-partitioned and
    sorted on it (clustering for data skipping)."""
    st = file_stats(spark, path).first()
    files, size = int(st["files"]), int(st["bytes"])
    if files < min_files and size < min_bytes:
        return {"status": "SKIPPED_SMALL_TABLE", "files": files, "bytes": size}
    n = max(1, math.ceil(size / target_bytes))
    df = spark.read.parquet(path)
    df = df.repartitionByRange(n, zcol).sortWithinPartitions(zcol) if zcol else df.repartition(n)
    df.write.mode("overwrite").parquet(out)
    after = file_stats(spark, out).first()
    return {"status": "COMPACTED", "files": files, "bytes": size, "files_after": int(after["files"])}
