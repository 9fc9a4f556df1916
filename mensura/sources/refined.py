"""Open a refined table behind its gate.

A gold job reads a refined table only if: the table exists, its columns are
exactly the contract's (in order), the lineage properties name the expected
layer / source / version, it is not empty, and the run id and input hash
are non-blank.  The checks are returned as a DataFrame (one row per check);
the emptiness test reads at most one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def open_refined(spark: SparkSession, name: str, columns, expected_props: dict,
                 required_props=("run_id", "input_sha256")) -> tuple[DataFrame | None, DataFrame]:
    """Return (table, checks[check, ok, detail, status]); the table is None
    unless every check holds."""
    checks = []
    exists = spark.catalog.tableExists(name)
    checks.append(("exists", exists, name))
    df = spark.table(name) if exists else None
    if df is not None:
        checks.append(("columns", list(df.columns) == list(columns), ",".join(df.columns)))
        props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        for k, v in expected_props.items():
            checks.append((f"property:{k}", props.get(k) == str(v), str(props.get(k))))
        for k in required_props:
            val = props.get(k)
            checks.append((f"non_blank:{k}", bool(val and str(val).strip()), str(val)))
        checks.append(("not_empty", not df.isEmpty(), ""))
    out = spark.createDataFrame(checks, "check string, ok boolean, detail string")
    out = out.withColumn("status", F.when(F.col("ok"), F.lit("PASS")).otherwise(F.lit("FAIL")))
    return df if all(ok for _, ok, _ in checks) else None, out
