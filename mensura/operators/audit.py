"""Reproducibility and audit operators.

The table fingerprint (R1) is one distributed aggregate: every row is
rendered as canonical typed text (columns sorted, NULLs kept, doubles by
their exact value), hashed with SHA-256, and two 60-bit words of each hash
are summed as DECIMAL(38,0) together with the row count.  The combination is
independent of file layout, partitioning, row order and column order, can be
merged from parts, and is sensitive to multiplicity (a duplicated row changes
it).  Another engine computes the same text and sums, so fingerprints can be
compared across engines.  Two tables that differ agree in both sums with a
chance of about 2**-120.
"""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import row_sha


def schema_sha(df: DataFrame) -> str:
    """SHA-256 of the (name, type) list sorted by name (metadata only)."""
    fields = sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    return hashlib.sha256(json.dumps(fields, separators=(",", ":")).encode()).hexdigest()


def row_words(df: DataFrame) -> list:
    """w1 and w2: two 60-bit words of each row's hash, to be summed."""
    h = row_sha(df)
    return [F.conv(F.substring(h, at, 15), 16, 10).cast("decimal(38,0)").alias(name) for name, at in (("w1", 1), ("w2", 16))]


def bucket_digests(df: DataFrame, buckets: int) -> DataFrame:
    """(bucket, rows, s1, s2): the table's fingerprint in parts, by a hash of
    the row.  One aggregate; no row is shuffled, only a line per bucket."""
    w1, w2 = row_words(df)
    return (df.select(w1, w2).groupBy(F.pmod("w1", F.lit(buckets)).cast("int").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("w1").alias("s1"), F.sum("w2").alias("s2")))


def differing_buckets(a: DataFrame, b: DataFrame, buckets: int) -> list[int]:
    """Buckets whose digests differ (or that one side lacks); at most ``buckets``."""
    x = bucket_digests(a, buckets).select("bucket", F.struct("rows", "s1", "s2").alias("x"))
    y = bucket_digests(b, buckets).select("bucket", F.struct("rows", "s1", "s2").alias("y"))
    return sorted(r["bucket"] for r in x.join(y, "bucket", "full_outer").filter(~F.col("x").eqNullSafe(F.col("y"))).select("bucket").collect())


def in_buckets(df: DataFrame, which: list[int], buckets: int) -> DataFrame:
    """Rows of the given buckets."""
    return df.filter(F.pmod(row_words(df)[0], F.lit(buckets)).cast("int").isin(which))


def fingerprint(df: DataFrame, table: str) -> DataFrame:
    """One row (table, rows, columns, schema_sha, content_sha)."""
    agg = df.select(*row_words(df)).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("w1"), F.lit(0)).alias("s1"),
        F.coalesce(F.sum("w2"), F.lit(0)).alias("s2"))
    content = F.sha2(F.concat_ws(":", F.col("rows").cast("string"), F.col("s1").cast("string"),
                                 F.col("s2").cast("string")), 256)
    return agg.select(F.lit(table).alias("table"), "rows",
                      F.lit(",".join(sorted(df.columns))).alias("columns"),
                      F.lit(schema_sha(df)).alias("schema_sha"), content.alias("content_sha"))


def snapshot(tables: dict) -> DataFrame:
    """Fingerprints of several tables (one aggregate job each) as one DataFrame."""
    return reduce(lambda a, b: a.unionByName(b), [fingerprint(df, name) for name, df in tables.items()])


def layer_consistency(props: DataFrame) -> DataFrame:
    """R2: per layer exactly one non-blank run id, version and input hash.

    ``props``: (layer, table, key, value).
    """
    keys = ["run_id", "pipeline_version", "input_sha256"]
    p = props.filter(F.col("key").isin(keys))
    g = p.groupBy("layer", "key").agg(
        F.count_distinct("value").alias("distinct_values"),
        F.count_if(F.col("value").isNull() | (F.trim("value") == "")).alias("blank_values"))
    ok = (F.col("distinct_values") == 1) & (F.col("blank_values") == 0)
    return g.withColumn("status", F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")))


def lineage_link(props: DataFrame, upstream: str, downstream: str, link_key: str,
                 expected_input: str | None = None) -> DataFrame:
    """Downstream tables point at the upstream run id (and the frozen input)."""
    up = props.filter((F.col("layer") == upstream) & (F.col("key") == "run_id")).select(
        F.col("value").alias("upstream_run_id")).distinct()
    down = props.filter((F.col("layer") == downstream) & (F.col("key") == link_key)).select(
        "table", F.col("value").alias("linked_run_id"))
    j = down.join(up, down.linked_run_id == up.upstream_run_id, "left")
    out = j.select("table", "linked_run_id", F.col("upstream_run_id").isNotNull().alias("linked"))
    if expected_input is not None:
        inp = props.filter((F.col("layer") == downstream) & (F.col("key") == "input_sha256")).select(
            "table", (F.col("value") == F.lit(expected_input)).alias("input_matches"))
        out = out.join(inp, "table", "left")
    return out


def layer_contract(props: DataFrame, tables: list[str], expected: dict[str, str], single: list[str], bounds: DataFrame,
                   period_key: str) -> DataFrame:
    """Cross-table contract of a layer (D-C, with R2): (check, key, tables,
    violations, status).

    ``props``: (layer, table, key, value) of a whole layer.  Every one of
    ``tables`` has each property of ``expected`` with its value; those of
    ``single`` (run id, input hash, report period) are not blank and the same
    in all; no month of ``bounds`` (table, period_max date) lies after the
    table's own ``period_key`` (yyyy-MM).  A table that lacks a property
    violates its check.
    """
    spark = props.sparkSession
    keys = [("expected", k, v) for k, v in expected.items()] + [("single", k, None) for k in single]
    wanted = spark.createDataFrame([(c, k, v, t) for c, k, v in keys for t in tables], "check string, key string, want string, table string")
    have = props.select(F.col("table").alias("_t"), F.col("key").alias("_k"), "value")
    j = wanted.join(have, (F.col("table") == F.col("_t")) & (F.col("key") == F.col("_k")), "left")
    blank = F.col("value").isNull() | (F.trim("value") == "")
    g = j.groupBy("check", "key").agg(
        F.count(F.lit(1)).alias("tables"), F.count_if(blank).alias("blank"), F.count_distinct("value").alias("values"),
        F.count_if(~F.col("value").eqNullSafe(F.col("want"))).alias("other"))
    checks = g.select("check", "key", "tables", F.when(F.col("check") == "expected", F.col("other")).otherwise(F.col("blank") + F.greatest(F.col("values") - 1, F.lit(0))).alias("violations"))
    period = have.filter(F.col("_k") == period_key)
    late = bounds.join(period, F.col("table") == F.col("_t"), "left")
    after = F.coalesce(F.date_format("period_max", "yyyy-MM") > F.col("value"), F.col("value").isNull())
    checks = checks.unionByName(late.agg(F.lit("bounds").alias("check"), F.lit(period_key).alias("key"), F.count(F.lit(1)).alias("tables"), F.count_if(after).alias("violations")))
    return checks.withColumn("status", F.when(F.col("violations") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")))


def technical_suite(spark, names: dict[str, str], expected_rows: dict[str, int], expected_columns: dict[str, list], expected_props: dict[str, str]) -> DataFrame:
    """D-QA over persisted tables, as the catalog names them: (table, test,
    status, detail) for readable, rows, columns, exact duplicates, lineage.

    Each table is read once: one aggregate by all its columns gives rows and
    duplicate groups.  A table that cannot be read fails its first test and
    has no others.
    """
    parts = []
    for logical, name in names.items():
        def result(test: str, ok, detail, logical=logical):
            return F.struct(F.lit(logical).alias("table"), F.lit(test).alias("test"),
                            F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"), detail.cast("string").alias("detail"))

        try:
            t = spark.table(name)
            counted = t.groupBy(*[F.col(f"`{c}`") for c in t.columns]).agg(F.count(F.lit(1)).alias("_n")).agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count_if(F.col("_n") > 1).alias("groups"))
            have = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
            row = counted.first()  # one row: whether the files can be read at all
        except Exception as e:
            parts.append(spark.range(1).select(F.inline(F.array(result("readable", F.lit(False), F.lit(type(e).__name__))))))
            continue
        lineage = all(have.get(k) == v for k, v in expected_props.items())
        parts.append(spark.range(1).select(F.inline(F.array(
            result("readable", F.lit(True), F.lit("")),
            result("rows", F.lit(row["rows"] == expected_rows[logical]), F.lit(row["rows"])),
            result("columns", F.lit(t.columns == expected_columns[logical]), F.lit(",".join(t.columns))),
            result("exact_duplicates", F.lit(row["groups"] == 0), F.lit(row["groups"])),
            result("lineage", F.lit(lineage), F.lit(",".join(sorted(expected_props)))),
        ))))
    return reduce(lambda a, b: a.unionByName(b), parts)


def status_counts(rules: DataFrame) -> DataFrame:
    """Number of rules per status (PASS/WARN/FAIL)."""
    return rules.groupBy("status").agg(F.count(F.lit(1)).alias("rules"))


def config_hash(obj) -> str:
    """SHA-256 of the sorted JSON of a (small, declared) configuration."""
    return hashlib.sha256(json.dumps(obj, sort_keys=True, default=str, separators=(",", ":"))
                          .encode()).hexdigest()


def check_rows(snap: DataFrame, expected: DataFrame) -> DataFrame:
    """Observed vs expected row counts per table."""
    j = expected.join(snap.select("table", "rows"), "table", "left")
    return j.withColumn("status", F.when(F.col("rows") == F.col("expected_rows"), F.lit("PASS"))
                        .otherwise(F.lit("FAIL")))


def check_schema(df: DataFrame, table: str, required=(), forbidden=()) -> DataFrame:
    """Required / forbidden columns (schema only)."""
    cols = set(df.columns)
    rows = [(table, c, "required", c in cols) for c in required]
    rows += [(table, c, "forbidden", c not in cols) for c in forbidden]
    spark = df.sparkSession
    out = spark.createDataFrame(rows, "table string, column string, kind string, ok boolean")
    return out.withColumn("status", F.when(F.col("ok"), F.lit("PASS")).otherwise(F.lit("FAIL")))


def compare_runs(a: DataFrame, b: DataFrame, run_a: str, run_b: str) -> DataFrame:
    """A/B snapshot diff: run ids must differ, every fingerprint field equal.

    ``a``/``b`` are :func:`snapshot` outputs; a full outer join on the table
    name makes missing tables fail too.
    """
    fields = ["rows", "columns", "schema_sha", "content_sha"]
    la = a.select("table", *[F.col(c).alias(f"a_{c}") for c in fields])
    lb = b.select("table", *[F.col(c).alias(f"b_{c}") for c in fields])
    j = la.join(lb, "table", "full_outer")
    checks = F.array(*[F.struct(F.lit(c).alias("check"), F.col(f"a_{c}").cast("string").alias("run_a"),
                                F.col(f"b_{c}").cast("string").alias("run_b"),
                                F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")).alias("equal")) for c in fields])
    out = j.select("table", F.inline(checks))
    out = out.withColumn("status", F.when(F.col("equal") & F.col("run_a").isNotNull(), F.lit("PASS"))
                         .otherwise(F.lit("FAIL")))
    runs = a.sparkSession.range(1).select(F.lit("*run*").alias("table"), F.lit("run_id").alias("check"),
                                          F.lit(run_a).alias("run_a"), F.lit(run_b).alias("run_b"),
                                          F.lit(run_a == run_b).alias("equal"),
                                          F.lit("FAIL" if run_a == run_b else "PASS").alias("status"))
    return runs.unionByName(out)


#: Parts in which written rows are compared with their source.
BUCKETS = 256


def verify_write(src: DataFrame, written: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Post-write equivalence — columns in order, types, rows, and the
    multiset of rows both ways.

    Digests by bucket are compared first: equal tables cost one aggregate over
    each and shuffle no row.  Only rows of buckets that differ are compared
    with each other (``exceptAll``), and counted.
    """
    spark = src.sparkSession
    same_cols = src.columns == written.columns
    same_types = sorted(src.dtypes) == sorted(written.dtypes)
    checks = [("columns", same_cols), ("types", same_types)]
    if sorted(src.columns) == sorted(written.columns) and same_types:
        cols = sorted(src.columns)
        a, b = src.select(*cols), written.select(*cols)
        which = differing_buckets(a, b, buckets)
        missing = extra = 0
        if which:
            x, y = in_buckets(a, which, buckets), in_buckets(b, which, buckets)
            missing, extra = x.exceptAll(y).count(), y.exceptAll(x).count()
        checks += [("rows", missing == extra), ("missing_in_written", missing == 0), ("extra_in_written", extra == 0)]
    base = spark.createDataFrame(checks, "check string, ok boolean")
    return base.withColumn("status", F.when(F.col("ok"), F.lit("PASS")).otherwise(F.lit("FAIL")))
