"""Rule registry (mutation tests), fingerprints (invariance + brute force),
sinks (write/verify/lineage/export/run log/compaction) and the stream."""

import datetime
import hashlib
import math
import os
import random

from pyspark.sql import functions as F

from mensura.functions.hashing import canonical_text
from mensura.operators import audit as R
from mensura.operators import quality as Q
from mensura.sinks import tables as W


def _fixture(spark):
    return spark.createDataFrame([(1, "0306", 10.0, 1000.0), (2, "0306", 0.0, 0.0), (3, "0306", 5.0, 10.0)],
                                 "k int, code string, tm double, fob double")


def rules():
    return [
        Q.Rule("non_negative", Q.CRITICAL, (F.col("tm") < 0) | (F.col("fob") < 0)),
        Q.Rule("code_4_digits", Q.CRITICAL, ~F.col("code").rlike("^[0-9]{4}$")),
        Q.Rule("zero_reported", Q.WARNING, F.col("tm") == 0),
    ]


def _status(df):
    return {r["rule"]: (r["status"], r["violations"]) for r in df.collect()}


def test_rules_one_job_and_statuses(spark):
    base = _status(Q.evaluate(_fixture(spark), "t", rules()))
    assert base == {"non_negative": ("PASS", 0), "code_4_digits": ("PASS", 0), "zero_reported": ("WARN", 1)}


def test_rule_mutations_flip_exactly_one(spark):
    df = _fixture(spark)
    mutations = {
        "non_negative": df.withColumn("tm", F.when(F.col("k") == 1, -1.0).otherwise(F.col("tm"))),
        "code_4_digits": df.withColumn("code", F.when(F.col("k") == 3, "306").otherwise(F.col("code"))),
    }
    for rule, mutated in mutations.items():
        st = _status(Q.evaluate(mutated, "t", rules()))
        failing = {k for k, (s, _) in st.items() if s == "FAIL"}
        assert failing == {rule}


def test_grouped_rules_and_gate(spark):
    df = _fixture(spark).unionByName(_fixture(spark).limit(1))
    res = Q.union_results([Q.unique_rule(df, "t", "key_unique", ["k"]),
                           Q.partition_sum_rule(df.withColumn("s", F.lit(0.5)), "t", "sums", ["code"], "s",
                                                1.0, 1e-8),
                           Q.not_empty_rule(df, "t", "not_empty")])
    st = _status(res)
    assert st["key_unique"] == ("FAIL", 1) and st["not_empty"] == ("PASS", 0) and st["sums"][0] == "FAIL"
    try:
        Q.gate(res)
        raise AssertionError("gate should raise")
    except RuntimeError as e:
        assert "key_unique" in str(e)


def _plain_text(df, row):
    """The typed row text, written in Python."""
    def value(v, kind):
        if v is None:
            return "~"
        if kind == "double":
            m, e = math.frexp(abs(v))  # m in [0.5, 1)
            body = "nan" if v != v else "inf" if abs(v) == math.inf else "0" if abs(v) < 1e-300 else f"{int(m * 2 ** 53)}e{e - 1}"
            return "F" + ("-" if v < 0 and body != "0" else "") + body
        if kind == "string":
            return f"S{len(v)}:{v}"
        return {"boolean": lambda: f"B{int(v)}", "date": lambda: f"D{v}"}.get(kind, lambda: f"I{v}")()

    return "|".join(value(row[c], t) for c, t in sorted(df.dtypes))


def _brute(df):
    """Reference combination computed in Python."""
    rows = [_plain_text(df, r) for r in df.collect()]
    hs = [hashlib.sha256(x.encode()).hexdigest() for x in rows]
    s1 = sum(int(h[:15], 16) for h in hs)
    s2 = sum(int(h[15:30], 16) for h in hs)
    return hashlib.sha256(f"{len(rows)}:{s1}:{s2}".encode()).hexdigest()


def test_fingerprint_invariance_and_brute_force(spark):
    df = spark.createDataFrame([(i, f"x{i % 7}", i * 0.5, None if i % 5 else "n") for i in range(200)],
                               "a int, b string, c double, d string")
    fp = R.fingerprint(df, "t").first()
    assert fp["content_sha"] == _brute(df)
    shuffled = df.repartition(9).select("d", "c", "b", "a")
    assert R.fingerprint(shuffled, "t").first()["content_sha"] == fp["content_sha"]
    assert R.fingerprint(shuffled, "t").first()["schema_sha"] == fp["schema_sha"]
    dup = df.unionByName(df.limit(1))
    assert R.fingerprint(dup, "t").first()["content_sha"] != fp["content_sha"]


def test_doubles_by_their_exact_value(spark):
    values = [0.0, -0.0, 1.0, -1.0, 0.1, 1 / 3, 2.0 ** 60, 2.0 ** 60 - 128, 123456789.12, 1e300, 1e-290, 5e-324, 0.9999999999999999, 1.9999999999999998,
              math.inf, -math.inf, math.nan, None] + [random.Random(4).uniform(-1, 1) * 10.0 ** k for k in range(-30, 30)]
    df = spark.createDataFrame([(v, str(i), datetime.date(2020, 1, 1 + i % 28), i % 2 == 0) for i, v in enumerate(values)], "x double, s string, d date, b boolean")
    got = {r["s"]: r["t"] for r in df.select("s", canonical_text(df).alias("t")).collect()}
    assert got == {r["s"]: _plain_text(df, r) for r in df.collect()}


def test_written_rows_are_compared_by_bucket(spark):
    df = spark.range(2000).selectExpr("id", "concat('v', id % 50) AS v", "id / 7.0D AS x", "IF(id % 9 = 0, null, id) AS n")
    again = df.repartition(5)
    assert R.differing_buckets(df, again, 64) == []
    assert "Except" not in R.bucket_digests(df, 64)._jdf.queryExecution().optimizedPlan().toString()
    assert {r["status"] for r in R.verify_write(df, again).collect()} == {"PASS"}
    changed = df.withColumn("x", F.when(F.col("id") == 777, -1.0).otherwise(F.col("x")))
    assert 1 <= len(R.differing_buckets(df, changed, 64)) <= 2
    assert {r["check"] for r in R.verify_write(df, changed).filter("NOT ok").collect()} == {"missing_in_written", "extra_in_written"}
    twice = df.unionByName(df.filter("id = 5"))
    assert {r["check"] for r in R.verify_write(df, twice).filter("NOT ok").collect()} == {"rows", "extra_in_written"}
    assert {r["check"] for r in R.verify_write(df, df.select("v", "id", "x", "n")).filter("NOT ok").collect()} == {"columns"}
    assert {r["check"] for r in R.verify_write(df, df.drop("n")).filter("NOT ok").collect()} == {"columns", "types"}
    nothing = df.limit(0)
    assert {r["status"] for r in R.verify_write(nothing, nothing).collect()} == {"PASS"}


def test_compare_runs(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    a = R.snapshot({"t": df})
    res = R.compare_runs(a, R.snapshot({"t": df.repartition(3)}), "A", "B")
    assert {r["status"] for r in res.collect()} == {"PASS"}
    bad = R.compare_runs(a, R.snapshot({"t": df.withColumn("v", F.lit("b"))}), "A", "A")
    assert {(r["table"], r["check"]) for r in bad.filter("status = 'FAIL'").collect()} == \
        {("*run*", "run_id"), ("t", "content_sha")}


def test_write_verify_lineage(spark, tmp_dir):
    df = _fixture(spark)
    checks = W.write_verified(df, "t_fixture", {"layer": "gold", "run_id": "r1", "note": "it's"})
    assert {r["status"] for r in checks.collect()} == {"PASS"}
    props = {r["key"]: r["value"] for r in W.get_lineage(spark, "t_fixture").collect()}
    assert props["run_id"] == "r1" and props["note"] == "it's"
    lay = spark.createDataFrame([("gold", "t_fixture", k, v) for k, v in
                                 [("run_id", "r1"), ("pipeline_version", "2"), ("input_sha256", "abc")]],
                                "layer string, table string, key string, value string")
    assert {r["status"] for r in R.layer_consistency(lay).collect()} == {"PASS"}


def test_export_run_log_compaction(spark, tmp_dir):
    df = _fixture(spark)
    res = W.export_flat(df, os.path.join(tmp_dir, "exp"), ["k"], allowed=("serving",), name="serving").first()
    assert res["status"] == "PASS" and res["rows"] == 3
    back = W.append_run(spark, os.path.join(tmp_dir, "runlog"), {"run_id": "r9", "layer": "gold", "status": "OK"})
    assert back.count() == 1
    path = os.path.join(tmp_dir, "tbl")
    spark.range(1000).repartition(12).write.parquet(path)
    assert W.compact_if(spark, path, os.path.join(tmp_dir, "c1"), 100, 10 ** 12)["status"] == "SKIPPED_SMALL_TABLE"
    done = W.compact_if(spark, path, os.path.join(tmp_dir, "c2"), 10, 10 ** 12, zcol="id")
    assert done["status"] == "COMPACTED" and done["files_after"] < done["files"]
    assert spark.read.parquet(os.path.join(tmp_dir, "c2")).count() == 1000


def test_snapshot_classification(spark):
    from pyspark.sql import functions as F

    from mensura.sources.manifests import classify_snapshot

    prev = spark.createDataFrame([("u1", "h1", "v2", "downloaded", "t1"), ("u2", "h2", "v2", "unchanged", "t1"), ("u5", "h5", "v1", "downloaded", "t1"),
                                  ("u6", "h6", "v2", "recovered_copy", "t1"), ("u7", "h7", "v2", "failed", None)],
                                 "source_url string, sha256 string, storage_layout_version string, status string, downloaded_at_utc string")
    cur = spark.createDataFrame([("u1", "h1", None), ("u2", "h9", None), ("u3", "h1", None), ("u4", None, "boom"), ("u5", "h5", None), ("u5b", "h5", None),
                                 ("u6", "h0", None), ("u5", "h8", None)], "source_url string, sha256 string, error string")
    got = {(r.source_url, r.sha256): (r.snapshot_status, r.downloaded_at_utc_new) for r in classify_snapshot(prev, cur, F.lit("now"), layout="v2").collect()}
    assert got == {("u1", "h1"): ("unchanged", "t1"), ("u2", "h9"): ("updated_version", "now"),
                   ("u3", "h1"): ("downloaded", "now"),  # known content under a new URL is a new resource
                   ("u4", None): ("failed", "now"), ("u5", "h5"): ("unchanged", "now"),  # stored, but by another layout
                   ("u5b", "h5"): ("downloaded", "now"), ("u6", "h0"): ("downloaded", "now"), ("u5", "h8"): ("downloaded", "now")}


def test_snapshot_index_over_a_history(spark):
    from mensura.sources.manifests import classify_snapshot, snapshot_index, updated_index

    schema = "source_url string, sha256 string, storage_layout_version string, status string, downloaded_at_utc string"
    runs = [[("u1", "h1", "v2", "downloaded", "t1"), ("u2", "a", "v1", "downloaded", "t1"), (None, "z", "v2", "downloaded", "t1")],
            [("u1", "h2", "v2", "updated_version", "t2"), ("u2", "b", "v2", "downloaded", "t2"), ("u3", "c", "v2", "failed", "t2")],
            [("u1", "h3", "v2", "failed", "t3"), ("u2", "d", "v1", "unchanged", "t3")]]
    frames = [spark.createDataFrame(r, schema) for r in runs]
    whole = snapshot_index(frames[0].unionByName(frames[1]).unionByName(frames[2]))
    step = updated_index(updated_index(snapshot_index(frames[0]), frames[1]), frames[2])
    got = sorted(map(tuple, whole.collect()))
    assert got == sorted(map(tuple, step.collect()))
    assert [(r[0], r[1], r[2], r[4]) for r in got] == [("u1", "v2", "h2", "t2"), ("u2", "v1", "d", "t3"), ("u2", "v2", "b", "t2")]
    history = frames[0].unionByName(frames[1]).unionByName(frames[2])
    cur = spark.createDataFrame([("u1", "h1", None), ("u1", "h9", None), ("u2", "b", None)], "source_url string, sha256 string, error string")
    rows = [(r.source_url, r.sha256, r.snapshot_status, r.downloaded_at_utc_new) for r in classify_snapshot(history, cur, F.lit("now"), layout="v2").collect()]
    assert sorted(rows) == [("u1", "h1", "unchanged", "t2"), ("u1", "h9", "updated_version", "now"), ("u2", "b", "unchanged", "t2")]


def test_period_guards_name_what_there_is(spark):
    import pytest

    from mensura.sources.manifests import require_single_content, select_period

    schema = "source string, source_url string, stored_path string, sha256 string, document_year int, document_month int"
    rec = spark.createDataFrame([("s", "u1", "p1", "h1", 2024, 5), ("s", "u2", "p2", "h2", 2024, 5), ("s", "u3", "p3", "h3", 2024, 4), ("s", "u4", "p4", "h4", 2023, None)], schema)
    assert select_period(rec, 2024, 4, guard=True).count() == 1 and select_period(rec, guard=True).count() == 2
    with pytest.raises(Exception, match="period 2025-01: no records; periods found: 2023-[?], 2024-04, 2024-05"):
        select_period(rec, 2025, 1, guard=True).collect()
    with pytest.raises(Exception, match="latest period: no records; periods found: 2023-[?]"):
        select_period(rec.filter("document_month IS NULL"), guard=True).collect()
    with pytest.raises(Exception, match=r"different contents for s 2024-5: 2 hashes, among them h1 \(u1\) and h2 \(u2\)"):
        require_single_content(select_period(rec), guard=True).collect()
    assert require_single_content(select_period(rec, 2024, 4), guard=True).first()["sha256"] == "h3"
    assert require_single_content(select_period(rec)).first()["ambiguous"]


def test_release_forgets_staged_tables(spark):
    from mensura.session import materialize, release

    one = materialize(spark.range(7).selectExpr("id * 2 AS x"))
    assert one.count() == 7 and materialize(spark.range(7).selectExpr("id * 2 AS x")) is one
    release(spark)
    assert materialize(spark.range(7).selectExpr("id * 2 AS x")) is not one
