"""Remaining small operators: refined gate (S18), lineage link (R3), config
hash (R5), schema contract (R7), O19/O26/O27, F3 audit, L5, U8, manifests scan."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from mensura import functions as M
from mensura.operators import aggregates as A
from mensura.operators import audit as R
from mensura.operators import reshape as P
from mensura.operators import sets as U
from mensura.sinks import tables as W
from mensura.sources import manifests as MF
from mensura.sources.refined import open_refined

D = dt.date


def test_refined_gate(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    W.write_verified(df, "refined_gate_t", {"layer": "silver", "run_id": "r1", "input_sha256": "abc"})
    t, checks = open_refined(spark, "refined_gate_t", ["k", "v"], {"layer": "silver"})
    assert t is not None and {r["status"] for r in checks.collect()} == {"PASS"}
    _, bad = open_refined(spark, "refined_gate_t", ["v", "k"], {"layer": "gold"})
    assert {r["check"] for r in bad.filter("status = 'FAIL'").collect()} == {"columns", "property:layer"}
    none, missing = open_refined(spark, "no_such_table", ["k"], {})
    assert none is None and missing.first()["status"] == "FAIL"


def test_lineage_hash_schema(spark):
    props = spark.createDataFrame([("silver", "s1", "run_id", "R1"), ("gold", "g1", "silver_run_id", "R1"),
                                   ("gold", "g2", "silver_run_id", "R0"), ("gold", "g1", "input_sha256", "x")],
                                  "layer string, table string, key string, value string")
    link = {r["table"]: (r["linked"], r["input_matches"]) for r in
            R.lineage_link(props, "silver", "gold", "silver_run_id", expected_input="x").collect()}
    assert link == {"g1": (True, True), "g2": (False, None)}
    assert R.config_hash({"b": 1, "a": [1, 2]}) == R.config_hash({"a": [1, 2], "b": 1})
    assert R.config_hash({"a": 1}) != R.config_hash({"a": 2})
    df = spark.createDataFrame([(1, "x")], "fecha int, pais string")
    st = {(r["column"], r["kind"]): r["status"] for r in
          R.check_schema(df, "t", required=["fecha"], forbidden=["pais"]).collect()}
    assert st == {("fecha", "required"): "PASS", ("pais", "forbidden"): "FAIL"}


def test_small_scalars_and_audits(spark):
    df = spark.createDataFrame([("ene-may 2025", 2025, D(2025, 1, 1))], "p string, y int, d date")
    r = df.select(M.year_from_text("p").alias("a"), M.cut_date("y").alias("b"),
                  M.shift_months("d", 12).alias("c"), M.shift_months("d", 1).alias("e")).first()
    assert (r["a"], r["b"], r["c"], r["e"]) == (2025, D(2025, 5, 1), D(2026, 1, 1), D(2025, 2, 1))
    obs = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    assert P.null_obs_audit(obs, "v").first().asDict() == {"rows": 3, "null_obs": 1, "kept_obs": 2}
    assert P.drop_null_obs(obs, "v").count() == 2
    assert A.is_empty(obs.filter("v > 10")) and not A.is_empty(obs)
    a = spark.createDataFrame([(D(2025, 1, 1),)], "period_date date")
    b = spark.createDataFrame([(D(2025, 1, 1),), (D(2025, 5, 1),)], "period_date date")
    assert U.date_spine(a, b).count() == 2
    assert P.drop_all_null(spark.createDataFrame([(None, None), (1, None)], "a int, b int")).count() == 1


def test_read_manifests_and_selection(spark, tmp_dir):
    man = {"manifest_schema_version": "1", "storage_layout_version": "v2", "source": "src_a", "batch_id": "b1",
           "files": [{"source": "src_a", "source_url": "https://x/informe mayo 2025.xlsx", "anchor_text": "Mayo",
                      "original_filename": "informe mayo 2025.xlsx", "document_year": 2025, "extension": ".xlsx",
                      "status": "downloaded", "stored_path": "/raw/a.xlsx", "sha256": "h1"},
                     {"source": "src_a", "source_url": "https://x/informe abril 2025.xlsx", "anchor_text": "Abril",
                      "original_filename": "informe abril 2025.xlsx", "document_year": 2025, "extension": ".xlsx",
                      "status": "failed", "stored_path": None, "sha256": None}]}
    os.makedirs(os.path.join(tmp_dir, "m"))
    for name, layout in [("run_2025_06.json", "v2"), ("run_2025_07.json", "v1")]:
        with open(os.path.join(tmp_dir, "m", name), "w") as fh:
            json.dump({**man, "storage_layout_version": layout}, fh)
    ms = MF.read_manifests(spark, os.path.join(tmp_dir, "m"))
    latest = MF.latest_manifest(ms, layout="v2").first()
    assert latest["manifest_name"] == "run_2025_06.json"
    recs = ms.filter(F.col("manifest_name") == latest["manifest_name"]).select(F.explode("files").alias("f")) \
        .select("f.*")
    el = MF.eligible_records(recs)
    assert [(r["document_year"], r["document_month"]) for r in el.collect()] == [(2025, 5)]
    chosen = MF.require_single_content(MF.select_period(el)).first()
    assert chosen["distinct_sha"] == 1 and not chosen["ambiguous"] and chosen["stored_path"] == "/raw/a.xlsx"


def test_run_record(spark, tmp_dir):
    rules = spark.createDataFrame([("r1", "PASS"), ("r2", "WARN"), ("r3", "PASS")], "rule string, status string")
    rec = W.run_record(spark, "run-7", "gold", rules, {"tol": 1e-6}, {"silver_run_id": "run-6"})
    assert (rec["rules_pass"], rec["rules_warn"], rec["rules_fail"], rec["status"]) == (2, 1, 0, "OK")
    back = W.append_run(spark, os.path.join(tmp_dir, "log"), rec)
    row = back.first()
    assert row["config_sha256"] == R.config_hash({"tol": 1e-6}) and row["layer"] == "gold"


def test_materialize_in_checkpoint_folder(spark):
    from mensura.session import checkpoint_dir, materialize

    base = checkpoint_dir(spark).split(":", 1)[-1].lstrip("/")
    df = spark.range(5).selectExpr("id * 2 AS v")
    out = materialize(df)
    assert out.inputFiles() and all(base in f for f in out.inputFiles())
    assert materialize(spark.range(5).selectExpr("id * 2 AS v")) is out  # same plan: written once
    assert sorted(r["v"] for r in out.collect()) == [0, 2, 4, 6, 8]
