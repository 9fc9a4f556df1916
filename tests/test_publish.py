"""Write-audit-publish (K17): metrics of the write, the gate, publishing."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from mensura.operators.quality import CRITICAL, Rule, evaluate, share_range_rule
from mensura.plans import refined_a as A
from mensura.sinks import publish as P
from mensura.sinks.tables import append_run, run_record


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


@pytest.fixture(scope="module")
def good(spark):
    return A.run(A.report_cells(spark, SMALL), "k17_gate", {"run": "one", "quoted": "it's \\ here"})


def faulty(spark, change, where):
    c = A.report_cells(spark, SMALL)
    return c.withColumn("value", F.when(F.expr(where), F.lit(change)).otherwise(F.col("value")))


def test_metrics_equal_separate_counts(spark, good):
    own = [f"c{i}" for i in range(1, A.WIDTH + 1)]
    raw = A.C.read_ranges(A.report_cells(spark, SMALL), A.CONTRACTS)
    clean = raw.select("id_table", *[A._cleaned(i).alias(c) for i, c in enumerate(own, 1)])
    for name in ("market_month", "matrix_qty"):
        t = clean.filter(F.col("id_table") == A.ID[name])
        full = t.dropna(how="all", subset=own)
        m = good.rows.metrics
        assert m[f"{name}.rows_initial"] == t.count()
        assert m[f"{name}.rows_empty"] == t.count() - full.count()
        assert m[f"{name}.rows_repeated"] == full.count() - full.distinct().count()
        assert m[f"{name}.rows_refined"] == full.distinct().count() == A.typed(good.rows.rows, name).count()
        final = good.tables[name]
        assert final.metrics["rows"] == final.rows.count()
        assert final.metrics["null_cells"] == sum(final.rows.filter(F.col(f"`{c}`").isNull()).count() for c in final.rows.columns)


def test_observed_write_scans_once(spark, good):
    t = good.tables["monthly"].rows
    watched, _ = P.watched(t, P.table_metrics(t))
    assert scans(watched) == scans(t) == 1


def test_null_observations_are_counted(spark):
    cells = faulty(spark, "N/A", "sheet = 'VALOR' AND row IN (6, 7) AND col IN (3, 4)")
    rows = A.refined_rows(cells)
    m = A.final_tables(rows.rows)["matrix_value"].metrics
    assert m["null_observations"] == 4 and m["rows"] == m["rows_before_null_filter"] - 4


def test_bad_tokens_are_counted_as_failures(spark):
    m = A.refined_rows(faulty(spark, "12x", "sheet = 'CANTIDAD' AND row = 6 AND col = 5")).metrics
    assert m["matrix_qty.m04.failures"] == 1 and m["matrix_qty.m04.non_null_source"] == m["matrix_qty.m05.non_null_source"]
    assert sum(v for k, v in m.items() if k.endswith(".failures")) == 1


FAULTS = [
    ("A2_total_equals_months", "matrix_value", "1.5", "sheet = 'VALOR' AND row = 6 AND col = 14"),
    ("A1_value_non_negative", "matrix_qty", "-5", "sheet = 'CANTIDAD' AND row = 6 AND col = 3"),
    ("A3_reported_price", "monthly", "1.0", "sheet = 'RESUMEN' AND row = 12 AND col = 31"),
    ("A4_stored_growth_qty", "history_month", "0.9", "sheet = 'RESUMEN' AND row = 238 AND col = 31"),
    ("A5_share_in_range", "market_month", "-0.1", "sheet = 'MERCADO' AND row = 14 AND col = 8"),
    ("A4b_market_growth_value", "market_cumulative", "7", "sheet = 'MERCADO ACUM' AND row = 13 AND col = 6"),
    ("A6_market_key_unique", "market_cumulative", "NATION_1", "sheet = 'MERCADO ACUM' AND row IN (13, 14) AND col = 1"),
    ("A6_period_key_unique", "monthly", "1999-01-01", "sheet = 'RESUMEN' AND row IN (12, 13) AND col = 28"),
]


def test_each_rule_fires_on_its_fault(spark):
    cells = A.report_cells(spark, SMALL)
    for _, _, change, where in FAULTS:
        cells = cells.withColumn("value", F.when(F.expr(where), F.lit(change)).otherwise(F.col("value")))
    rows = A.refined_rows(cells)
    found = {(r["rule"], r["table"]): r for r in A.rules(rows.rows, A.final_tables(rows.rows)).collect()}
    for rule, table, _, _ in FAULTS:
        assert found[rule, table]["status"] == "FAIL" and found[rule, table]["violations"] >= 1, (rule, table)
    assert sum(r["status"] == "FAIL" for r in found.values()) < len(found) / 2


def test_a_failing_rule_leaves_the_published_tables(spark, good):
    before = {n: (P.published_folder(spark, name), sorted(map(str, spark.table(name).collect()))) for n, name in good.names.items()}
    with pytest.raises(RuntimeError, match="matrix_value.A2_total_equals_months=1"):
        A.run(faulty(spark, *FAULTS[0][2:]), "k17_gate", {"run": "two"})
    after = {n: (P.published_folder(spark, name), sorted(map(str, spark.table(name).collect()))) for n, name in good.names.items()}
    assert before == after


def test_publishing_replaces_rows_schema_and_lineage(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS k17_again")
    one = P.stage(spark.range(3), "t")
    two = P.stage(spark.range(5).withColumn("x", F.lit("a")), "t")
    ok = evaluate(two.rows, "t", [Rule("r", CRITICAL, F.col("id") < 0)])
    P.publish({"k17_again.t": one}, ok, {"run": "one"})
    first = P.published_folder(spark, "k17_again.t")
    P.publish({"k17_again.t": two}, ok, {"run": "it's \\ two"})
    assert spark.table("k17_again.t").columns == ["id", "x"] and spark.table("k17_again.t").count() == 5
    props = {r["key"]: r["value"] for r in P.layer_properties(spark, "l", {"t": "k17_again.t"}).collect()}
    assert props["run"] == "it's \\ two" and props[P.VERSION] == two.folder
    P.retire(spark, [first, None])
    assert spark.table("k17_again.t").count() == 5
    with pytest.raises(Exception):
        one.rows.count()


def test_share_scales_and_no_share(spark):
    def rule(*values):
        r = share_range_rule(spark.createDataFrame([(v,) for v in values], "s double"), "t", "A5", "s").first()
        return r["severity"], r["status"], r["checked"], r["violations"]

    assert rule(0.0, 1.0, None) == (CRITICAL, "PASS", 2, 0)
    assert rule(0.5, 1.2) == (CRITICAL, "PASS", 2, 0)  # percentages
    assert rule(0.5, 101.0, -1.0) == (CRITICAL, "FAIL", 3, 2)
    assert rule(None) == rule() == ("WARNING", "PASS", 0, 0)


def test_run_log_holds_the_audit_once(spark, good, tmp_dir):
    rec = run_record(spark, "run-1", "refined", good.rules, {"a": 1}, {"input": "x"}, "2026-01-01T00:00:00+00:00", good.rows.metrics)
    got = append_run(spark, tmp_dir + "/log", rec).first()
    assert float(got["duration_seconds"]) > 0 and got["status"] == "OK" and len(json.loads(got["rules"])) == good.rules.count()
    assert json.loads(got["metrics"])["monthly.rows_initial"] == 200
    append_run(spark, tmp_dir + "/log", {**rec, "layer": "gold"})
    with pytest.raises(RuntimeError, match="holds 2 records"):
        append_run(spark, tmp_dir + "/log", rec)
