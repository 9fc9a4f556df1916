"""Reshape, set, series and aggregate operators on inline fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from mensura.operators import aggregates as A
from mensura.operators import reshape as P
from mensura.operators import series as S
from mensura.operators import sets as U

D = dt.date


def test_unpivot_months_cutoff_and_nulls(spark):
    cols = [f"m{i:02d}" for i in range(1, 13)]
    rows = [(2025, *[float(i) for i in range(1, 13)]), (2026, 1.0, None, 3.0, *[None] * 9)]
    df = spark.createDataFrame(rows, ["year", *cols])
    out = P.unpivot_months(df, "year", cols, cutoff="2026-02-01").orderBy("period_date").collect()
    assert len(out) == 13  # 12 months of 2025 + Jan 2026; Feb is NULL, Mar after cutoff
    assert out[-1]["period_date"] == D(2026, 1, 1) and out[-1]["value"] == 1.0


def test_pivot_unpivot_identity(spark):
    cols = [f"m{i:02d}" for i in range(1, 13)]
    long = spark.createDataFrame([(2025, m, float(m) * 10) for m in range(1, 13)], "year int, month int, v double")
    wide = P.pivot_months(long, "year", "month", "v", cols, total_col="total")
    assert wide.first()["total"] == sum(m * 10.0 for m in range(1, 13))
    back = P.unpivot_months(wide.drop("total"), "year", cols, value_col="v")
    assert sorted((r["month"], r["v"]) for r in back.collect()) == [(m, m * 10.0) for m in range(1, 13)]


def test_apply_types_audit(spark):
    df = spark.createDataFrame([("1,234", "2025", "01/05/2026"), ("x", "2025.7", None), (None, "y", "bad")],
                               "a string, b string, c string")
    typed, audit = P.apply_types(df, [("a", "double"), ("b", "int"), ("c", "date")])
    assert typed.columns == ["a", "b", "c"]
    got = {r["column"]: (r["non_null_source"], r["failures"]) for r in audit.collect()}
    assert got == {"a": (2, 1), "b": (3, 1), "c": (2, 1)}


def test_reconcile_states(spark):
    direct = spark.createDataFrame([(D(2025, 1, 1), 10.0, 100.0), (D(2025, 2, 1), 10.0, 150.0),
                                    (D(2025, 3, 1), 10.0, 100.0)],
                                   "period_date date, qty_direct double, value_direct double")
    matrix = spark.createDataFrame([(D(2025, 1, 1), 10.0, 100.0), (D(2025, 2, 1), 10.0, 100.0),
                                    (D(2024, 12, 1), 9.0, 90.0)],
                                   "period_date date, qty_matrix double, value_matrix double")
    r = S.reconcile(direct, matrix, "period_date", ["qty", "value"], 1.0, 1e-9)
    got = {row["period_date"]: (row["reconciliation_state"], row["value"], row["source_value"]) for row in r.collect()}
    assert got[D(2025, 1, 1)] == ("COINCIDE", 100.0, "direct")
    assert got[D(2025, 2, 1)] == ("DIFIERE_PRIORIZA_DIRECTO", 150.0, "direct")
    assert got[D(2025, 3, 1)] == ("SOLO_DIRECTO", 100.0, "direct")
    assert got[D(2024, 12, 1)] == ("SOLO_MATRIZ", 90.0, "matrix")


def test_growth_by_shift_missing_month(spark):
    df = spark.createDataFrame([(D(2025, 1, 1), 10.0), (D(2025, 3, 1), 30.0), (D(2025, 4, 1), 60.0)],
                               "period_date date, v double")
    out = {r["period_date"]: r["mom_v"] for r in
           S.growth_by_shift(df, "period_date", ["v"], 1, "_prev", "mom_").collect()}
    assert out == {D(2025, 1, 1): None, D(2025, 3, 1): None, D(2025, 4, 1): 1.0}


def test_growth_by_year_complete_only(spark):
    df = spark.createDataFrame([(2023, 10.0, True), (2024, 20.0, True), (2025, 5.0, False)],
                               "year int, v double, complete boolean")
    out = {r["year"]: r["yoy_v"] for r in S.growth_by_year(df, "year", ["v"], complete_col="complete").collect()}
    assert out == {2023: None, 2024: 1.0, 2025: None}


def test_lag_growth_guards(spark):
    df = spark.createDataFrame([("a", 2020, 10.0), ("a", 2022, 20.0), ("a", 2023, 40.0), ("b", 2022, 0.0),
                                ("b", 2023, 5.0)], "k string, year int, v double")
    out = {(r["k"], r["year"]): (r["yoy_v"], r["v_prev"]) for r in
           S.lag_growth(df, ["k"], "year", ["v"], keep_lag="_prev").collect()}
    assert out[("a", 2022)] == (None, 10.0)  # not consecutive: no growth, raw lag kept
    assert out[("a", 2023)] == (1.0, 20.0)
    assert out[("b", 2023)] == (None, 0.0)  # previous is zero


def test_share_and_rank(spark):
    df = spark.createDataFrame([("p", "a", 1.0), ("p", "b", 3.0), ("p", "c", 3.0), ("q", "a", 0.0)],
                               "per string, code string, v double")
    s = S.share_of(df, ["per"], "v", "share")
    r = S.rank_in(s, ["per"], "v", "code", "rk")
    got = {(x["per"], x["code"]): (x["share"], x["rk"]) for x in r.collect()}
    assert got[("p", "b")] == (3 / 7, 1) and got[("p", "c")] == (3 / 7, 2) and got[("p", "a")][1] == 3
    assert got[("q", "a")] == (None, 1)  # zero total: no share
    d = S.rank_in(df, ["per"], "v", "code", "rk", method="dense_rank")
    assert {x["code"]: x["rk"] for x in d.filter("per = 'p'").collect()} == {"b": 1, "c": 2, "a": 3}


def test_sets(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (3, "z")], "k int, v string")
    d = {(r["k"], r["side"]): r["copies"] for r in U.diff(a, b).collect()}
    assert d == {(1, "only_left"): 1, (2, "only_left"): 1, (3, "only_right"): 1}
    raw = spark.createDataFrame([(1, "x"), (1, "x"), (None, None), (2, "y")], "k int, v string")
    out, audit = U.dedup(raw)
    assert out.count() == 2
    assert audit.first().asDict() == {"initial_rows": 4, "empty_removed": 1, "duplicates_removed": 1,
                                      "final_rows": 2}
    cal = spark.createDataFrame([(D(2025, 1, 1),), (D(2025, 4, 1),)], "period_date date")
    assert sorted(r[0] for r in U.calendar_gaps(cal, "period_date").collect()) == [D(2025, 2, 1), D(2025, 3, 1)]
    cov = U.coverage(spark.createDataFrame([("a",), ("b",)], "c string"),
                     spark.createDataFrame([("b",), ("z",)], "c string"), "c")
    assert {(r["c"], r["issue"]) for r in cov.collect()} == {("a", "code_without_label"), ("z", "label_without_code")}


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 3.0), ("b", 2, None)], "k string, g int, v double")
    assert {r["column"]: r["nulls"] for r in A.null_cells(df).collect()} == {"k": 0, "g": 0, "v": 1}
    assert A.duplicate_keys(df, ["k", "g"]).collect()[0]["count"] == 2
    t = {r["k"]: r["n"] for r in A.totals(df, "k", {"n": F.count(F.lit(1))}).collect()}
    assert t == {"a": 2, "b": 1, "TOTAL": 3}
    assert A.latest_row(df.fillna(0.0), "v", ["k", "v"]).first().asDict() == {"k": "a", "v": 3.0}
    c = A.conservation(df, df.filter("k = 'a'"), ["v"], [1e-6]).first()
    assert c["conserved"] and c["sum_source"] == 5.0


def test_contract_pivots_and_lookups(spark):
    df = spark.createDataFrame([("TOTAL X", "a", 2025, "dolares", 1.0), ("PERU", "a", 2025, "dolares", 2.0),
                                ("PERU", "a", 2025, "libras", 3.0), (" ", "a", 2025, "libras", 9.0)],
                               "label string, cut string, year int, unit string, v double")
    kept = P.drop_labels(df, "label")
    assert {r["label"] for r in kept.collect()} == {"PERU"}
    wide = P.pivot_units(kept, ["label", "year"], "unit", "v", ["dolares", "libras"]).first()
    assert (wide["dolares"], wide["libras"]) == (2.0, 3.0)
    ind = spark.createDataFrame([("PERU", "variacion_dolares", 0.1), ("PERU", "otro", 9.0)],
                                "d string, i string, v double")
    p = P.pivot_indicators(ind, "d", "i", "v", ["variacion_dolares"], ["growth"]).first()
    assert p["growth"] == 0.1
    c = P.to_contract(spark.createDataFrame([(1, "x")], "a int, b string"), {"b": "name", "a": "id"},
                      ["id", "name"])
    assert c.columns == ["id", "name"]
    cal = P.enrich_calendar(spark.createDataFrame([(D(2025, 7, 1), 10.0, 2.0)], "d date, fob double, tm double"),
                            "d", ("price", "fob", "tm", 1000.0)).first()
    assert cal["semester"] == 2 and cal["quarter"] == 3 and cal["price"] == 10.0 / 2000.0
    assert P.until(spark.createDataFrame([(D(2025, 1, 1),), (D(2026, 1, 1),)], "d date"), "d", "2025-06-01").count() == 1
    fact = spark.createDataFrame([("PERU", 1.0), ("CHILE", 2.0)], "dest string, v double")
    dim = spark.createDataFrame([("PERU", "k1")], "dest string, dest_key string")
    got = {r["dest"]: r["dest_key"] for r in S.lookup_key(fact, dim, "dest", "dest_key").collect()}
    assert got == {"PERU": "k1", "CHILE": None}
    assert S.denormalise(fact, dim, "dest").count() == 1
    assert S.attach(fact, dim, ["dest"]).count() == 2
    assert [r["dest"] for r in S.fk_orphans(fact, dim, "dest").collect()] == ["CHILE"]
