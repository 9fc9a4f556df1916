"""Ranks, one-pass key rules, the cross-table contract and the technical suite."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mensura.operators import audit as R
from mensura.operators import quality as Q
from mensura.operators.series import rank_in, ranked_in, shares_of
from mensura.sinks import publish as P

RULE = ["rule", "status", "checked", "violations"]


def by_rule(df):
    return {r["rule"]: tuple(r[c] for c in RULE[1:]) for r in df.select(*RULE).collect()}


@pytest.fixture(scope="module")
def measured(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None, "hot", "hot", "hot"]), rnd.choice([None, 1.0, 2.0, 2.0, float("nan"), -3.5, float(rnd.randint(0, 300))]), f"t{rnd.randint(0, 400):03d}")
            for _ in range(4000)]
    return spark.createDataFrame(rows, "p string, m double, tie string")


def test_ranks_equal_one_window(measured):
    w = Window.partitionBy("p").orderBy(F.col("m").desc_nulls_last(), F.col("tie").asc())
    got = rank_in(measured, ["p"], "m", "tie", "r", method="dense_rank")
    want = measured.withColumn("r", F.dense_rank().over(w).cast("int"))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    once = measured.dropDuplicates()
    got = rank_in(once, ["p"], "m", "tie", "r")
    want = once.withColumn("r", F.row_number().over(w).cast("int"))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert rank_in(measured.limit(0), ["p"], "m", "tie", "r").count() == 0


def test_a_hot_period_is_ranked_in_many_ranges(spark, monkeypatch):
    from mensura.operators import series as S

    monkeypatch.setattr(S, "RANK_SAMPLE", 256)
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("p"),
                                  (F.col("id") % 977).cast("double").alias("m"), F.col("id").cast("string").alias("tie"))
    m = F.col("m")
    key = F.struct(m.isNull().alias("none"), (-m).alias("down"), F.col("tie").alias("tie"))
    ranged = S._with_range(df, key, df, "r").filter("p = 'hot'").groupBy("r").count().collect()
    assert len(ranged) >= 16 and max(r["count"] for r in ranged) < 200
    two = ranked_in(df, ["p"], {"a": ("m", "tie"), "b": ("m", "tie")})
    assert two.filter("a <> b").count() == 0 and two.filter("p = 'hot'").agg(F.max("a")).first()[0] == 1000


def test_shares_of_several_measures(spark):
    df = spark.createDataFrame([("a", 1.0, 3.0), ("a", 3.0, None), ("b", 0.0, 2.0)], "p string, x double, y double")
    got = sorted(map(tuple, shares_of(df, df, ["p"], {"sx": "x", "sy": "y"}).collect()), key=str)
    assert got == [("a", 1.0, 3.0, 0.25, 1.0), ("a", 3.0, None, 0.75, None), ("b", 0.0, 2.0, None, 1.0)]


def test_key_rules_in_one_pass(spark):
    fact = spark.createDataFrame([(1, "x", 2020), (2, "x", 2020), (9, "x", 2021), (None, "y", 2021), (1, "x", 2020)], "k int, c string, y int")
    dim, cuts = spark.createDataFrame([(1,), (2,), (None,)], "id int"), spark.createDataFrame([("x",), ("x",)], "cut string")
    rules = Q.key_rules(fact, "f", {"fk": ("k", dim, "id"), "fc": ("c", cuts, "cut")}, ("grain", ["k", "c", "y"]))
    assert by_rule(rules) == {"fk": ("FAIL", 5, 2), "fc": ("FAIL", 5, 1), "grain": ("FAIL", 5, 1)}
    assert by_rule(Q.key_rules(fact.filter("k < 3").distinct(), "f", {"fk": ("k", dim, "id"), "fc": ("c", cuts, "cut")}, ("grain", ["k", "c", "y"]))) == {
        "fk": ("PASS", 2, 0), "fc": ("PASS", 2, 0), "grain": ("PASS", 2, 0)}
    assert by_rule(Q.key_rules(fact.limit(0), "f", {"fk": ("k", dim, "id")}, ("grain", ["k"]))) == {"fk": ("PASS", 0, 0), "grain": ("PASS", 0, 0)}
    plan = rules._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("rule")[0] and plan.count("LeftAnti") == 0


def test_contradictions(spark):
    df = spark.createDataFrame([("p", "l", "3"), ("p", "l", None), ("q", "l", "3"), ("q", "m", "3"), ("r", None, "1"), ("r", None, "2")], "k string, a string, b string")
    assert by_rule(Q.contradiction_rule(df, "t", "c", "k", ["a", "b"])) == {"c": ("FAIL", 3, 2)}
    assert by_rule(Q.contradiction_rule(df.filter("k = 'p'"), "t", "c", "k", ["a", "b"])) == {"c": ("PASS", 1, 0)}


def test_gold_registries_fire_on_mutations(spark, monkeypatch):
    """The real registries over mutated facts and dimensions."""
    from conftest import SMALL
    from mensura.plans import market, national, rules, subcode

    good = rules.gold_facts(spark, SMALL)
    assert {r["status"] for r in good.collect()} == {"PASS"} and good.count() == 12
    fact, regional, nf = market.market_fact(spark, SMALL), market.regional_serving(spark, SMALL), national.national_fact(spark, SMALL)
    monkeypatch.setattr(market, "market_fact", lambda s, d: fact.unionByName(fact.limit(1)).withColumn("cut_key", F.when(F.col("year") == 2000, 7).otherwise(F.col("cut_key"))))
    monkeypatch.setattr(market, "regional_serving", lambda s, d: regional.withColumn("dest", F.when(F.col("dest") == "ASIA", "ATLANTIS").otherwise(F.col("dest"))).withColumn("level", F.lit("DETALLADO")))
    monkeypatch.setattr(national, "national_fact", lambda s, d: nf.withColumn("date_key", F.when(F.col("month") == 3, None).otherwise(F.col("date_key"))))
    bad = {(r["table"], r["rule"]) for r in rules.gold_facts(spark, SMALL).filter("status = 'FAIL'").collect()}
    assert bad == {("market_fact", "GAF_fk_cut"), ("market_fact", "GAF_grain"), ("regional_serving", "GAR_in_catalogue"), ("regional_serving", "GAR_only_regional"),
                   ("national_fact", "GAF_fk_date"), ("national_fact", "GAF_grain")}
    e, dim = subcode.enriched(spark, SMALL), subcode.dim_product(spark, SMALL)
    assert {r["status"] for r in rules.gold_dimensions(spark, SMALL).collect()} == {"PASS"}
    monkeypatch.setattr(subcode, "enriched", lambda s, d: e.withColumn("level3_label", F.when(F.col("month") == 3, "OTHER").otherwise(F.col("level3_label"))))
    monkeypatch.setattr(subcode, "dim_product", lambda s, d: dim.unionByName(dim))
    bad = {(r["table"], r["rule"]) for r in rules.gold_dimensions(spark, SMALL).filter("status = 'FAIL'").collect()}
    assert bad == {("enriched", "GBC_product_conflicts"), ("dim_product", "GBC_key_unique")}


PROPS = {"pipeline.layer": "refined", "pipeline.run_id": "r1", "lineage.input_sha256": "s1", "lineage.report_period": "2000-10"}
SINGLE = ["pipeline.run_id", "lineage.input_sha256", "lineage.report_period"]


@pytest.fixture()
def layer(spark, request):
    db = f"layer_{abs(hash(request.node.name)) % 10 ** 6}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    ok = spark.createDataFrame([("r", "t", "CRITICAL", "PASS", 1, 0, "")], "rule string, table string, severity string, status string, checked long, violations long, detail string")
    staged = {t: P.stage(spark.sql(f"SELECT DATE'2000-0{i}-01' AS period_date, {i} AS x"), t) for i, t in ((8, "a"), (9, "b"))}

    def put(name, table=None, **changed):
        P.publish({f"{db}.{name}": table or staged[name]}, ok, {**PROPS, **{k.replace("__", "."): v for k, v in changed.items()}})

    for t in staged:
        put(t)
    names = {t: f"{db}.{t}" for t in staged}

    def contract():
        bounds = Q.union_results([spark.table(n).agg(F.max("period_date").alias("period_max")).select(F.lit(t).alias("table"), "period_max") for t, n in names.items()])
        found = R.layer_contract(P.layer_properties(spark, "refined", names), list(names), {"pipeline.layer": "refined"}, SINGLE, bounds, "lineage.report_period")
        return {(r["check"], r["key"]) for r in found.filter("status = 'FAIL'").collect()}

    def suite():
        found = R.technical_suite(spark, names, {"a": 1, "b": 1}, {t: ["period_date", "x"] for t in names}, {k: PROPS[k] for k in SINGLE})
        return {(r["table"], r["test"]) for r in found.filter("status = 'FAIL'").collect()}, found.count()

    return put, staged, contract, suite


def test_contract_fails_on_a_foreign_run_hash_period_or_month(spark, layer):
    put, staged, contract, _ = layer
    assert contract() == set()
    for key in SINGLE:
        put("b", **{key.replace(".", "__"): "2000-11" if "period" in key else "other"})
        assert contract() == {("single", key)}
        put("b", **{key.replace(".", "__"): " "})
        assert ("single", key) in contract()
        put("b")
    put("a", pipeline__layer="gold")
    assert contract() == {("expected", "pipeline.layer")}
    put("a", P.stage(spark.sql("SELECT DATE'2000-11-01' AS period_date, 1 AS x"), "late"))
    assert contract() == {("bounds", "lineage.report_period")}


def test_suite_catches_what_was_corrupted(spark, layer):
    put, staged, _, suite = layer
    assert suite() == (set(), 10)
    put("a", P.stage(spark.sql("SELECT DATE'2000-08-01' AS period_date, 8 AS x FROM range(2)"), "twice"))
    assert suite()[0] == {("a", "rows"), ("a", "exact_duplicates")}
    put("a", P.stage(spark.sql("SELECT 8 AS x, DATE'2000-08-01' AS period_date"), "order"), pipeline__run_id="r2")
    assert suite()[0] == {("a", "columns"), ("a", "lineage")}
    put("a")
    P.discard([staged["a"]])
    assert suite() == ({("a", "readable")}, 6)


def test_pregates_fire_on_mutations(spark, monkeypatch):
    from conftest import SMALL
    from mensura.plans import inputs, market, rules

    assert {r["status"] for r in rules.gold_pregates(spark, SMALL).collect()} == {"PASS"}
    direct, base, every, labels = inputs.monthly_direct(spark, SMALL), market.market_base(spark, SMALL), market.market_all(spark, SMALL), market.labelled(spark, SMALL)
    monkeypatch.setattr(inputs, "monthly_direct", lambda s, d: direct.unionByName(direct.limit(1)))
    monkeypatch.setattr(market, "market_base", lambda s, d: base.unionByName(base.limit(1)).withColumn("qty", -F.col("qty")))
    monkeypatch.setattr(market, "market_all", lambda s, d: every.withColumn("level", F.when(F.col("dest") == "NATION_1", "OTRO").otherwise(F.col("level")))
                        .withColumn("dest", F.when(F.col("dest") == "ASIA", "ATLANTIS").otherwise(F.col("dest"))))
    monkeypatch.setattr(market, "labelled", lambda s, d: labels.withColumn("dest", F.when(F.col("dest") == "NATION_1", "NATION_2").otherwise(F.col("dest"))))
    bad = {(r["table"], r["rule"]) for r in rules.gold_pregates(spark, SMALL).filter("status = 'FAIL'").collect()}
    assert bad == {("monthly_direct", "GAP_no_exact_duplicates"), ("monthly_direct", "GAP_unique_period"), ("market_base", "GAP_grain"), ("market_base", "GAP_non_negative"),
                   ("market_all", "GAP_level_domain"), ("market_all", "GAP_aggregates_in_catalogue"), ("market_labels", "GAP_alias_collision")}


def test_labels_are_checked_on_every_serving_row(spark, monkeypatch):
    """A code that has its label in some of its rows only fails (D-GB15)."""
    from mensura.plans import rules, subcode

    def frame(rows, schema):
        return lambda s, d: spark.createDataFrame(rows, schema)

    labels = [("a", "A"), ("a", None), ("a", "A"), ("b", "B"), ("b", "B"), ("c", None), ("c", None), (None, None)]
    whole = "period_date string, subcode string, subcode_label string, share_fob_period double, share_tonnes_period double, fob_usd double"
    monkeypatch.setattr(subcode, "fact", frame([(1, "p", "a", 1.0, 1.0, 1000.0, 1.0)],
                                               "date_key int, product_key string, subcode_key string, tonnes double, fob_thousands double, fob_usd double, unit_price_usd_kg double"))
    for dim, key in (("dim_date", "date_key int"), ("dim_product", "product_key string"), ("dim_subcode", "subcode_key string")):
        monkeypatch.setattr(subcode, dim, frame([], key))
    monkeypatch.setattr(subcode, "annual_summary", frame([], "complete boolean, yoy_tonnes double, yoy_fob_usd double"))

    def found(kept):
        monkeypatch.setattr(subcode, "serving", frame([("2000-01", code, label, 0.5, 0.5, 1.0) for code, label in kept], whole))
        return by_rule(rules.gold_b(spark, ""))["GB15_code_has_label"]

    assert found(labels) == ("FAIL", 8, 4)
    assert found(labels[:5]) == ("FAIL", 5, 1)
    assert found(labels[3:5]) == ("PASS", 2, 0)
    assert found([]) == ("PASS", 0, 0)


def test_gold_b_checks_as_many_serving_rows_as_there_are(spark, tmp_path):
    """The whole query on small tables, against its SQL."""
    import datetime

    import duckdb

    from mensura.plans import oracle_rules, rules

    parts = [(1, "STANDARD TIN", "Brand#3"), (2, "STANDARD TIN", "Brand#21"), (3, "PROMO TIN", "Brand#7")]
    lines = [(p, datetime.date(1997, m, 5), float(m), 100.0 * p) for p, months in ((1, 3), (2, 4), (3, 1)) for m in range(1, months + 1)]
    spark.createDataFrame(parts, "p_partkey long, p_type string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(lines, "l_partkey long, l_shipdate date, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    df = rules.gold_b(spark, str(tmp_path))
    got = by_rule(df)
    assert got["GB15_code_has_label"] == ("FAIL", 8, 4) and len(got) == 15
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    cur = con.execute(oracle_rules.SQL["d_gold_b_rules"])
    names = [c[0] for c in cur.description]
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(cur.fetchall())
