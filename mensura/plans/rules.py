"""Rule registries of the four layers (D-A*, D-B*, D-GA*, D-GB*) over the
refined and gold tables derived from the driver data.

Each registry returns one rules DataFrame; row rules of a table run as one
aggregate job, grouped rules as one grouped aggregate each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.labels import LEVEL_DETAIL, LEVEL_REGIONAL
from ..functions.numbers import (ABS_PRICE_TOL, ABS_SHARE_TOL, ABS_TOL_PRICE, ABS_TOL_TOTAL,
                                 ABS_USD_CONVERSION_TOL, REL_TOL, REL_TOL_PRICE,
                                 MEASURE_SCALE, dual_scale_violation, loses_at_scale, row_sum)
from ..functions.text import digits
from ..operators.quality import (CRITICAL, WARNING, Rule, calendar_gap_rule, conflict_rule, contradiction_rule, count_rule, key_rules,
                                 share_range_rule, subset_rule,
                                 count_equal_rule, evaluate, not_empty_rule,
                                 partition_sum_rule, schema_rule, union_results, unique_rule)
from ..operators.reshape import any_null
from ..operators.series import reconcile_totals
from . import inputs, market, national, subcode

# --- fixed values of the test-data instance --------------------------------
EXPECTED_LEVEL3 = "0083"
EXPECTED_PRODUCT = "008384"
LEVEL3_TOKEN = "GOOD"
PRODUCT_TOKEN = "STANDARD"
KNOWN_VARIANT = r"\bPROMO\b"
HISTORICAL_SUFFIX = r"\(COLONIA [A-Z]+\)"
FORBIDDEN_COLUMNS = ("country", "pais")
CRITICAL_B = ("period_text", "period_date", "year", "month", "level3_code", "level3_label",
              "product_code", "product_label", "subcode", "subcode_label", "tonnes",
              "fob_thousands", "fob_usd")
# ---------------------------------------------------------------------------


def silver_b(spark: SparkSession, d: str) -> DataFrame:
    """D-B1..D-B18 on the refined sub-code fact."""
    f = inputs.subcode_fact(spark, d)
    t = "subcode_fact"
    row_rules = [
        Rule("B1_level3_code_expected", CRITICAL, F.col("level3_code") != EXPECTED_LEVEL3),
        Rule("B2_product_code_expected", CRITICAL, F.col("product_code") != EXPECTED_PRODUCT),
        Rule("B3_level3_label_token", CRITICAL, ~F.upper("level3_label").contains(LEVEL3_TOKEN)),
        Rule("B4_product_label_token", CRITICAL, ~F.upper("product_label").contains(PRODUCT_TOKEN)),
        Rule("B6_known_variant_reported", WARNING, F.upper("subcode_label").rlike(KNOWN_VARIANT)),
        Rule("B8_critical_not_null", CRITICAL, any_null(CRITICAL_B)),
        Rule("B9_tonnes_non_negative", CRITICAL, F.col("tonnes") < 0, F.col("tonnes").isNotNull()),
        Rule("B10_fob_non_negative", CRITICAL, F.col("fob_thousands") < 0,
             F.col("fob_thousands").isNotNull()),
        Rule("B11_tonnes_zero", WARNING, F.col("tonnes") == 0),
        Rule("B12_fob_zero", WARNING, F.col("fob_thousands") == 0),
        Rule("B13_level3_4_digits", CRITICAL, ~digits("level3_code", 4)),
        Rule("B14_product_6_digits", CRITICAL, ~digits("product_code", 6)),
        Rule("B15_subcode_10_digits", CRITICAL, ~digits("subcode", 10)),
        Rule("B16_usd_conversion", CRITICAL,
             F.abs(F.col("fob_usd") - F.col("fob_thousands") * 1000.0) > ABS_USD_CONVERSION_TOL,
             F.col("fob_usd").isNotNull() & F.col("fob_thousands").isNotNull()),
        *[Rule(f"scale_of_{c}", WARNING, loses_at_scale(c, MEASURE_SCALE), F.col(c).isNotNull()) for c in ("tonnes", "fob_thousands", "fob_usd")],
    ]
    return union_results([
        evaluate(f, t, row_rules),
        conflict_rule(f, t, "B5_one_label_per_subcode", "subcode", "subcode_label"),
        conflict_rule(f, t, "B5_one_label_per_product", "product_code", "product_label"),
        not_empty_rule(f, t, "B7_not_empty"),
        unique_rule(f, t, "B17_business_key_unique", ["period_date", "product_code", "subcode"]),
        calendar_gap_rule(f, t, "B18_no_calendar_gap", "period_date"),
    ])


def gold_b(spark: SparkSession, d: str) -> DataFrame:
    """D-GB1..D-GB15 on the sub-code star schema and serving table."""
    fact = subcode.fact(spark, d)
    serving = subcode.serving(spark, d)
    annual = subcode.annual_summary(spark, d)
    expected_price = F.when(F.col("tonnes") > 0, F.col("fob_usd") / (F.col("tonnes") * 1000.0))
    fact_rules = [
        Rule("GB1_measures_non_negative", CRITICAL,
             (F.col("tonnes") < 0) | (F.col("fob_usd") < 0) | (F.col("fob_thousands") < 0)),
        Rule("GB2_usd_conversion", CRITICAL,
             F.abs(F.col("fob_usd") - F.col("fob_thousands") * 1000.0) > ABS_USD_CONVERSION_TOL),
        Rule("GB3_unit_price", CRITICAL,
             F.abs(F.col("unit_price_usd_kg") - expected_price) > ABS_PRICE_TOL,
             (F.col("tonnes") > 0) & F.col("unit_price_usd_kg").isNotNull()),
        Rule("GB12_product_code_expected", CRITICAL, F.col("product_key") != EXPECTED_PRODUCT),
        Rule("GB13_zero_values_reported", WARNING, (F.col("tonnes") == 0) | (F.col("fob_usd") == 0)),
    ]
    serving_rules = [
        Rule("GB8_share_in_unit_range", CRITICAL,
             (F.col("share_fob_period") < 0) | (F.col("share_fob_period") > 1)
             | (F.col("share_tonnes_period") < 0) | (F.col("share_tonnes_period") > 1)),
        # every row: a label in one row of a code does not excuse the others (the codes themselves: u7_coverage)
        Rule("GB15_code_has_label", CRITICAL, F.col("subcode_label").isNull()),
    ]
    annual_rules = [
        Rule("GB14_no_yoy_on_partial_years", CRITICAL,
             ~F.col("complete") & (F.col("yoy_tonnes").isNotNull() | F.col("yoy_fob_usd").isNotNull())),
    ]
    return union_results([
        evaluate(fact, "fact_subcode", fact_rules),
        key_rules(fact, "fact_subcode", {
            "GB5_fk_date": ("date_key", subcode.dim_date(spark, d), "date_key"), "GB6_fk_product": ("product_key", subcode.dim_product(spark, d), "product_key"),
            "GB7_fk_subcode": ("subcode_key", subcode.dim_subcode(spark, d), "subcode_key")}, ("GB4_fact_grain_unique", ["date_key", "product_key", "subcode_key"])),
        evaluate(serving, "serving", serving_rules),
        partition_sum_rule(serving, "serving", "GB9_share_sums_to_one", ["period_date"],
                           "share_fob_period", 1.0, ABS_SHARE_TOL, when_total_positive="fob_usd"),
        count_equal_rule(serving, fact, "serving", "GB10_serving_rows_equal_fact"),
        schema_rule(serving, "serving", "GB11_no_country_column", forbidden=FORBIDDEN_COLUMNS),
        evaluate(annual, "annual_summary", annual_rules),
    ])


def gold_facts(spark: SparkSession, d: str) -> DataFrame:
    """D-GA-F and D-GA-R: foreign keys and grain of the three facts, and the
    regional serving's grain, level and catalogue; one pass per table."""
    dates, cuts = market.date_spine(spark, d), market.dim_cut(spark)
    destinations, regions = market.dim_destination(spark, d), market.regional_labels(spark, d)
    regional = market.regional_serving(spark, d)
    return union_results([
        key_rules(national.national_fact(spark, d), "national_fact", {"GAF_fk_date": ("date_key", dates, "date_key")}, ("GAF_grain", ["date_key"])),
        key_rules(market.market_fact(spark, d), "market_fact", {
            "GAF_fk_destination": ("destination_key", destinations, "destination_key"), "GAF_fk_cut": ("cut_key", cuts, "cut_key"),
            "GAF_fk_date": ("date_key", dates, "date_key")}, ("GAF_grain", ["destination_key", "cut_key", "year"])),
        key_rules(market.comparative_fact(spark, d), "comparative_fact", {
            "GAF_fk_cut": ("cut_key", cuts, "cut_key"), "GAF_fk_date": ("date_key", dates, "date_key")}, ("GAF_grain", ["cut_key", "year"])),
        key_rules(regional, "regional_serving", {"GAR_in_catalogue": ("dest", regions, "_regional")}, ("GAR_grain", ["dest", "cut", "year"])),
        evaluate(regional, "regional_serving", [Rule("GAR_only_regional", CRITICAL, F.col("level") != LEVEL_REGIONAL)]),
    ])


def gold_pregates(spark: SparkSession, d: str) -> DataFrame:
    """D-GA-P: what must hold before gold is built : no exact duplicates, one
    row a period, no negative measure, levels of the domain, aggregates of the
    catalogue, one source label per analytic label."""
    p = inputs.P
    series = {"monthly_direct": inputs.monthly_direct(spark, d), "matrix_value": inputs.matrix_long(spark, d, "value"), "matrix_qty": inputs.matrix_long(spark, d, "qty")}
    national_rows, base = national.national_base(spark, d), market.market_base(spark, d)
    every, long = market.market_all(spark, d), inputs.market_long(spark, d)
    negative = (F.col("qty") < 0) | (F.col("value") < 0)
    collisions = market.labelled(spark, d).groupBy("cut", "dest", "indicator").agg((F.min("label_source") != F.max("label_source")).alias("clash"))
    return union_results([
        *[key_rules(t, name, {}, [("GAP_no_exact_duplicates", t.columns), ("GAP_unique_period", ["period_date"])]) for name, t in series.items()],
        key_rules(long, "market_long", {}, ("GAP_no_exact_duplicates", long.columns)),
        key_rules(national_rows, "national_base", {}, ("GAP_unique_period", ["period_date"])),
        evaluate(national_rows, "national_base", [Rule("GAP_non_negative", CRITICAL, negative)]),
        key_rules(base, "market_base", {}, ("GAP_grain", ["dest", "cut", "year"])),
        evaluate(base, "market_base", [Rule("GAP_non_negative", CRITICAL, negative)]),
        evaluate(every, "market_all", [Rule("GAP_level_domain", CRITICAL, ~F.col("level").isin(LEVEL_DETAIL, LEVEL_REGIONAL))]),
        key_rules(every.filter(F.col("level") == LEVEL_REGIONAL), "market_all", {"GAP_aggregates_in_catalogue": ("dest", market.regional_labels(spark, d), "_regional")}),
        evaluate(collisions, "market_labels", [Rule("GAP_alias_collision", CRITICAL, F.col("clash"), detail=f"{len(p.homologation)} declared aliases")]),
    ])


def gold_dimensions(spark: SparkSession, d: str) -> DataFrame:
    """D-GB-C: attributes that contradict each other under one code, before the
    dimensions are made, and the dimensions' keys."""
    e = subcode.enriched(spark, d)
    return union_results([
        contradiction_rule(e, "enriched", "GBC_product_conflicts", "product_code", ["product_label", "level3_code", "level3_label"]),
        contradiction_rule(e, "enriched", "GBC_subcode_conflicts", "subcode", ["subcode_label", "product_code"]),
        *[key_rules(dim, name, {}, ("GBC_key_unique", [key])) for dim, name, key in (
            (subcode.dim_date(spark, d), "dim_date", "date_key"), (subcode.dim_product(spark, d), "dim_product", "product_key"),
            (subcode.dim_subcode(spark, d), "dim_subcode", "subcode_key"))],
    ])


def silver_a(spark: SparkSession, d: str) -> DataFrame:
    """D-A1..D-A6 on the refined national and market tables."""
    p = inputs.P
    months = inputs.MONTH_COLS
    direct = inputs.monthly_direct(spark, d)
    hist = market.history(spark, d)
    long = inputs.market_long(spark, d)
    # Lag without the consecutive-year guard (kept as in the source rule)
    w = Window.partitionBy("cut").orderBy("year")
    h = hist.withColumns({f"_prev_{m}": F.lag(m).over(w) for m in ("value", "qty")})
    def growth_rule(rule: str, measure: str, previous: str, stored: str) -> Rule:
        return Rule(rule, CRITICAL, dual_scale_violation(measure, previous, stored),
                    F.col(previous).isNotNull() & (F.col(previous) != 0) & F.col(stored).isNotNull() & F.col(measure).isNotNull())

    parts = []
    for measure in ("value", "qty"):
        mv, ml = inputs.matrix_wide(spark, d, measure), inputs.matrix_long(spark, d, measure)
        cells = mv.select(F.explode(F.array(*[F.col(c) for c in months + ["total"]])).alias("v"))
        parts += [
            evaluate(cells, f"matrix_{measure}", [
                Rule("A1_non_negative", CRITICAL, F.col("v") < 0, F.col("v").isNotNull())]),
            evaluate(mv, f"matrix_{measure}", [
                Rule("A2_total_equals_months", CRITICAL,
                     F.abs(F.col("total") - row_sum(months))
                     > F.greatest(F.lit(ABS_TOL_TOTAL), F.abs("total") * REL_TOL),
                     F.col("total").isNotNull())]),
            unique_rule(ml, f"matrix_{measure}_long", "A6_period_key_unique", ["year", "month"]),
            evaluate(ml, f"matrix_{measure}_long", [
                Rule("A6_period_valid", CRITICAL,
                     F.col("year").isNull() | F.col("month").isNull() | (F.col("month") < 1)
                     | (F.col("month") > 12) | (F.col("period_date") > F.lit(p.report_cutoff).cast("date")))]),
        ]
    return union_results([
        *parts,
        evaluate(direct, "monthly_direct", [
            *[Rule(f"A1_{c}_non_negative", CRITICAL, F.col(c) < 0, F.col(c).isNotNull()) for c in ("qty", "value", "reported_price")],
            Rule("A3_reported_price", CRITICAL,
                 F.abs(F.col("reported_price") - F.col("value") / F.col("qty"))
                 > F.greatest(F.lit(ABS_TOL_PRICE), F.abs("reported_price") * REL_TOL_PRICE),
                 (F.col("qty") > 0) & F.col("reported_price").isNotNull() & F.col("value").isNotNull())]),
        evaluate(h, "history", [growth_rule("A4_stored_growth", "value", "_prev_value", "pub_growth_value"),
                                growth_rule("A4_stored_growth_qty", "qty", "_prev_qty", "pub_growth_qty")]),
        evaluate(market.published_growth(spark, d), "market_published", [
            growth_rule("A4b_market_growth", "value", "prev_value", "pub_growth_value"),
            growth_rule("A4b_market_growth_qty", "qty", "prev_qty", "pub_growth_qty")]),
        # fraction or percentage: told for each cut by its largest share
        *[share_range_rule(long.filter((F.col("cut") == cut) & (F.col("indicator") == "participacion_libras")), f"market_{cut.lower()}", "A5_share_in_range", "value")
          for cut in market.CUTS],
        unique_rule(long, "market_long", "A6_market_key_unique", ["cut", "label", "indicator"]),
    ])


def gold_a(spark: SparkSession, d: str) -> DataFrame:
    """D-GA1..D-GA8 on the national and market gold tables."""
    p = inputs.P
    nf = national.national_fact(spark, d)
    na = national.national_annual(spark, d)
    audit = national.reconciliation_audit(spark, d)
    base = market.market_base(spark, d)
    allm = market.market_all(spark, d)
    serving = market.market_serving(spark, d)
    reg = market.regional_labels(spark, d)
    hmap = dict(p.homologation)
    totals = market.history(spark, d).select("cut", "year", "value", "qty")
    regional = allm.filter(F.col("level") == LEVEL_REGIONAL)
    outside = regional.join(reg, F.col("dest") == reg._regional, "left_anti")
    map_ok = F.col("label_source").isin(list(hmap)) if hmap else F.lit(False)
    return union_results([
        evaluate(nf, "national_fact", [
            Rule("GA1_non_negative", CRITICAL, (F.col("qty") < 0) | (F.col("value") < 0)),
            Rule("GA2_price_ratio", CRITICAL,
                 F.abs(F.col("price") - F.col("value") / F.col("qty")) > ABS_PRICE_TOL,
                 (F.col("qty") > 0) & F.col("value").isNotNull() & F.col("price").isNotNull())]),
        evaluate(na, "national_annual", [
            Rule("GA3_annual_price_ratio_of_sums", CRITICAL,
                 F.abs(F.col("weighted_price") - F.col("value_total") / F.col("qty_total")) > ABS_PRICE_TOL,
                 F.col("qty_total") > 0),
            Rule("GA6_no_yoy_on_partial_years", CRITICAL,
                 ~F.col("complete") & (F.col("yoy_qty").isNotNull() | F.col("yoy_value").isNotNull()))]),
        evaluate(base, "market_base", [
            Rule("GA4_share_in_unit_range", CRITICAL,
                 (F.col("share_qty") < 0) | (F.col("share_qty") > 1), F.col("share_qty").isNotNull()),
            Rule("GA5c_only_detail", CRITICAL, F.col("level") != LEVEL_DETAIL),
            Rule("GA5d_no_historical_suffix", CRITICAL, F.col("dest").rlike(HISTORICAL_SUFFIX))]),
        partition_sum_rule(base, "market_base", "GA5_share_sums_to_one", ["cut", "year"], "share_qty",
                           1.0, ABS_SHARE_TOL, when_total_positive="qty"),
        *[count_rule(reconcile_totals(base, totals, ["cut", "year"], m, ABS_TOL_TOTAL).agg(
            F.count(F.lit(1)).alias("checked"), F.count_if(~F.col("within_tolerance")).alias("violations")),
            rule, "market_base", CRITICAL, "sum of destinations = total")
          for m, rule in (("value", "GA5b_destinations_sum_to_total"), ("qty", "GA5b_quantities_sum_to_total"))],
        evaluate(allm, "market_all", [
            Rule("GA5e_level_domain", CRITICAL, ~F.col("level").isin(LEVEL_DETAIL, LEVEL_REGIONAL)),
            Rule("GA5g_source_label_not_blank", CRITICAL,
                 F.col("label_source").isNull() | (F.trim("label_source") == "")),
            Rule("GA5h_homologation_declared", CRITICAL,
                 (F.col("label_source") != F.col("dest")) & ~map_ok)]),
        subset_rule(regional, outside, "market_all", "GA5f_aggregates_in_catalogue", CRITICAL,
                    "regional labels in catalogue"),
        evaluate(audit, "reconciliation", [
            Rule("GA7_reconciliation_divergences", WARNING,
                 F.col("reconciliation_state") == "DIFIERE_PRIORIZA_DIRECTO")]),
        evaluate(serving, "market_serving", [
            Rule("GA8_published_growth_review", WARNING,
                 (F.col("check_growth_qty") == "REVISAR") | (F.col("check_growth_value") == "REVISAR"))]),
    ])
