"""Source B gold layer: enriched fact, dimensions, fact, summaries, flat
serving and one-row KPI (K12–K16) over the sub-code fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns
from ..functions.numbers import MEASURE_SCALE, exact_sum, ratio
from ..operators.series import growth_by_year, lag_growth, ranked_in, rollup, shares_of
from ..session import materialize, per_session
from . import inputs

MEASURES = ["tonnes", "fob_usd"]


@per_session
def catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Declared short labels per sub-code (brands 1..20 of ``part``).

    Stands in for the reference's fixed code->label presentation map; codes
    of brands above 20 are deliberately uncovered so coverage rules fire.
    """
    pt = inputs.table(spark, d, "part").select("p_type", "p_brand")
    brand_no = F.regexp_extract("p_brand", r"(\d+)$", 1).try_cast("int")
    prod = F.lpad((F.ascii("p_type") * 100 + F.ascii(F.substring("p_type", 2, 1))).cast("string"), 6, "0")
    return (pt.filter(brand_no <= 20)
            .select(F.concat(prod, F.lpad(brand_no.cast("string"), 4, "0")).alias("subcode"),
                    F.concat(F.upper(F.substring("p_type", 1, 1)), F.lower(F.substring("p_type", 2, 100)),
                             F.lit(" B"), brand_no.cast("string")).alias("short_label"))
            .distinct())


@per_session
def enriched(spark: SparkSession, d: str) -> DataFrame:
    """K12 / P5 + N1: calendar, unit price USD/kg, YoY per sub-code and month."""
    f = inputs.subcode_fact(spark, d)
    cal = calendar_columns("period_date")
    base = f.withColumns({
        "date_key": cal["date_key"], "month_name": cal["month_name"],
        "year_month": cal["year_month"], "quarter": cal["quarter"], "semester": cal["semester"],
        "unit_price_usd_kg": ratio("fob_usd", "tonnes", "positive", 1000.0),
    })
    # staged once: the fact, dimensions, summaries, serving table and rules read it
    return materialize(lag_growth(base, ["subcode", "month"], "year", MEASURES, prefix="yoy_",
                                  consecutive=True, require="positive", ratio_minus_one=True,
                                  keep_lag="_prev_year"))


def dim_date(spark: SparkSession, d: str) -> DataFrame:
    e = enriched(spark, d)
    return e.groupBy("date_key").agg(*[F.min(c).alias(c) for c in
                                      ["period_date", "year", "month", "month_name", "year_month",
                                       "quarter", "semester"]])


def dim_product(spark: SparkSession, d: str) -> DataFrame:
    """Product dimension keyed by the institutional code (U4: min by key)."""
    f = inputs.subcode_fact(spark, d)
    return f.groupBy(F.col("product_code").alias("product_key")).agg(
        F.min_by(F.struct("level3_code", "level3_label", "product_code", "product_label"),
                 F.struct("level3_code", "level3_label", "product_label")).alias("s")) \
        .select("product_key", "s.*")


def dim_subcode(spark: SparkSession, d: str) -> DataFrame:
    f = inputs.subcode_fact(spark, d)
    cat = catalogue(spark, d)
    g = f.groupBy(F.col("subcode").alias("subcode_key")).agg(
        F.min("subcode_label").alias("official_label"), F.min("product_code").alias("product_code"))
    return g.join(cat, g.subcode_key == cat.subcode, "left").select(
        "subcode_key", F.col("subcode_key").alias("subcode"), "official_label", "short_label",
        "product_code")


@per_session
def fact(spark: SparkSession, d: str) -> DataFrame:
    """Fact at date x product x sub-code grain."""
    e = enriched(spark, d)
    return e.select("date_key", F.col("product_code").alias("product_key"),
                    F.col("subcode").alias("subcode_key"), "tonnes", "fob_thousands", "fob_usd",
                    "unit_price_usd_kg")


@per_session
def monthly_summary(spark: SparkSession, d: str) -> DataFrame:
    """Monthly totals, sub-codes reported, ratio-of-sums price."""
    e = enriched(spark, d)
    return rollup(e, ["date_key", "period_date", "year", "month", "month_name", "year_month",
                      "quarter", "semester"],
                  {"tonnes_total": exact_sum("tonnes", MEASURE_SCALE), "fob_thousands_total": exact_sum("fob_thousands", MEASURE_SCALE),
                   "fob_usd_total": exact_sum("fob_usd", MEASURE_SCALE)},
                  {"subcodes_reported": "subcode"},
                  ("weighted_price_usd_kg", "fob_usd_total", "tonnes_total", 1000.0))


@per_session
def annual_summary(spark: SparkSession, d: str) -> DataFrame:
    """K14 / A2 + N2: annual totals; YoY only between consecutive complete years."""
    m = monthly_summary(spark, d)
    a = rollup(m, ["year"], {"tonnes_total": exact_sum("tonnes_total", MEASURE_SCALE),
                             "fob_thousands_total": exact_sum("fob_thousands_total", MEASURE_SCALE),
                             "fob_usd_total": exact_sum("fob_usd_total", MEASURE_SCALE)},
               {"months_reported": "month"},
               ("weighted_price_usd_kg", "fob_usd_total", "tonnes_total", 1000.0))
    a = a.withColumn("complete", F.col("months_reported") == 12)
    g = growth_by_year(a, "year", ["tonnes_total", "fob_usd_total"], complete_col="complete",
                       rate_prefix="yoy_", require="positive", ratio_minus_one=True)
    return g.select("year", "tonnes_total", "fob_thousands_total", "fob_usd_total",
                    "months_reported", "complete", "weighted_price_usd_kg",
                    F.col("yoy_tonnes_total").alias("yoy_tonnes"),
                    F.col("yoy_fob_usd_total").alias("yoy_fob_usd"))


@per_session
def serving(spark: SparkSession, d: str) -> DataFrame:
    """Flat serving: shares and ranks per period, annual coverage, last-period flag."""
    e = enriched(spark, d)
    cat = catalogue(spark, d)
    s = ranked_in(e, ["period_date"], {"rank_tonnes_period": ("tonnes", "subcode"), "rank_fob_period": ("fob_usd", "subcode")})
    s = shares_of(s, e, ["period_date"], {"share_tonnes_period": "tonnes", "share_fob_period": "fob_usd"})
    s = s.join(cat, "subcode", "left")
    annual = annual_summary(spark, d).select(
        "year", "months_reported", "complete",
        F.when(F.col("complete"), F.lit("COMPLETO")).otherwise(F.lit("PARCIAL")).alias("year_coverage"))
    s = s.join(annual, "year", "left")
    last = e.select(F.max("period_date")).scalar()
    s = s.withColumn("is_last_period", F.col("period_date") == last)
    # the serving table is written once; its rules and the KPI read it back
    return materialize(s.select(
        "period_date", "period_text", "year", "month", "month_name", "year_month", "quarter",
        "semester", "months_reported", "year_coverage", "is_last_period", "level3_code",
        "level3_label", "product_code", "product_label", "subcode",
        F.col("short_label").alias("subcode_label"), "tonnes", "fob_thousands", "fob_usd",
        "unit_price_usd_kg", "share_tonnes_period", "share_fob_period", "rank_tonnes_period",
        "rank_fob_period", "tonnes_prev_year", "fob_usd_prev_year", "yoy_tonnes", "yoy_fob_usd"))


def kpi(spark: SparkSession, d: str) -> DataFrame:
    """One-row KPI as aggregates and scalar subqueries (no driver scalars)."""
    e = enriched(spark, d)
    m = monthly_summary(spark, d)
    last = m.select(F.max("period_date")).scalar()
    prev = F.add_months(last, -12)
    lm = m.agg(
        F.max(F.when(F.col("period_date") == last, F.col("tonnes_total"))).alias("lt"),
        F.max(F.when(F.col("period_date") == last, F.col("fob_usd_total"))).alias("lf"),
        F.max(F.when(F.col("period_date") == prev, F.col("tonnes_total"))).alias("pt"),
        F.max(F.when(F.col("period_date") == prev, F.col("fob_usd_total"))).alias("pf"))
    s = serving(spark, d).filter((F.col("period_date") == last) & (F.col("rank_fob_period") == 1))
    top_code = s.select(F.max("subcode")).scalar()
    top_label = s.select(F.max("subcode_label")).scalar()
    prof = e.agg(F.min("period_date").alias("period_min"), F.max("period_date").alias("period_max"),
                 F.count_distinct("period_date").cast("int").alias("periods"),
                 F.count_distinct("subcode").cast("int").alias("subcodes"),
                 exact_sum("tonnes", MEASURE_SCALE).alias("tonnes_total_all"),
                 exact_sum("fob_usd", MEASURE_SCALE).alias("fob_usd_total_all"))
    lt, lf, pt, pf = [lm.select(c).scalar() for c in ("lt", "lf", "pt", "pf")]
    return prof.select(
        "period_min", "period_max", "periods", "subcodes", "tonnes_total_all", "fob_usd_total_all",
        F.coalesce(lt, F.lit(0.0)).alias("tonnes_last_period"),
        F.coalesce(lf, F.lit(0.0)).alias("fob_usd_last_period"),
        F.when(pt > 0, F.coalesce(lt, F.lit(0.0)) / pt - F.lit(1.0)).alias("yoy_tonnes_last_comparable"),
        F.when(pf > 0, F.coalesce(lf, F.lit(0.0)) / pf - F.lit(1.0)).alias("yoy_fob_last_comparable"),
        top_code.alias("top_fob_subcode_last_period"),
        top_label.alias("top_fob_subcode_label_last_period"))
