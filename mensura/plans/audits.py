"""Reproducibility queries (R1, R4, R6, R7, R8) over the gold tables.

Fingerprints hash a typed row text that another engine renders alike, so the
oracle computes the same ones from its own rows; tests check them against a
plain hash of collected rows and for invariance under repartitioning and
column order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import LEVEL_DETAIL
from ..operators import audit as R
from ..session import separate_run
from . import market, national, rules, subcode


def _gold(spark: SparkSession, d: str, reshuffle: int | None = None) -> dict:
    tables = {
        "national_monthly": national.national_monthly(spark, d),
        "national_annual": national.national_annual(spark, d),
        "market_serving": market.market_serving(spark, d),
        "flat_serving": subcode.serving(spark, d),
        "annual_summary": subcode.annual_summary(spark, d),
    }
    if reshuffle:
        tables = {k: v.repartition(reshuffle).select(*reversed(v.columns)) for k, v in tables.items()}
    return tables


def fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Fingerprints of the gold serving tables."""
    return R.snapshot(_gold(spark, d))


def compare_runs(spark: SparkSession, d: str) -> DataFrame:
    """Run B rebuilds every refined and staged table from the base tables
    (nothing reused from run A) and is fingerprinted with another partitioning
    and column order; all fingerprints must match and the run ids must differ."""
    a = R.snapshot(_gold(spark, d))
    with separate_run("run-B"):
        b = R.snapshot(_gold(spark, d, reshuffle=3))
    return R.compare_runs(a, b, "run-A", "run-B")


def rule_status_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rules per status over the four rule registries."""
    allr = rules.silver_a(spark, d).unionByName(rules.silver_b(spark, d)) \
        .unionByName(rules.gold_a(spark, d)).unionByName(rules.gold_b(spark, d))
    return R.status_counts(allr)


def expected_rows(spark: SparkSession, d: str) -> DataFrame:
    """Observed row counts against expectations derived from the inputs:
    one national row per month present in either source, one market row per
    detailed destination, cut and year, one serving row per fact row, one
    annual row per year."""
    snap = R.snapshot(_gold(spark, d)).select("table", "rows")
    months = national.national_base(spark, d).select(F.count(F.lit(1))).scalar()
    facts = subcode.fact(spark, d).select(F.count(F.lit(1))).scalar()
    years = subcode.fact(spark, d).select(F.count_distinct(F.substring(F.col("date_key").cast("string"), 1, 4))) \
        .scalar()
    cells = market.market_all(spark, d).filter(F.col("level") == LEVEL_DETAIL).select(F.count_distinct("dest", "cut", "year")).scalar()
    nyears = national.national_base(spark, d).select(F.count_distinct("year")).scalar()
    def row(name, value):
        return F.struct(F.lit(name).alias("table"), value.cast("bigint").alias("expected_rows"))

    exp = spark.range(1).select(F.inline(F.array(
        row("national_monthly", months), row("national_annual", nyears),
        row("flat_serving", facts), row("annual_summary", years), row("market_serving", cells))))
    return R.check_rows(snap, exp)


def schema_contracts(spark: SparkSession, d: str) -> DataFrame:
    """Semantic contract of the serving tables (required / forbidden columns)."""
    s = subcode.serving(spark, d)
    m = market.market_serving(spark, d)
    return R.check_schema(s, "flat_serving", required=["period_date", "subcode", "fob_usd"],
                          forbidden=["country", "pais"]).unionByName(
        R.check_schema(m, "market_serving", required=["dest", "level", "cut", "year"], forbidden=["pais"]))
