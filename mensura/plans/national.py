"""National series of source A: reconciliation (K1), monthly serving (K7),
annual serving (K8), historical comparative (K4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns, date_key
from ..functions.numbers import ABS_RECON_TOL, REL_RECON_TOL, MEASURE_SCALE, exact_sum, ratio
from ..operators.series import align, growth_by_shift, growth_by_year, reconcile, rollup_year
from ..session import materialize, per_session
from . import inputs

SOURCE_DIRECT = "exportaciones_mensuales"
SOURCE_MATRIX = "matriz_historica"


@per_session
def _reconciled(spark: SparkSession, d: str) -> DataFrame:
    direct = inputs.monthly_direct(spark, d).select(
        "period_date", F.col("qty").alias("qty_direct"), F.col("value").alias("value_direct"),
        F.col("reported_price").alias("reported_price_direct"))
    mv = inputs.matrix_long(spark, d, "value").select("period_date", F.col("value").alias("value_matrix"))
    mq = inputs.matrix_long(spark, d, "qty").select("period_date", F.col("value").alias("qty_matrix"))
    matrix = align(mv, mq, "period_date")
    r = reconcile(direct, matrix, "period_date", ["qty", "value"], ABS_RECON_TOL, REL_RECON_TOL,
                  SOURCE_DIRECT, SOURCE_MATRIX)
    # staged once: the audit, canonical series, facts, serving tables and rules read it
    return materialize(r.withColumns({
        "year": F.year("period_date"), "month": F.month("period_date"),
        "price": F.when(F.col("qty").isNotNull() & (F.col("qty") > 0) & F.col("value").isNotNull(),
                        F.col("value") / F.col("qty")),
    }))


def reconciliation_audit(spark: SparkSession, d: str) -> DataFrame:
    """K1 audit table: both sources side by side with match flags and state."""
    return _reconciled(spark, d).select(
        "period_date", "year", "month", "qty_direct", "qty_matrix", "diff_abs_qty", "match_qty",
        "value_direct", "value_matrix", "diff_abs_value", "match_value",
        "reported_price_direct", "reconciliation_state")


@per_session
def national_base(spark: SparkSession, d: str) -> DataFrame:
    """K1: canonical national monthly series (direct first, matrix extends)."""
    return _reconciled(spark, d).filter(F.col("qty").isNotNull() | F.col("value").isNotNull()) \
        .select("period_date", "year", "month", "qty", "value", "price", "source_qty",
                "source_value", "reconciliation_state")


@per_session
def national_fact(spark: SparkSession, d: str) -> DataFrame:
    """K6: national fact keyed by the date key."""
    b = national_base(spark, d)
    return b.select(date_key("period_date").alias("date_key"), "period_date", "year", "month",
                    "qty", "value", "price", "source_qty", "source_value", "reconciliation_state")


@per_session
def national_monthly(spark: SparkSession, d: str) -> DataFrame:
    """K7: monthly serving with MoM and YoY from shifted-key joins."""
    fact = national_fact(spark, d)
    dim = fact.select("period_date").distinct().withColumns(calendar_columns("period_date")) \
        .select("date_key", "month_name", "quarter", "semester", "year_month")
    base = fact.join(dim, "date_key", "inner")
    m = growth_by_shift(base, "period_date", ["qty", "value"], 1, "_prev_month", "mom_")
    y = growth_by_shift(m, "period_date", ["qty", "value"], 12, "_prev_year_month", "yoy_")
    return y.select("period_date", "year", "month", "month_name", "year_month", "quarter",
                    "semester", "qty", "value", "price", "mom_qty", "mom_value", "yoy_qty",
                    "yoy_value", "source_qty", "source_value", "reconciliation_state")


@per_session
def national_annual(spark: SparkSession, d: str) -> DataFrame:
    """K8: annual totals, completeness and YoY only between complete years."""
    fact = national_fact(spark, d)
    a = rollup_year(fact, "year", "month", {"qty_total": exact_sum("qty", MEASURE_SCALE),
                                            "value_total": exact_sum("value", MEASURE_SCALE)},
                    complete_out="complete")
    a = a.withColumn("weighted_price", ratio("value_total", "qty_total", "positive"))
    g = growth_by_year(a, "year", ["qty_total", "value_total"], complete_col="complete",
                       rate_prefix="yoy_")
    return g.select("year", "months_reported", "complete", "qty_total", "value_total",
                    "weighted_price", F.col("yoy_qty_total").alias("yoy_qty"),
                    F.col("yoy_value_total").alias("yoy_value"))
