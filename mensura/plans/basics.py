"""Operators that the composite datasets write out, each over a whole table:
labels by code (O15), years in text (O19), month arithmetic (O26, O27), row
texts (O29), null-observation audits (F3), label filters (F4, F5), contract
projection (F8), pivots (P3, P4), calendar enrichment (P5), attachment and
denormalisation (J3, J6) and schema contracts (R7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import cut_date, shift_months, year_from_text
from ..functions.hashing import row_sha
from ..functions.labels import code_label, parse_indicator
from ..functions.text import contains_token
from ..operators.reshape import drop_labels, enrich_calendar, null_obs_audit, pivot_indicators, pivot_units, to_contract
from ..operators.series import attach, denormalise
from . import inputs, market, national, resources

#: Codes with a label (test-data instance); the others have none.
STATUS = {"F": "CUMPLIDO", "O": "ABIERTO"}


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return inputs.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("order_date"), "o_orderpriority")


def code_labels(spark: SparkSession, d: str) -> DataFrame:
    """The status label of every order; codes without one stay without."""
    return _orders(spark, d).select("o_orderkey", "o_orderstatus", code_label("o_orderstatus", STATUS).alias("label"))


def years_in_names(spark: SparkSession, d: str) -> DataFrame:
    """The first year in the file name of every resource."""
    return resources.records(spark, d).select("doc_id", "original_filename", year_from_text("original_filename").alias("year"))


def months(spark: SparkSession, d: str) -> DataFrame:
    """Every month with the one a year before and its year's cut date."""
    m = inputs.order_months(spark, d)
    return m.select("period_date", shift_months("period_date", -12).alias("year_before"), cut_date(F.year("period_date"), inputs.P.cut_month).alias("cut_date"))


def row_hashes(spark: SparkSession, d: str) -> DataFrame:
    """SHA-256 of every order's typed row text."""
    o = _orders(spark, d)
    return o.select("o_orderkey", row_sha(o).alias("row_sha"))


def null_observations(spark: SparkSession, d: str) -> DataFrame:
    """months without a direct quantity, in one aggregate."""
    return null_obs_audit(national.reconciliation_audit(spark, d), "qty_direct")


def analytic_labels(spark: SparkSession, d: str) -> DataFrame:
    """detail rows of the market tables, and whether a label has a token."""
    kept = drop_labels(inputs.market_long(spark, d), "label")
    return kept.select("cut", "label", "indicator", contains_token("label", "nation_1").alias("has_token"))


def contract_projection(spark: SparkSession, d: str) -> DataFrame:
    """F8: orders under the contract's names and order."""
    return to_contract(_orders(spark, d), {"order_date": "fecha", "o_orderkey": "pedido", "o_totalprice": "valor"}, ["pedido", "fecha", "valor"])


def units(spark: SparkSession, d: str) -> DataFrame:
    """A column per unit of the dated market indicators."""
    unit = year = None
    for cut, pattern in market.CUTS.items():
        u, y = parse_indicator("indicator", pattern)
        unit = F.when(F.col("cut") == cut, u) if unit is None else unit.when(F.col("cut") == cut, u)
        year = F.when(F.col("cut") == cut, y) if year is None else year.when(F.col("cut") == cut, y)
    dated = inputs.market_long(spark, d).withColumns({"unit": unit, "year": year}).filter("unit IS NOT NULL AND year IS NOT NULL")
    return pivot_units(dated, ["cut", "label", "year"], "unit", "value", ["dolares", "libras"])


def indicators(spark: SparkSession, d: str) -> DataFrame:
    """A column per published indicator."""
    return pivot_indicators(inputs.market_long(spark, d), ["cut", "label"], "indicator", "value", market.PUBLISHED, market.PUBLISHED_NAMES)


def calendar(spark: SparkSession, d: str) -> DataFrame:
    """P5: months with calendar attributes and a guarded price."""
    return enrich_calendar(inputs.order_months(spark, d), "period_date", ("price", "value", "qty", None))


def customers_of_orders(spark: SparkSession, d: str) -> DataFrame:
    """J6 then J3: orders with their customer, and with the nation attached."""
    c = inputs.table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    n = inputs.table(spark, d, "nation").select("n_nationkey", "n_name")
    wide = denormalise(_orders(spark, d).select("o_orderkey", "o_custkey"), c, "o_custkey")
    return attach(wide, n, "n_nationkey").select("o_orderkey", "o_custkey", "n_nationkey", "n_name")
