"""Generic aggregate / set / join / ordering operators (A3–A14, U2–U7,
J10, J11, L2, L3, P2) applied to whole driver tables and derived tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..functions.numbers import MEASURE_SCALE, exact_sum
from ..operators import aggregates as A
from ..operators import sets as U
from ..operators.reshape import unpivot_indicators
from ..operators.series import fk_orphans, reconcile_totals
from . import inputs, market, national, resources, subcode


def profile_subcode(spark: SparkSession, d: str) -> DataFrame:
    """A3: whole-table profile of the refined sub-code fact."""
    return A.profile(inputs.subcode_fact(spark, d), distinct=["subcode", "period_date"],
                     minmax=["period_date"], sums=["tonnes", "fob_usd"])


def density_subcode(spark: SparkSession, d: str) -> DataFrame:
    """A4: rows per period, then min/max/avg."""
    return A.density(inputs.subcode_fact(spark, d), "period_date")


def null_cells_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    """A5: NULL cells per column of the reconciliation audit (one job)."""
    return A.null_cells(national.reconciliation_audit(spark, d))


def duplicate_documents(spark: SparkSession, d: str) -> DataFrame:
    """Exact duplicate texts (keyed by content hash) and their copies."""
    docs = inputs.table(spark, d, "documents").select(F.sha2("text", 256).alias("text_sha"))
    return A.duplicate_keys(docs, ["text_sha"])


def conflicting_languages(spark: SparkSession, d: str) -> DataFrame:
    """Sources whose documents are labelled with more than one language."""
    return A.conflicts(inputs.table(spark, d, "documents").select("source", "lang"), "source", "lang")


def languages_per_source(spark: SparkSession, d: str) -> DataFrame:
    """Sorted distinct languages per source joined by `` | ``."""
    return A.label_list(inputs.table(spark, d, "documents"), ["source"], "lang", "languages")


def event_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Events per type."""
    return A.histogram(inputs.table(spark, d, "events"), "event_type", "events")


def event_totals(spark: SparkSession, d: str) -> DataFrame:
    """A10: per-type totals plus a grand total row (ROLLUP)."""
    e = inputs.table(spark, d, "events")
    return A.totals(e, "event_type", {"events": F.count(F.lit(1)), "value_total": exact_sum("value", MEASURE_SCALE)})


def subcode_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """first/last period and rows per sub-code."""
    return A.catalogue(inputs.subcode_fact(spark, d), "subcode", "period_date")


def latest_year_by_cut(spark: SparkSession, d: str) -> DataFrame:
    """Latest year per cut in the market table."""
    return A.latest_by(market.market_all(spark, d), "cut", "year", "latest_year")


def conservation_subcode(spark: SparkSession, d: str) -> DataFrame:
    """Measure totals conserved from the refined fact to the gold fact."""
    return A.conservation(inputs.subcode_fact(spark, d), subcode.fact(spark, d),
                          ["tonnes", "fob_thousands", "fob_usd"], [1e-6, 1e-6, 1e-3])


def market_group_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals per cut and year of the detailed market."""
    return A.group_totals(market.market_base(spark, d), ["cut", "year"], ["qty", "value"])


def snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    """Multiset difference of (url, content hash) between runs."""
    prev = resources.previous_run(spark, d).select("source_url", "sha256")
    cur = resources.records(spark, d).filter(F.col("sha256").isNotNull()).select("source_url", "sha256")
    return U.diff(cur, prev)


def dedup_documents(spark: SparkSession, d: str) -> DataFrame:
    """Audited exact dedup of (source, lang, content hash)."""
    docs = inputs.table(spark, d, "documents").select("source", "lang", F.sha2("text", 256).alias("text_sha"))
    return U.dedup(docs)[1]


def dedup_subset(spark: SparkSession, d: str) -> DataFrame:
    """U4: dedup on a key subset keeping the smallest row (deterministic)."""
    docs = inputs.table(spark, d, "documents").select(F.sha2("text", 256).alias("text_sha"), "doc_id", "lang")
    return U.dedup(docs, ["text_sha"])[0]


def order_status_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Months without orders, per customer, inside each customer's range."""
    o = inputs.table(spark, d, "orders").select("o_custkey", month_start("o_orderdate").alias("period_date"))
    return U.calendar_gaps(o, "period_date", ["o_custkey"])


def label_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Sub-codes without a short label and labels without sub-codes."""
    return U.coverage(inputs.subcode_fact(spark, d), subcode.catalogue(spark, d), "subcode")


def label_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Documents that no quality label refers to."""
    docs = inputs.table(spark, d, "documents").select("doc_id", "source", "lang")
    return fk_orphans(docs, inputs.table(spark, d, "labels"), "doc_id")


def totals_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    """J11 (full outer): Σ destinations vs reported totals, unmatched keys shown."""
    totals = market.history(spark, d).select("cut", "year", "value")
    return reconcile_totals(market.market_base(spark, d), totals, ["cut", "year"], "value", 1.0, "full_outer")


def latest_month(spark: SparkSession, d: str) -> DataFrame:
    """L2: latest row of the national monthly serving (max_by, no sort)."""
    return A.latest_row(national.national_monthly(spark, d), "period_date",
                        ["period_date", "qty", "value", "price", "yoy_value"])


def top_subcode_latest(spark: SparkSession, d: str) -> DataFrame:
    """L3/L4: the top sub-code by FOB in the latest period."""
    return A.top_of_latest(subcode.enriched(spark, d), "period_date", "fob_usd", "subcode",
                           ["period_date", "subcode", "fob_usd"])


def indicators_long(spark: SparkSession, d: str) -> DataFrame:
    """A wide table per cut and destination back to (key, indicator, value);
    a column for every year that the table has (its years are few: they are
    read first, so that none is left out)."""
    every = market.market_all(spark, d)
    years = sorted(r["year"] for r in every.select("year").distinct().collect())
    key = F.concat("cut", F.lit("/"), "dest").alias("market")
    wide = every.select(key, "year", "value").groupBy("market").pivot("year", years).agg(F.max("value"))
    return unpivot_indicators(wide.select("market", *[F.col(str(y)).alias(f"value_{y}") for y in years]), "market")
