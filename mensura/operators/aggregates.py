"""Aggregate operators (A3–A14) and ordering helpers.

Every operator is one grouped or global aggregate (partial aggregation on
the map side, then a small shuffle).  Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import MEASURE_SCALE, exact_sum


def profile(df: DataFrame, distinct=(), minmax=(), sums=()) -> DataFrame:
    """A3: one-row profile: rows, distinct counts, min/max, exact sums."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_distinct(c).alias(f"distinct_{c}") for c in distinct]
    for c in minmax:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    aggs += [exact_sum(c, MEASURE_SCALE).alias(f"sum_{c}") for c in sums]
    return df.agg(*aggs)


def density(df: DataFrame, key: str) -> DataFrame:
    """A4: rows per key, then min / max / avg of that count (two-level agg)."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("keys"), F.min("n").alias("min_rows"),
                   F.max("n").alias("max_rows"),
                   (F.sum("n").cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_rows"))


def null_cells(df: DataFrame, cols=None) -> DataFrame:
    """A5: NULL count per column, all columns in one job, as (column, nulls) rows."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"))
        for i, c in enumerate(cols)])).alias("x")).select("x.*")


def duplicate_keys(df: DataFrame, keys=None) -> DataFrame:
    """Key groups occurring more than once (all columns when ``keys`` is None)."""
    keys = list(keys or df.columns)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def conflicts(df: DataFrame, key, attr: str) -> DataFrame:
    """Keys with more than one distinct ``attr`` value."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count_distinct(attr).alias("n_distinct")) \
        .filter(F.col("n_distinct") > 1)


def label_list(df: DataFrame, keys, col: str, out: str, sep: str = " | ") -> DataFrame:
    """Sorted distinct labels per key joined by ``sep`` (groups are small)."""
    return df.groupBy(*keys).agg(F.concat_ws(sep, F.sort_array(F.collect_set(col))).alias(out))


def histogram(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    """Rows per value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def totals(df: DataFrame, by: str, sums: dict, total_label: str = "TOTAL") -> DataFrame:
    """A10: per-group totals plus a grand-total row (ROLLUP)."""
    aggs = [expr.alias(name) for name, expr in sums.items()]
    out = df.rollup(by).agg(*aggs, F.grouping(by).alias("_g"))
    return out.withColumn(by, F.when(F.col("_g") == 1, F.lit(total_label)).otherwise(F.col(by))) \
        .drop("_g")


def catalogue(df: DataFrame, code: str, date: str) -> DataFrame:
    """Per code its first and last period and number of rows."""
    return df.groupBy(code).agg(F.min(date).alias("first_period"), F.max(date).alias("last_period"),
                                F.count(F.lit(1)).alias("rows"))


def latest_by(df: DataFrame, key, col: str, out: str | None = None) -> DataFrame:
    """Max of ``col`` per key."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.max(col).alias(out or f"latest_{col}"))


def conservation(a: DataFrame, b: DataFrame, measures, tolerances) -> DataFrame:
    """Σ measure in ``a`` vs Σ in ``b`` per measure, with tolerance verdict.

    Two global aggregates (one job each side), combined as scalar subqueries.
    """
    sa = a.agg(*[exact_sum(m, MEASURE_SCALE).alias(m) for m in measures])
    sb = b.agg(*[exact_sum(m, MEASURE_SCALE).alias(m) for m in measures])
    rows = []
    for m, tol in zip(measures, tolerances):
        va, vb = sa.select(m).scalar(), sb.select(m).scalar()
        rows.append(F.struct(F.lit(m).alias("measure"), va.alias("sum_source"), vb.alias("sum_target"),
                             F.abs(va - vb).alias("abs_diff"),
                             (F.abs(va - vb) <= F.lit(float(tol))).alias("conserved")))
    return a.sparkSession.range(1).select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def group_totals(df: DataFrame, keys, sums) -> DataFrame:
    """Exact grouped totals."""
    return df.groupBy(*keys).agg(*[exact_sum(c, MEASURE_SCALE).alias(f"total_{c}") for c in sums])


# -- L1..L5 ------------------------------------------------------------------

def ordered(df: DataFrame, keys) -> DataFrame:
    """L1: total output order (use only at the export boundary)."""
    return df.orderBy(*keys)


def latest_row(df: DataFrame, key: str, cols=None) -> DataFrame:
    """L2: the row with the greatest ``key`` as a one-row aggregate (max_by)."""
    cols = list(cols or df.columns)
    return df.agg(F.max_by(F.struct(*cols), F.col(key)).alias("r")).select("r.*")


def top_of_latest(df: DataFrame, period: str, measure: str, tie: str, cols=None,
                  filter_col: Column | None = None) -> DataFrame:
    """L3/L4: within the latest period, the row with the largest measure
    (nulls last, ``tie`` ascending) — a one-row aggregate, no global sort."""
    d = df if filter_col is None else df.filter(filter_col)
    last = d.select(F.max(period)).scalar()
    cand = d.filter(F.col(period) == last)
    cols = list(cols or d.columns)
    ranked = cand.withColumn("_rk", F.row_number().over(
        Window.partitionBy(period).orderBy(F.col(measure).desc_nulls_last(), F.col(tie).asc())))
    return ranked.filter(F.col("_rk") == 1).select(*cols)


def is_empty(df: DataFrame) -> Column | bool:
    """Existence test that reads at most one row."""
    return df.isEmpty()
