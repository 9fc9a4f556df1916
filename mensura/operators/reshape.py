"""Reshape, projection and filter operators.

All are lazy DataFrame -> DataFrame functions.  Audits that the reference
computes with one job per column are folded into a single aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns, parse_date
from ..functions.numbers import parse_int, parse_number, ratio, row_sum
from ..functions.text import is_non_analytic


# -- F1..F6 -----------------------------------------------------------------

def drop_all_null(df: DataFrame, cols=None) -> DataFrame:
    """keep rows with at least one non-null value."""
    return df.dropna(how="all", subset=cols)


def until(df: DataFrame, col: str, cutoff) -> DataFrame:
    """keep periods on or before the report cutoff."""
    return df.filter(F.col(col) <= F.lit(cutoff).cast("date"))


def drop_null_obs(df: DataFrame, col: str) -> DataFrame:
    """drop NULL observations (count them with :func:`null_obs_audit`)."""
    return df.filter(F.col(col).isNotNull())


def null_obs_audit(df: DataFrame, col: str) -> DataFrame:
    """F3 audit: rows, null observations, kept observations, in one job."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(F.col(col).isNull()).alias("null_obs"),
                  F.count(col).alias("kept_obs"))


def drop_labels(df: DataFrame, col: str, pattern: str | None = None) -> DataFrame:
    """drop blank and non-analytic labels (totals, rests, world)."""
    pred = is_non_analytic(col) if pattern is None else is_non_analytic(col, pattern)
    return df.filter(~pred)


def any_null(cols) -> Column:
    """OR of ``isNull`` over the given columns."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


# -- F7 typed projection with one-pass failure audit ----------------------

CONVERTERS = {
    "double": parse_number,
    "int": parse_int,
    "date": parse_date,
    "string": lambda c: c,
}


def apply_types(df: DataFrame, contract) -> tuple[DataFrame, DataFrame]:
    """convert columns by ``contract`` [(name, type)], keep contract order.

    Returns (typed, audit).  A failure is a non-null source whose converted
    value is NULL.  The audit is one aggregate over all columns: rows
    (column, type, non_null_source, failures).
    """
    typed_cols, fails = [], []
    for name, typ in contract:
        conv = CONVERTERS[typ](F.col(name))
        typed_cols.append(conv.alias(name))
        fails.append((name, typ, F.count_if(F.col(name).isNotNull()),
                      F.count_if(F.col(name).isNotNull() & conv.isNull())))
    typed = df.select(*typed_cols)
    aggs = []
    for i, (_, _, nn, fl) in enumerate(fails):
        aggs += [nn.alias(f"nn{i}"), fl.alias(f"fl{i}")]
    wide = df.agg(*aggs)
    audit = wide.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), F.lit(t).alias("type"),
                 F.col(f"nn{i}").alias("non_null_source"), F.col(f"fl{i}").alias("failures"))
        for i, (n, t, _, _) in enumerate(fails)])).alias("a")).select("a.*")
    return typed, audit


def to_contract(df: DataFrame, mapping: dict, order) -> DataFrame:
    """F8: rename to canonical names and select in contract order."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()]).select(*order)


# -- P1..P5 -------------------------------------------------------------------

def pivot_months(df: DataFrame, year_col: str, month_col: str, value_col: str,
                 month_cols, total_col: str | None = None) -> DataFrame:
    """Year x month long -> one row per year with one column per month.

    The month values are listed, so Spark skips the distinct-values job; the
    pivot is a single grouped aggregate.
    """
    out = df.groupBy(year_col).pivot(month_col, list(range(1, len(month_cols) + 1))) \
        .agg(F.max(value_col))
    out = out.select(year_col, *[F.col(str(i)).alias(c) for i, c in enumerate(month_cols, 1)])
    if total_col:
        out = out.withColumn(total_col, row_sum(month_cols))
    return out


def unpivot_months(df: DataFrame, year_col: str, month_cols, cutoff=None,
                   value_col: str = "value") -> DataFrame:
    """Year x 12 month columns -> (period_date, year, month, value).

    Month position in ``month_cols`` gives the month number; rows after the
    cutoff (F2) and NULL observations (F3) are dropped.
    """
    arr = F.array(*[F.struct(F.lit(i).alias("month"), F.col(c).cast("double").alias(value_col))
                    for i, c in enumerate(month_cols, 1)])
    long = df.select(F.col(year_col).cast("int").alias("year"), F.inline(arr))
    long = long.withColumn("period_date", F.make_date("year", "month", F.lit(1)))
    if cutoff is not None:
        long = until(long, "period_date", cutoff)
    long = drop_null_obs(long, value_col)
    return long.select("period_date", "year", "month", value_col)


def unpivot_indicators(df: DataFrame, key: str, value_col: str = "value",
                       indicator_col: str = "indicator") -> DataFrame:
    """All non-key columns -> (key, indicator, value); NULL key/value dropped."""
    vals = [c for c in df.columns if c != key]
    long = df.select(F.col(key), *[F.col(c).cast("double").alias(c) for c in vals]) \
        .unpivot([key], vals, indicator_col, value_col)
    return long.filter(F.col(key).isNotNull() & F.col(value_col).isNotNull())


def pivot_units(df: DataFrame, keys, unit_col: str, value_col: str, units) -> DataFrame:
    """One column per unit (fixed list); max is exact since keys are unique."""
    return df.groupBy(*keys).pivot(unit_col, list(units)).agg(F.max(value_col))


def pivot_indicators(df: DataFrame, key, indicator_col: str, value_col: str,
                     indicators, names=None) -> DataFrame:
    """One column per published indicator (fixed list)."""
    keys = [key] if isinstance(key, str) else list(key)
    out = df.filter(F.col(indicator_col).isin(list(indicators))) \
        .groupBy(*keys).pivot(indicator_col, list(indicators)).agg(F.max(value_col))
    if names:
        out = out.select(*keys, *[F.col(i).alias(n) for i, n in zip(indicators, names)])
    return out


def enrich_calendar(df: DataFrame, date_col: str, price=None) -> DataFrame:
    """P5: calendar attributes (+ optional guarded unit price)."""
    cal = calendar_columns(date_col)
    cols = {k: v for k, v in cal.items() if k not in df.columns}
    out = df.withColumns(cols)
    if price:
        name, num, den, factor = price
        out = out.withColumn(name, ratio(num, den, "positive", factor))
    return out
