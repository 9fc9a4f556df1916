"""Set operators (U1–U8): unions, multiset difference, audited dedup,
calendar gaps, catalogue coverage and date spines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset difference both ways, tagged with the side it is missing from.

    Rows are counted per distinct row on each side and compared (one
    aggregate per side plus a full outer join), so duplicates matter.
    """
    cols = a.columns
    ca = a.groupBy(*cols).agg(F.count(F.lit(1)).alias("_na")).alias("_l")
    cb = b.select(*cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("_nb")).alias("_r")
    j = ca.join(cb, [F.col(f"_l.`{c}`").eqNullSafe(F.col(f"_r.`{c}`")) for c in cols], "full_outer")
    j = j.select(*[F.coalesce(F.col(f"_l.`{c}`"), F.col(f"_r.`{c}`")).alias(c) for c in cols],
                 F.coalesce(F.col("_na"), F.lit(0)).alias("_na"),
                 F.coalesce(F.col("_nb"), F.lit(0)).alias("_nb"))
    j = j.filter(F.col("_na") != F.col("_nb"))
    return j.select(*cols,
                    F.when(F.col("_na") > F.col("_nb"), F.lit("only_left")).otherwise(F.lit("only_right"))
                    .alias("side"),
                    F.abs(F.col("_na") - F.col("_nb")).alias("copies"))


def dedup(df: DataFrame, cols=None, drop_all_null: bool = True) -> tuple[DataFrame, DataFrame]:
    """Drop empty rows, then exact duplicates (on ``cols`` or all columns).

    Returns (deduplicated, audit) where the audit row holds initial rows,
    empty rows removed, duplicates removed and final rows, computed in one
    aggregate.  With ``cols`` the kept row per key is the smallest row
    (``min_by`` over the full row), so the result is deterministic.
    """
    keys = list(cols or df.columns)
    nonempty = df.dropna(how="all") if drop_all_null else df
    if cols:
        rest = [c for c in df.columns if c not in keys]
        if rest:
            out = nonempty.groupBy(*keys).agg(
                F.min_by(F.struct(*rest), F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
        else:
            out = nonempty.select(*keys).distinct()
        out = out.select(*df.columns)
    else:
        out = nonempty.distinct()
    per_key = nonempty.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    audit = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("after_empty"),
                        F.count(F.lit(1)).alias("final_rows"))
    initial = df.select(F.count(F.lit(1))).scalar()
    audit = audit.select(initial.alias("initial_rows"),
                         (initial - F.col("after_empty")).alias("empty_removed"),
                         (F.col("after_empty") - F.col("final_rows")).alias("duplicates_removed"),
                         "final_rows")
    return out, audit


def distinct(df: DataFrame) -> DataFrame:
    """U5."""
    return df.distinct()


def calendar_gaps(df: DataFrame, date_col: str, by=()) -> DataFrame:
    """First-of-month periods between min and max (per ``by`` group) that
    have no row.  The expected calendar is generated from the (tiny) bounds,
    never collected; observed months are a distinct projection."""
    by = list(by)
    bounds = df.groupBy(*by).agg(F.min(date_col).alias("a"), F.max(date_col).alias("b"))
    expected = bounds.filter(F.col("a").isNotNull()).select(
        *by, F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias(date_col))
    seen = df.select(*by, date_col).distinct()
    return expected.join(seen, by + [date_col], "left_anti")


def coverage(codes: DataFrame, catalogue: DataFrame, key: str) -> DataFrame:
    """Codes without a catalogue entry and catalogue entries without codes."""
    c = codes.select(key).distinct()
    k = catalogue.select(key).distinct()
    missing = c.join(k, key, "left_anti").withColumn("issue", F.lit("code_without_label"))
    unused = k.join(c, key, "left_anti").withColumn("issue", F.lit("label_without_code"))
    return missing.unionByName(unused)


def date_spine(*dfs: DataFrame, col: str = "period_date") -> DataFrame:
    """U8: distinct union of the date column of several facts."""
    return union_all(*[d.select(col) for d in dfs]).distinct()
