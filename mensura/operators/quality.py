"""Data-quality rules as data (D-* families).

A :class:`Rule` is a per-row violation predicate (plus the rows it checks).
:func:`evaluate` compiles any number of row rules on one table into ONE
aggregate job and returns a rules DataFrame::

    rule, table, severity, status, checked, violations, detail

Rules that need grouping (key uniqueness, partition sums, calendar gaps,
referential integrity) are built by the ``*_rule`` helpers, each one grouped
aggregate or anti-join.  :func:`gate` raises when a CRITICAL rule fails,
reading only the (bounded) failing rule rows.

Status: 0 violations -> PASS; otherwise CRITICAL -> FAIL, WARNING -> WARN.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRITICAL = "CRITICAL"
WARNING = "WARNING"

#: Upper bounds of a share as a fraction and as a percentage.
SHARE_TOPS = (1.000001, 100.0001)

RESULT_COLUMNS = ["rule", "table", "severity", "status", "checked", "violations", "detail"]


@dataclass(frozen=True)
class Rule:
    rule: str
    severity: str
    violation: Column
    eligible: Column | None = None
    detail: str = ""


def _status(sev: Column, viol: Column) -> Column:
    return (F.when(viol == 0, F.lit("PASS"))
            .when(sev == CRITICAL, F.lit("FAIL"))
            .otherwise(F.lit("WARN")))


def _finish(df: DataFrame) -> DataFrame:
    return df.select("rule", "table", "severity",
                     _status(F.col("severity"), F.col("violations")).alias("status"),
                     F.col("checked").cast("bigint").alias("checked"),
                     F.col("violations").cast("bigint").alias("violations"), "detail")


def evaluate(df: DataFrame, table: str, rules) -> DataFrame:
    """All row rules of one table in a single aggregate job."""
    aggs = []
    for i, r in enumerate(rules):
        elig = F.lit(True) if r.eligible is None else F.coalesce(r.eligible, F.lit(False))
        aggs.append(F.count_if(elig).alias(f"c{i}"))
        aggs.append(F.count_if(elig & F.coalesce(r.violation, F.lit(False))).alias(f"v{i}"))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(r.rule).alias("rule"), F.lit(table).alias("table"),
                              F.lit(r.severity).alias("severity"), F.col(f"c{i}").alias("checked"),
                              F.col(f"v{i}").alias("violations"), F.lit(r.detail).alias("detail"))
                     for i, r in enumerate(rules)])
    return _finish(wide.select(F.inline(rows)))


def _one(frame: DataFrame, rule: str, table: str, severity: str, detail: str) -> DataFrame:
    """Wrap a one-row (checked, violations) frame as a rule row."""
    return _finish(frame.select(F.lit(rule).alias("rule"), F.lit(table).alias("table"),
                                F.lit(severity).alias("severity"), "checked", "violations",
                                F.lit(detail).alias("detail")))


def count_rule(frame: DataFrame, rule: str, table: str, severity: str, detail: str = "") -> DataFrame:
    """A rule row from a one-row (checked, violations) aggregate."""
    return _one(frame, rule, table, severity, detail)


def subset_rule(population: DataFrame, violators: DataFrame, table: str, rule: str,
                severity: str = CRITICAL, detail: str = "") -> DataFrame:
    """checked = rows of ``population``, violations = rows of ``violators``
    (e.g. an anti-join of the population against a catalogue)."""
    checked = population.select(F.count(F.lit(1))).scalar()
    viol = violators.select(F.count(F.lit(1))).scalar()
    frame = population.sparkSession.range(1).select(checked.alias("checked"), viol.alias("violations"))
    return _one(frame, rule, table, severity, detail)


def unique_rule(df: DataFrame, table: str, rule: str, keys, severity: str = CRITICAL,
                detail: str = "") -> DataFrame:
    """Key uniqueness: checked = rows, violations = key groups seen more than once."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    frame = g.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
                  F.count_if(F.col("n") > 1).alias("violations"))
    return _one(frame, rule, table, severity, detail or "keys: " + ", ".join(keys))


def conflict_rule(df: DataFrame, table: str, rule: str, key, attr: str,
                  severity: str = WARNING, detail: str = "") -> DataFrame:
    """One attribute value per key: violations = keys with >1 distinct value."""
    keys = [key] if isinstance(key, str) else list(key)
    g = df.groupBy(*keys).agg(F.count_distinct(attr).alias("n"))
    frame = g.agg(F.count(F.lit(1)).alias("checked"), F.count_if(F.col("n") > 1).alias("violations"))
    return _one(frame, rule, table, severity, detail or f"{attr} per {', '.join(keys)}")


def not_empty_rule(df: DataFrame, table: str, rule: str, severity: str = CRITICAL) -> DataFrame:
    frame = df.agg(F.lit(1).alias("checked"),
                   F.when(F.count(F.lit(1)) == 0, F.lit(1)).otherwise(F.lit(0)).alias("violations"))
    return _one(frame, rule, table, severity, "dataset has rows")


def partition_sum_rule(df: DataFrame, table: str, rule: str, partition, measure: str,
                       expected: float, tol: float, when_total_positive: str | None = None,
                       severity: str = CRITICAL, detail: str = "") -> DataFrame:
    """Σ measure per partition equals ``expected`` within ``tol`` (e.g. shares sum to 1).

    ``when_total_positive``: only partitions where Σ of that column > 0 are checked.
    """
    aggs = [F.sum(measure).alias("_s")]
    if when_total_positive:
        aggs.append(F.sum(when_total_positive).alias("_t"))
    g = df.groupBy(*partition).agg(*aggs)
    elig = (F.col("_t") > 0) if when_total_positive else F.lit(True)
    frame = g.agg(F.count_if(elig).alias("checked"),
                  F.count_if(elig & (F.abs(F.coalesce(F.col("_s"), F.lit(0.0)) - F.lit(expected)) > F.lit(tol)))
                  .alias("violations"))
    return _one(frame, rule, table, severity, detail or f"sum({measure}) per partition = {expected}")


def share_range_rule(df: DataFrame, table: str, rule: str, share: str) -> DataFrame:
    """Shares lie within their scale, [0, 1] or [0, 100] by the largest of them
    (D-A5).  A table without shares gives a WARNING row that checked nothing."""
    v = F.col(share)
    outside = [F.count_if((v < 0) | (v > F.lit(top))) for top in SHARE_TOPS]
    g = df.agg(F.count(v).alias("n"), F.max(v).alias("top"), outside[0].alias("fraction"), outside[1].alias("percent"))
    fraction = F.col("top") <= F.lit(SHARE_TOPS[0])
    return _finish(g.select(
        F.lit(rule).alias("rule"), F.lit(table).alias("table"),
        F.when(F.col("n") == 0, F.lit(WARNING)).otherwise(F.lit(CRITICAL)).alias("severity"), F.col("n").alias("checked"),
        F.when(F.col("n") == 0, F.lit(0)).when(fraction, F.col("fraction")).otherwise(F.col("percent")).alias("violations"),
        F.when(F.col("n") == 0, F.lit("no share to check")).when(fraction, F.lit("scale [0, 1]")).otherwise(F.lit("scale [0, 100]")).alias("detail")))


def key_rules(df: DataFrame, table: str, foreign: dict[str, tuple[str, DataFrame, str]], grain: tuple[str, list[str]] | list | None = None,
              severity: str = CRITICAL) -> DataFrame:
    """All foreign keys and the grain of a table in one pass (D-GA-F, D-GA-R).

    ``foreign``: {rule: (column, dimension, its key)}; ``grain``: (rule,
    columns), or a list of them.  Every row gives one (rule, key) pair per rule, the dimensions
    give theirs, and one aggregate over the pairs - combined before the
    shuffle, so a key of a third of all rows is one row - tells rows whose key
    no dimension has (null among them) and grains seen more than once.
    """
    from ..functions.hashing import canonical_text

    spark = df.sparkSession
    listed = [F.struct(F.lit(rule).alias("rule"), F.col(c).cast("string").alias("key")) for rule, (c, _, _) in foreign.items()]
    details = {rule: f"foreign key: {c}" for rule, (c, _, _) in foreign.items()}
    grains = grain if isinstance(grain, list) else [grain] if grain else []
    for rule, columns in grains:
        listed.append(F.struct(F.lit(rule).alias("rule"), canonical_text(df, columns).alias("key")))
        details[rule] = "grain: " + ", ".join(columns)
    pairs = df.select(F.inline(F.array(*listed))).select("rule", "key", F.lit(1).alias("n"), F.lit(False).alias("known"))
    for rule, (_, dim, key) in foreign.items():
        pairs = pairs.unionByName(dim.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"), F.lit(0).alias("n"), F.col(key).isNotNull().alias("known")))
    g = pairs.groupBy("rule", "key").agg(F.sum("n").alias("n"), F.max("known").alias("known"))
    is_grain = F.col("rule").isin([rule for rule, _ in grains])
    found = g.groupBy("rule").agg(F.sum("n").alias("checked"), F.sum(F.when(is_grain, (F.col("n") > 1).cast("long")).when(~F.col("known"), F.col("n")).otherwise(0)).alias("violations"))
    rules = spark.createDataFrame([(r, table, severity, d) for r, d in details.items()], "_rule string, table string, severity string, detail string")
    return _finish(rules.join(found, F.col("_rule") == F.col("rule"), "left").select(
        F.col("_rule").alias("rule"), "table", "severity", F.coalesce("checked", F.lit(0)).alias("checked"), F.coalesce("violations", F.lit(0)).alias("violations"), "detail"))


def contradiction_rule(df: DataFrame, table: str, rule: str, key: str, attrs: list[str], severity: str = CRITICAL) -> DataFrame:
    """One value of every attribute per key (D-GB-C): violations are keys with
    more than one value of any; smallest and greatest value tell."""
    g = df.groupBy(key).agg(*[f(a).alias(f"{p}_{a}") for a in attrs for p, f in (("lo", F.min), ("hi", F.max))])
    clash = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"lo_{a}") != F.col(f"hi_{a}"), F.lit(False)) for a in attrs])
    frame = g.agg(F.count(F.lit(1)).alias("checked"), F.count_if(clash).alias("violations"))
    return _one(frame, rule, table, severity, f"{', '.join(attrs)} per {key}")


def orphan_rule(fact: DataFrame, dim: DataFrame, table: str, rule: str, on,
                severity: str = CRITICAL, detail: str = "") -> DataFrame:
    """Referential integrity (J10): fact rows whose key is absent from the dimension."""
    keys = [on] if isinstance(on, str) else list(on)
    orphans = fact.join(dim.select(*keys).distinct(), keys, "left_anti")
    checked = fact.select(F.count(F.lit(1))).scalar()
    viol = orphans.select(F.count(F.lit(1))).scalar()
    frame = fact.sparkSession.range(1).select(checked.alias("checked"), viol.alias("violations"))
    return _one(frame, rule, table, severity, detail or "foreign key: " + ", ".join(keys))


def count_equal_rule(a: DataFrame, b: DataFrame, table: str, rule: str,
                     severity: str = CRITICAL, detail: str = "") -> DataFrame:
    """Row counts of two tables are equal (1 check, 1 violation if not)."""
    ca, cb = a.select(F.count(F.lit(1))).scalar(), b.select(F.count(F.lit(1))).scalar()
    frame = a.sparkSession.range(1).select(F.lit(1).alias("checked"),
                                           F.when(ca == cb, F.lit(0)).otherwise(F.lit(1)).alias("violations"))
    return _one(frame, rule, table, severity, detail or "row counts equal")


def schema_rule(df: DataFrame, table: str, rule: str, forbidden=(), required=(),
                severity: str = CRITICAL, detail: str = "") -> DataFrame:
    """Columns that must be absent / present (schema only, no data read)."""
    cols = set(df.columns)
    bad = sum(1 for c in forbidden if c in cols) + sum(1 for c in required if c not in cols)
    frame = df.sparkSession.range(1).select(F.lit(len(forbidden) + len(required)).alias("checked"),
                                            F.lit(bad).alias("violations"))
    return _one(frame, rule, table, severity, detail or "schema contract")


def calendar_gap_rule(df: DataFrame, table: str, rule: str, date_col: str,
                      severity: str = CRITICAL) -> DataFrame:
    """No missing month between the first and last period."""
    from .sets import calendar_gaps
    expected = df.agg(F.min(date_col).alias("a"), F.max(date_col).alias("b")) \
        .select(F.when(F.col("a").isNull(), F.lit(0))
                .otherwise(F.months_between("b", "a").cast("int") + 1).alias("n"))
    checked = expected.select("n").scalar()
    viol = calendar_gaps(df, date_col).select(F.count(F.lit(1))).scalar()
    frame = df.sparkSession.range(1).select(checked.alias("checked"), viol.alias("violations"))
    return _one(frame, rule, table, severity, "no missing month")


def union_results(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def gate(results: DataFrame) -> DataFrame:
    """Raise when any CRITICAL rule failed; reads only the failing rule rows."""
    failed = results.filter(F.col("status") == "FAIL").select("rule", "table", "violations").collect()
    if failed:
        msg = ", ".join(f"{r['table']}.{r['rule']}={r['violations']}" for r in failed)
        raise RuntimeError(f"blocking data-quality rules failed: {msg}")
    return results
