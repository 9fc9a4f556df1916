"""Series operators: alignment, reconciliation, shift/lag growth, rollups,
shares and ranks (J1, J2, J7, J8, A1, A2, N1–N10).

Scale notes
-----------
* Growth against the previous month / same month last year (J7) and the
  previous year (J8) are equi-joins on shifted keys, not unpartitioned
  windows: an ``orderBy`` window without ``partitionBy`` runs in one task.
* Shares (N7) are computed as a grouped total joined back on the partition
  key: the totals are partially aggregated map-side and are tiny, so AQE
  broadcasts them; no single task ever holds a whole period.
* Ranks (N8-N10) number rows within ranges of the order key and add the
  ranges before, so that no task holds a whole period.
* Raw lags use windows, on aggregated grains whose partitions are a code's
  or label's years.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import MEASURE_SCALE, exact_sum, growth, ratio


def align(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """Full outer alignment of two measures on ``key``."""
    return a.join(b, on=key, how="full_outer")


def reconcile(direct: DataFrame, matrix: DataFrame, key: str, measures,
              abs_tol: float, rel_tol: float, direct_source: str = "direct",
              matrix_source: str = "matrix", direct_suffix: str = "_direct",
              matrix_suffix: str = "_matrix", state_col: str = "reconciliation_state") -> DataFrame:
    """Full outer reconciliation of two sources of the same measures.

    For each measure ``m``: ``m_direct``, ``m_matrix``, ``diff_abs_m`` (only
    when both sides exist), three-valued ``match_m`` (NULL = not comparable),
    canonical ``m = coalesce(direct, matrix)`` and ``source_m``.  The state is
    COINCIDE when every side exists and matches, otherwise
    DIFIERE_PRIORIZA_DIRECTO when both sources hold something, SOLO_DIRECTO or
    SOLO_MATRIZ.
    """
    j = direct.join(matrix, on=key, how="full_outer")
    cols = {}
    all_present, all_match, any_direct, any_matrix = [], [], [], []
    for m in measures:
        d, x = F.col(m + direct_suffix), F.col(m + matrix_suffix)
        cols[f"diff_abs_{m}"] = F.when(d.isNotNull() & x.isNotNull(), F.abs(d - x))
        cols[f"match_{m}"] = F.when(d.isNull() | x.isNull(), F.lit(None).cast("boolean")).otherwise(
            F.abs(d - x) <= F.greatest(F.lit(float(abs_tol)), F.abs(d) * F.lit(float(rel_tol))))
        all_present += [d.isNotNull(), x.isNotNull()]
        all_match.append(F.coalesce(F.col(f"match_{m}"), F.lit(False)))
        any_direct.append(d.isNotNull())
        any_matrix.append(x.isNotNull())
        cols[m] = F.coalesce(d, x)
        cols[f"source_{m}"] = F.when(d.isNotNull(), F.lit(direct_source)).otherwise(F.lit(matrix_source))
    j = j.withColumns({k: v for k, v in cols.items() if k.startswith("diff_abs_") or k.startswith("match_")})

    def _and(xs):
        out = xs[0]
        for x in xs[1:]:
            out = out & x
        return out

    def _or(xs):
        out = xs[0]
        for x in xs[1:]:
            out = out | x
        return out

    state = (F.when(_and(all_present) & _and(all_match), F.lit("COINCIDE"))
             .when(_or(any_direct), F.when(_or(any_matrix), F.lit("DIFIERE_PRIORIZA_DIRECTO"))
                   .otherwise(F.lit("SOLO_DIRECTO")))
             .otherwise(F.lit("SOLO_MATRIZ")))
    rest = {k: v for k, v in cols.items() if not (k.startswith("diff_abs_") or k.startswith("match_"))}
    return j.withColumns({**rest, state_col: state})


def growth_by_shift(df: DataFrame, date_col: str, measures, months: int,
                    suffix: str, rate_prefix: str, require: str = "nonzero") -> DataFrame:
    """Attach the value ``months`` earlier by a left join on the shifted key.

    Adds ``<m><suffix>`` (neighbour value) and ``<rate_prefix><m>`` (growth).
    A missing neighbour month gives NULL growth, never a wrong neighbour.
    """
    prev = df.select(F.add_months(F.col(date_col), months).alias(date_col),
                     *[F.col(m).alias(m + suffix) for m in measures])
    out = df.join(prev, on=date_col, how="left")
    return out.withColumns({rate_prefix + m: growth(F.col(m), F.col(m + suffix), require)
                            for m in measures})


def growth_by_year(df: DataFrame, year_col: str, measures, complete_col: str | None = None,
                   suffix: str = "_prev_year", rate_prefix: str = "yoy_",
                   require: str = "nonzero", keep_prev: bool = False, keys=(),
                   ratio_minus_one: bool = False) -> DataFrame:
    """Previous-year values by a left self-join on ``year+1``.

    With ``complete_col`` growth is only given when both years are complete.
    ``keys`` are extra partition keys (e.g. the cut).  Equivalent to a
    consecutive-year-guarded ``lag`` without an unpartitioned window.
    """
    keys = list(keys)
    sel = [*(F.col(k) for k in keys), (F.col(year_col) + 1).alias(year_col)]
    sel += [F.col(m).alias(m + suffix) for m in measures]
    if complete_col:
        sel.append(F.col(complete_col).alias(complete_col + suffix))
    prev = df.select(*sel)
    out = df.join(prev, on=[*keys, year_col], how="left")
    rates = {}
    for m in measures:
        c, p = F.col(m), F.col(m + suffix)
        if ratio_minus_one:
            ok = p.isNotNull() & ((p > 0) if require == "positive" else (p != 0))
            g = F.when(ok, c / p - F.lit(1.0))
        else:
            g = growth(c, p, require)
        if complete_col:
            g = F.when(F.col(complete_col) & F.col(complete_col + suffix), g)
        rates[rate_prefix + m] = g
    out = out.withColumns(rates)
    if not keep_prev:
        out = out.drop(*[m + suffix for m in measures],
                       *([complete_col + suffix] if complete_col else []))
    return out


def lag_growth(df: DataFrame, partition, order_col: str, measures, prefix: str = "yoy_",
               consecutive: bool = True, require: str = "nonzero", ratio_minus_one: bool = False,
               keep_lag: str | None = None) -> DataFrame:
    """Growth against the previous row of the partition.

    ``consecutive`` requires ``prev_order = order - 1``.  ``keep_lag`` keeps
    the raw (unguarded) lag columns with that suffix.  Use only on grains
    whose partitions are bounded (codes x months, labels x cuts).
    """
    w = Window.partitionBy(*partition).orderBy(order_col)
    prev_order = F.lag(order_col).over(w)
    out = df.withColumn("_prev_order", prev_order)
    lags = {f"_lag_{m}": F.lag(m).over(w) for m in measures}
    out = out.withColumns(lags)
    rates = {}
    for m in measures:
        p, c = F.col(f"_lag_{m}"), F.col(m)
        ok = (p > 0) if require == "positive" else (p != 0)
        if require == "nonzero_notnull":
            ok = p.isNotNull() & (p != 0) & c.isNotNull()
        if consecutive:
            ok = ok & (F.col("_prev_order") == F.col(order_col) - 1)
        val = (c / p - F.lit(1.0)) if ratio_minus_one else ((c - p) / p)
        rates[prefix + m] = F.when(ok, val)
    out = out.withColumns(rates)
    if keep_lag:
        out = out.withColumns({m + keep_lag: F.col(f"_lag_{m}") for m in measures})
    return out.drop("_prev_order", *lags.keys())


def share_of(df: DataFrame, partition, measure: str, out_col: str,
             require_value: bool = False) -> DataFrame:
    """``measure / sum(measure)`` within the partition when the sum > 0.

    Totals are a grouped aggregate (partial + final) joined back on the
    partition key; AQE broadcasts the small totals side at run time.
    """
    return shares_of(df, df, partition, {out_col: measure}, require_value)


def shares_of(df: DataFrame, base: DataFrame, partition, shares: dict[str, str], require_value: bool = False) -> DataFrame:
    """N7 for several ``shares`` {out: measure} at once: the totals of all of
    them are one aggregate over ``base``, the table that ``df`` was made of."""
    partition = list(partition)
    totals = base.groupBy(*partition).agg(*[exact_sum(m, MEASURE_SCALE).alias(f"_total_{out}") for out, m in shares.items()])
    done = df.join(totals, on=partition, how="left")
    for out, m in shares.items():
        ok = F.col(f"_total_{out}") > 0
        if require_value:
            ok = ok & F.col(m).isNotNull()
        done = done.withColumn(out, F.when(ok, F.col(m) / F.col(f"_total_{out}"))).drop(f"_total_{out}")
    return done


#: Pieces that a hot period's ranking is cut into, and the rows sampled for it.
RANK_RANGES, RANK_SAMPLE = 32, 2048


def _with_range(df: DataFrame, order: Column, base: DataFrame, name: str) -> DataFrame:
    """Adds the number of the range that a row's order key falls into: how many
    bounds lie below it.  Bounds are sampled from ``base``; they only balance
    the tasks, any bounds give the same ranks."""
    # The rows with the smallest hashes: a bounded sample, the same on every run.
    some = base.select(order.alias("_key")).withColumn("_h", F.xxhash64("_key")).orderBy("_h").limit(RANK_SAMPLE)
    step = max(1, RANK_SAMPLE // RANK_RANGES)
    keys = some.agg(F.sort_array(F.collect_list("_key")).alias("k")).select(
        F.filter("k", lambda x, i: (i % step) == (step - 1)).alias("k")).scalar()
    return df.withColumn("_bounds", keys).withColumn(name, F.size(F.filter("_bounds", lambda x: x < order))).drop("_bounds")


def ranked_in(df: DataFrame, partition, ranks: dict[str, tuple[str, str]], method: str = "row_number") -> DataFrame:
    """``ranks`` {out: (measure, tie)} within the partition, each by
    measure descending (nulls last), then tie ascending; INT.

    Two passes, so that a period of any size spreads over tasks: rows are
    numbered within ranges of the order key, and a row's rank is its number
    plus the rows (``dense_rank``: distinct keys) of the ranges before its own,
    of which there are at most ``RANK_RANGES`` a partition.  Equal keys share a
    range, so ties rank exactly as in one window.  ``df`` is read once more
    for each rank and for its bounds: give it a written table.
    """
    partition = list(partition)
    based, windows, sizes = df, {}, {}
    for out, (measure, tie) in ranks.items():
        m = F.col(measure)
        down = F.when(F.isnan(m.cast("double")), F.lit(float("-inf"))).otherwise(-m)
        key = F.struct(m.isNull().alias("none"), down.alias("down"), F.col(tie).alias("tie"))
        based = _with_range(based, key, df, f"_range_{out}")
        w = Window.partitionBy(*partition, f"_range_{out}").orderBy(m.desc_nulls_last(), F.col(tie).asc())
        windows[out] = (F.row_number() if method == "row_number" else F.dense_rank()).over(w)
        sizes[out] = F.count(F.lit(1)) if method == "row_number" else F.count_distinct(key)
    done = based
    for out, own in windows.items():
        place, p_place = f"_range_{out}", f"_p_range_{out}"
        before = Window.partitionBy(*partition).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
        counted = based.groupBy(*partition, place).agg(sizes[out].alias("_n")).select(
            *[F.col(c).alias(f"_p_{c}") for c in partition], F.col(place).alias(p_place), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
        same = F.col(place) == F.col(p_place)
        for c in partition:
            same = same & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
        done = (done.withColumn("_own", own).join(counted, same).withColumn(out, (F.col("_own") + F.col("_before")).cast("int"))
                .drop("_own", "_before", p_place, *[f"_p_{c}" for c in partition]))
    return done.drop(*[f"_range_{out}" for out in ranks])


def rank_in(df: DataFrame, partition, measure: str, tie: str, out_col: str,
            method: str = "row_number") -> DataFrame:
    """Rank by ``measure`` desc (nulls last), ``tie`` asc; INT."""
    return ranked_in(df, partition, {out_col: (measure, tie)}, method)


def rollup(df: DataFrame, keys, sums: dict, distinct: dict | None = None,
           price: tuple | None = None) -> DataFrame:
    """A1/A2: grouped sums, distinct counts and a ratio-of-sums price.

    ``sums``: {out: Column}; ``distinct``: {out: col}; ``price``:
    (out, numerator_out, denominator_out, den_factor).
    """
    aggs = [expr.alias(name) for name, expr in sums.items()]
    aggs += [F.count_distinct(c).alias(name) for name, c in (distinct or {}).items()]
    out = df.groupBy(*keys).agg(*aggs)
    if price:
        name, num, den, factor = price
        out = out.withColumn(name, ratio(num, den, "positive", factor))
    return out


def rollup_year(df: DataFrame, year_col: str, month_col: str, sums: dict,
                months_out: str = "months_reported", complete_out: str = "complete",
                price: tuple | None = None, keys=()) -> DataFrame:
    """A2: annual sums, months reported (distinct) and completeness flag."""
    out = rollup(df, [*keys, year_col], sums, {months_out: month_col}, price)
    return out.withColumn(complete_out, F.col(months_out) == 12)


def reconcile_totals(detail: DataFrame, total: DataFrame, keys, measure: str,
                     abs_tol: float, how: str = "inner") -> DataFrame:
    """Σ detail per key vs the reported total of the same key.

    ``how='inner'`` checks only keys present on both sides (as the source
    rule does); ``how='full_outer'`` also returns keys without counterpart
    (``within_tolerance`` NULL) so silently unchecked pairs become visible.
    """
    keys = list(keys)
    s = detail.groupBy(*keys).agg(exact_sum(measure, MEASURE_SCALE).alias("detail_sum"))
    t = total.select(*keys, F.col(measure).alias("reported_total"))
    j = s.join(t, keys, how)
    diff = F.abs(F.col("detail_sum") - F.col("reported_total"))
    return j.withColumns({"abs_diff": diff, "within_tolerance": diff <= F.lit(float(abs_tol))})


def attach(df: DataFrame, other: DataFrame, keys, how: str = "left") -> DataFrame:
    """Attach labels, published indicators or annual coverage by key.

    No hint: AQE converts the join to a broadcast join at run time when the
    measured size of ``other`` is below the threshold, and keeps a shuffle
    join otherwise.
    """
    return df.join(other, on=list(keys) if not isinstance(keys, str) else keys, how=how)


def lookup_key(fact: DataFrame, dim: DataFrame, on, key_col: str) -> DataFrame:
    """Dimension key lookup (left join); NULL keys are found by a rule."""
    return fact.join(dim.select(*([on] if isinstance(on, str) else on), key_col), on=on, how="left")


def denormalise(fact: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Fact joined to a dimension (inner)."""
    return fact.join(dim, on=on, how="inner")


def fk_orphans(fact: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Fact rows whose key is missing from the dimension (left anti)."""
    keys = [on] if isinstance(on, str) else list(on)
    return fact.join(dim.select(*keys).distinct(), keys, "left_anti")
