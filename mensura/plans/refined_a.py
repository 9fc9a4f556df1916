"""K17, refined pipeline A end to end: seven tables of one report workbook.

cells -> one range join for all seven contracts (S7) -> clean text and labels
(O1, O3) -> empty rows and repeated rows removed (F1, U3) -> types (F7) ->
months and indicators unpivoted under the report's cutoff (P1, P2, F2, F3) ->
staged -> rules A1-A6 on the staged files -> published, or blocked.

The workbook ``informe.xlsx`` (test-data instance) is laid out by Spark jobs
from ``orders``, ``customer``, ``nation`` and ``region``: sheets ``VALOR`` and
``CANTIDAD`` hold the two matrices, ``RESUMEN`` the monthly series and the two
histories, ``MERCADO`` and ``MERCADO ACUM`` the markets of the last two years.
Labels stand in mixed case with stray blanks, missing values as ``N/A``, money
with thousands separators, and the total row of each market twice.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numbers import (ABS_TOL_PRICE, ABS_TOL_TOTAL, REL_TOL, REL_TOL_PRICE, dual_scale_violation,
                                 growth, row_sum)
from ..functions.text import NULL_TOKENS_WITH_DASH, canonical_label, clean_text
from ..operators.audit import layer_contract, technical_suite
from ..operators.quality import CRITICAL, Rule, evaluate, share_range_rule, union_results, unique_rule
from ..operators.reshape import CONVERTERS, unpivot_indicators, until
from ..session import materialize, per_session
from ..sinks.publish import Staged, layer_properties, publish, published_folder, retire, stage, table_metrics, watched
from ..sources import cells as C
from ..sources.refined import open_refined
from . import inputs, workbook

FILE = "informe.xlsx"
#: Years that the market sheets compare.
YEARS = (2000, 2001)
_MONTHS = inputs.MONTH_COLS


def _market(unit: str) -> list[tuple[str, str]]:
    a, b = YEARS
    return [("label", "label"), (f"value_{a}_{unit}", "double"), (f"qty_{a}_{unit}", "double"), (f"value_{b}_{unit}", "double"), (f"qty_{b}_{unit}", "double"),
            ("growth_value", "double"), ("growth_qty", "double"), ("share_qty", "double")]


_HISTORY = [("qty", "double"), ("value", "double"), ("growth_qty", "double"), ("growth_value", "double")]
_MATRIX = [("year", "int"), *[(m, "double") for m in _MONTHS], ("total", "double")]
#: (id, name, sheet, first row, first column, last row, [(column, type)])
TABLES = [
    (1, "monthly", "RESUMEN", 10, 28, 209, [("period_date", "date"), ("qty", "double"), ("value", "double"), ("reported_price", "double")]),
    (2, "matrix_value", "VALOR", 5, 1, 44, _MATRIX),
    (3, "history_month", "RESUMEN", 229, 28, 268, [("year", "int"), *_HISTORY]),
    (4, "history_cumulative", "RESUMEN", 289, 28, 328, [("period", "string"), *_HISTORY]),
    (5, "matrix_qty", "CANTIDAD", 5, 1, 44, _MATRIX),
    (6, "market_month", "MERCADO", 12, 1, 111, _market("05")),
    (7, "market_cumulative", "MERCADO ACUM", 12, 1, 111, _market("ene_may")),
]
CONTRACTS = [dict(id_table=i, name=name, sheet=sheet, r1=r1, c1=c1, r2=r2, c2=c1 + len(cols) - 1, semantic_columns=[c for c, _ in cols])
             for i, name, sheet, r1, c1, r2, cols in TABLES]
TYPES = {name: cols for _, name, _, _, _, _, cols in TABLES}
ID = {name: i for i, name, *_ in TABLES}
WIDTH = max(len(t) for t in TYPES.values())


# -- the workbook ------------------------------------------------------------

def _text(c: Column, digits: int) -> Column:
    return F.coalesce(c.cast(f"decimal(24,{digits})").cast("string"), F.lit("N/A"))


def _money(c: Column) -> Column:
    return F.coalesce(F.format_number(c.cast("decimal(24,2)"), 2), F.lit("N/A"))


def _cells(rows: DataFrame, sheet: str, row: Column, first: int, values: list[Column]) -> DataFrame:
    """One cell per value of each row."""
    listed = F.array(*[F.struct(F.lit(first + i).alias("col"), v.alias("value")) for i, v in enumerate(values)])
    return rows.select(F.lit(FILE).alias("file"), F.lit(sheet).alias("sheet"), row.cast("int").alias("row"), F.inline(listed))


def _history(spark: SparkSession, d: str) -> DataFrame:
    """Totals of each cut and year beside the growth against the year before."""
    w = Window.partitionBy("cut").orderBy("year")
    t = inputs.market_cells(spark, d).filter(F.col("label").startswith("TOTAL"))
    return t.select("cut", "year", "qty", "value", *[growth(m, F.lag(m).over(w)).alias(f"growth_{m}") for m in ("qty", "value")])


def _markets(spark: SparkSession, d: str) -> DataFrame:
    """Per cut and label the two compared years, growth and share, and the
    label's place in the sheet."""
    a, b = YEARS
    m = inputs.market_cells(spark, d).filter(F.col("year").isin(a, b))
    at = {f"{x}_{y}": F.max(F.when(F.col("year") == y, F.col(x))).alias(f"{x}_{y}") for y in YEARS for x in ("value", "qty")}
    wide = m.groupBy("cut", "label").agg(*at.values())
    total = wide.filter(F.col("label").startswith("TOTAL")).select(F.col("cut").alias("_cut"), F.col(f"qty_{b}").alias("_total"))
    wide = wide.join(total, F.col("cut") == F.col("_cut"), "left")
    # labels of the catalogue: a place per nation, region and total row
    place = F.row_number().over(Window.partitionBy("cut").orderBy("label"))
    return wide.select("cut", "label", *at, *[growth(f"{x}_{b}", f"{x}_{a}").alias(f"growth_{x}") for x in ("value", "qty")],
                       F.when(F.col("_total") > 0, F.col(f"qty_{b}") / F.col("_total")).alias("share_qty"), place.alias("place"))


@per_session
def report_cells(spark: SparkSession, d: str) -> DataFrame:
    a, b = YEARS
    matrices = workbook.cells(spark, d).filter(F.col("sheet").isin("VALOR", "CANTIDAD")).withColumn("file", F.lit(FILE))
    direct = inputs.monthly_direct(spark, d)
    month = (F.col("year") - inputs.P.direct_from) * 12 + F.col("month") - 1
    parts = [
        matrices.select("file", "sheet", "row", "col", "value"),
        _cells(direct, "RESUMEN", month + 10, 28, [F.date_format("period_date", "yyyy-MM-dd HH:mm:ss"), _text(F.col("qty"), 0), _money(F.col("value")), _text(F.col("reported_price"), 6)]),
    ]
    h = _history(spark, d)
    measures = [_text(F.col("qty"), 0), _money(F.col("value")), _text(F.col("growth_qty"), 9), _text(F.col("growth_value"), 9)]
    parts += [
        _cells(h.filter("cut = 'MAYO'"), "RESUMEN", F.col("year") - 1990 + 229, 28, [F.concat(F.col("year").cast("string"), F.lit(".0")), *measures]),
        _cells(h.filter("cut <> 'MAYO'"), "RESUMEN", F.col("year") - 1990 + 289, 28, [F.concat(F.lit("Ene -  May "), F.col("year").cast("string")), *measures]),
    ]
    m = _markets(spark, d)
    stray = F.when(F.col("place") % 2 == 0, F.concat(F.lit("  "), F.lower("label"))).otherwise(F.concat("label", F.lit(" ")))
    values = [stray, _money(F.col(f"value_{a}")), _text(F.col(f"qty_{a}"), 0), _money(F.col(f"value_{b}")), _text(F.col(f"qty_{b}"), 0),
              _text(F.col("growth_value"), 9), _text(F.col("growth_qty"), 9), _text(F.col("share_qty"), 9)]
    for cut, sheet in (("MAYO", "MERCADO"), ("ACUM_ENE_MAY", "MERCADO ACUM")):
        own = m.filter(F.col("cut") == cut)
        parts.append(_cells(own, sheet, F.col("place") + 11, 1, values))
        parts.append(_cells(own.filter(F.col("label").startswith("TOTAL")), sheet, F.lit(111), 1, values))
    return materialize(reduce(lambda x, y: x.unionByName(y), parts))


# -- reading, cleaning, typing -----------------------------------------------

def _cleaned(i: int) -> Column:
    """Column i of every table: labels in canonical form, else clean text."""
    labels = [ID[n] for n, cols in TYPES.items() if len(cols) >= i and cols[i - 1][1] == "label"]
    plain = clean_text(f"c{i}", NULL_TOKENS_WITH_DASH)
    return F.when(F.col("id_table").isin(labels), canonical_label(f"c{i}")).otherwise(plain) if labels else plain


def _converted(c: Column, kind: str) -> Column:
    return CONVERTERS["string" if kind == "label" else kind](c)


def refined_rows(cells: DataFrame) -> Staged:
    """The rows of all tables, cleaned and without empty or repeated ones, and
    in the metrics what was read, removed and not convertible (F1, U3, F7)."""
    own = [f"c{i}" for i in range(1, WIDTH + 1)]
    rows = C.read_ranges(cells, CONTRACTS).select("file", "id_table", "_source_row", *[_cleaned(i).alias(c) for i, c in enumerate(own, 1)])
    empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in own])
    read = {}
    for name, cols in TYPES.items():
        here = F.col("id_table") == ID[name]
        read |= {f"{name}.rows_initial": F.count_if(here), f"{name}.rows_empty": F.count_if(here & empty)}
        for i, (column, kind) in enumerate(cols, 1):
            c = F.col(f"c{i}")
            read[f"{name}.{column}.non_null_source"] = F.count_if(here & c.isNotNull())
            read[f"{name}.{column}.failures"] = F.count_if(here & c.isNotNull() & _converted(c, kind).isNull())
    rows, first = watched(rows, read)
    kept = rows.filter(~empty).groupBy("file", "id_table", *own).agg(F.count("*").alias("_times"), F.min("_source_row").alias("_source_row"))
    kept, second = watched(kept, {f"{n}.rows_repeated": F.coalesce(F.sum(F.when(F.col("id_table") == ID[n], F.col("_times") - 1)), F.lit(0)) for n in TYPES})
    last = {f"{n}.rows_refined": F.count_if(F.col("id_table") == ID[n]) for n in TYPES}
    return stage(kept.drop("_times"), "k17-rows", last, [first, second])


def typed(rows: DataFrame, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """A table's rows under its own names and types."""
    return rows.filter(F.col("id_table") == ID[name]).select(
        *keep, *[_converted(F.col(f"c{i}"), kind).alias(column) for i, (column, kind) in enumerate(TYPES[name], 1)])


def months(wide: DataFrame, cutoff: str) -> DataFrame:
    """P1 up to the cutoff, null observations still in."""
    listed = F.array(*[F.struct(F.lit(i).alias("month"), F.col(c).alias("value")) for i, c in enumerate(_MONTHS, 1)])
    long = wide.select("year", F.inline(listed)).withColumn("period_date", F.make_date("year", "month", F.lit(1)))
    return until(long, "period_date", cutoff).select("period_date", "year", "month", "value")


def final_tables(rows: DataFrame, cutoff: str = inputs.P.report_cutoff) -> dict[str, Staged]:
    """The seven refined tables, staged, with rows, null cells and (of the
    matrices) excluded null observations in their metrics."""
    out = {}
    for name in TYPES:
        df, seen = typed(rows, name), []
        if name.startswith("matrix"):
            df, null_obs = watched(months(df, cutoff), {"rows_before_null_filter": F.count("*"), "null_observations": F.count_if(F.col("value").isNull())})
            df, seen = df.filter(F.col("value").isNotNull()), [null_obs]
        elif name.startswith("market"):
            df = unpivot_indicators(df, "label")
        elif name == "monthly":
            df = until(df, "period_date", cutoff).select("period_date", F.year("period_date").alias("year"), F.month("period_date").alias("month"), "qty", "value", "reported_price")
        out[name] = stage(df, f"k17-{name}", table_metrics(df), seen)
    return out


# -- rules ---------------------------------------------------------------------

def rules(rows: DataFrame, tables: dict[str, Staged], cutoff: str = inputs.P.report_cutoff) -> DataFrame:
    """A1-A6 on the staged files."""
    def period(name: str) -> list[DataFrame]:
        t = tables[name].rows
        wrong = (F.col("year").isNull() | F.col("month").isNull() | ~F.col("month").between(1, 12) | (F.col("period_date") > F.lit(cutoff).cast("date")))
        measures = ("qty", "value", "reported_price") if name == "monthly" else ("value",)
        own = [Rule(f"A1_{m}_non_negative", CRITICAL, F.col(m) < 0, F.col(m).isNotNull()) for m in measures]
        if name == "monthly":
            own.append(Rule("A3_reported_price", CRITICAL, F.abs(F.col("reported_price") - F.col("value") / F.col("qty"))
                            > F.greatest(F.lit(ABS_TOL_PRICE), F.abs("reported_price") * REL_TOL_PRICE),
                            (F.col("qty") > 0) & F.col("value").isNotNull() & F.col("reported_price").isNotNull()))
        return [evaluate(t, name, [*own, Rule("A6_period_valid", CRITICAL, wrong)]), unique_rule(t, name, "A6_period_key_unique", ["year", "month"])]

    def stored(rule: str, now: str, before: str, rate: str) -> Rule:
        known = F.col(now).isNotNull() & F.col(before).isNotNull() & (F.col(before) != 0) & F.col(rate).isNotNull()
        return Rule(rule, CRITICAL, dual_scale_violation(now, before, rate), known)

    parts = [x for name in ("monthly", "matrix_value", "matrix_qty") for x in period(name)]
    for name in ("matrix_value", "matrix_qty"):
        off = F.abs(F.col("total") - row_sum(_MONTHS)) > F.greatest(F.lit(ABS_TOL_TOTAL), F.abs("total") * REL_TOL)
        parts.append(evaluate(typed(rows, name), name, [Rule("A2_total_equals_months", CRITICAL, off, F.col("total").isNotNull())]))
    w = Window.partitionBy("file").orderBy("year")  # a row per year of a workbook
    h = typed(rows, "history_month", ("file",)).select("*", *[F.lag(m).over(w).alias(f"before_{m}") for m in ("qty", "value")])
    parts.append(evaluate(h, "history_month", [stored(f"A4_stored_growth_{m}", m, f"before_{m}", f"growth_{m}") for m in ("qty", "value")]))
    a, b = YEARS
    for name, unit in (("market_month", "05"), ("market_cumulative", "ene_may")):
        t = typed(rows, name)
        parts += [evaluate(t, name, [stored(f"A4b_market_growth_{m}", f"{m}_{b}_{unit}", f"{m}_{a}_{unit}", f"growth_{m}") for m in ("value", "qty")]),
                  share_range_rule(t, name, "A5_share_in_range", "share_qty"),
                  unique_rule(tables[name].rows, name, "A6_market_key_unique", ["label", "indicator"])]
    return union_results(parts)


# -- the pipeline --------------------------------------------------------------

@dataclass
class Run:
    rows: Staged
    tables: dict[str, Staged]
    rules: DataFrame
    names: dict[str, str]


def run(cells: DataFrame, database: str, props: dict[str, str] | None = None) -> Run:
    """Refine a workbook's cells and publish the seven tables in
    ``database``.  A CRITICAL rule that fails raises and publishes nothing;
    else the versions published before are deleted."""
    spark = cells.sparkSession
    rows = refined_rows(cells)
    tables = final_tables(rows.rows)
    found = stage(rules(rows.rows, tables), "k17-rules").rows
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = {n: f"{database}.{n}" for n in tables}
    before = [published_folder(spark, n) for n in names.values()]
    publish({names[n]: t for n, t in tables.items()}, found, props)
    retire(spark, before)
    return Run(rows, tables, found, names)


def _database(spark: SparkSession, d: str) -> str:
    return "refined_a_" + hashlib.sha256(f"{spark.sparkContext.applicationId}:{d}".encode()).hexdigest()[:12]


def lineage(spark: SparkSession, d: str) -> dict[str, str]:
    return {"pipeline.layer": "refined", "pipeline.version": "2", "pipeline.run_id": f"{spark.sparkContext.applicationId}-a",
            "lineage.input_sha256": hashlib.sha256(d.encode()).hexdigest(), "lineage.report_period": inputs.P.report_cutoff[:7],
            "source.value_unit": "USD", "canonical.value_unit": "USD"}


@per_session
def run_of(spark: SparkSession, d: str) -> Run:
    return run(report_cells(spark, d), _database(spark, d), lineage(spark, d))


def refined(spark: SparkSession, d: str) -> DataFrame:
    """All seven published tables, read back, in long form."""
    names = run_of(spark, d).names
    out = []
    for name, cols in TYPES.items():
        t = spark.table(names[name])
        date = F.col("period_date") if "period_date" in t.columns else F.lit(None).cast("date")
        if name.startswith("market"):
            long = t.select("label", "indicator", "value")
        elif name.startswith("matrix"):
            long = t.select("period_date", F.lit("value").alias("indicator"), "value")
        else:
            key = {"monthly": "period_date", "history_month": "year", "history_cumulative": "period"}[name]
            long = t.select(F.col(key), F.inline(F.array(*[F.struct(F.lit(c).alias("indicator"), F.col(c).alias("value")) for c, k in cols if k == "double"]))).filter("value IS NOT NULL")
            long = long if name == "monthly" else long.withColumn("label", F.col(key).cast("string"))
        label = F.col("label") if "label" in long.columns else F.lit(None).cast("string")
        out.append(long.select(F.lit(name).alias("table"), (date if "period_date" in long.columns else F.lit(None).cast("date")).alias("period_date"),
                               label.alias("label"), "indicator", "value"))
    return reduce(lambda x, y: x.unionByName(y), out)


def refined_rules(spark: SparkSession, d: str) -> DataFrame:
    """A1-A6 on the staged tables of K17, from cells."""
    return run_of(spark, d).rules


def audit(spark: SparkSession, d: str) -> DataFrame:
    """F1, F3, F7, U3 and W5 audits of K17: (table, column, metric, n), all
    taken while the tables were written."""
    r = run_of(spark, d)
    rows = []
    for name, n in r.rows.metrics.items():
        table, *column, metric = name.split(".")
        rows.append((table, column[0] if column else None, metric, int(n)))
    rows += [(table, None, metric, int(n)) for table, t in r.tables.items() for metric, n in t.metrics.items()]
    return spark.createDataFrame(rows, "table string, column string, metric string, n long")


#: Lineage that the tables of one run share, and what each must say.
SINGLE = ["pipeline.run_id", "lineage.input_sha256", "lineage.report_period"]
EXPECTED = {"pipeline.layer": "refined", "pipeline.version": "2", "source.value_unit": "USD", "canonical.value_unit": "USD"}


def contract(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    """D-C: the cross-table contract of published tables, from the properties
    that the catalog has of them and the months that they hold."""
    dated = [spark.table(n).agg(F.max("period_date").alias("period_max")).select(F.lit(t).alias("table"), "period_max")
             for t, n in names.items() if t == "monthly" or t.startswith("matrix")]
    return layer_contract(layer_properties(spark, "refined", names), list(TYPES), EXPECTED, SINGLE, union_results(dated), "lineage.report_period")


def published_contract(spark: SparkSession, d: str) -> DataFrame:
    """D-C over the tables that K17 published."""
    return contract(spark, run_of(spark, d).names)


def published_suite(spark: SparkSession, d: str) -> DataFrame:
    """D-QA over the tables that K17 published, with the rows and columns that
    were staged."""
    r = run_of(spark, d)
    found = {t["viewName"]: f"{t['namespace']}.{t['viewName']}" for t in spark.sql(f"SHOW VIEWS IN {_database(spark, d)}").collect()}
    props = {k: v for k, v in lineage(spark, d).items() if k in SINGLE}
    return technical_suite(spark, {n: found.get(n, r.names[n]) for n in TYPES}, {n: t.metrics["rows"] for n, t in r.tables.items()},
                           {n: t.rows.columns for n, t in r.tables.items()}, props)


def opened(spark: SparkSession, d: str) -> DataFrame:
    """The gate in front of each published table, check by check."""
    r = run_of(spark, d)
    out = []
    for name, t in r.tables.items():
        _, checks = open_refined(spark, r.names[name], t.rows.columns, EXPECTED, ["pipeline.run_id", "lineage.input_sha256"])
        out.append(checks.select(F.lit(name).alias("table"), "check", "ok", "status"))
    return union_results(out)
