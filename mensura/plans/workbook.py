"""Workbook queries (S7–S12, F7, P1) over a long cells table derived from
``orders``.

Layout of the derived workbook ``exportaciones.xlsx`` (test-data instance):
sheets ``VALOR`` (sum of order prices) and ``CANTIDAD`` (number of
orders): row 1 title, row 2 source line, row 3 ``Período: | <last month>``,
row 4 header (``AÑO``, month names, ``TOTAL``), one row per year at
``year - 1990`` with the year written as ``<year>.0`` (spreadsheet float
artefact), month values and the row total as decimal text.  A ``NOTAS``
sheet holds only a note (no header).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import MONTHS_UPPER
from ..operators.reshape import apply_types, unpivot_months
from ..session import materialize, per_session
from ..sources import cells as C
from . import inputs

FILE = "exportaciones.xlsx"
SHEETS = {"VALOR": "value", "CANTIDAD": "qty"}
NAMES = ["year"] + inputs.MONTH_COLS + ["total"]
CONTRACTS = [
    dict(id_table=1, name="matrix_value", sheet="VALOR", hdr_r1=4, hdr_c1=1, hdr_r2=4, hdr_c2=14,
         r1=5, c1=1, r2=12, c2=14, semantic_columns=NAMES, required_tokens=["ANO", "ENERO", "TOTAL"]),
    dict(id_table=2, name="matrix_qty", sheet="CANTIDAD", hdr_r1=4, hdr_c1=1, hdr_r2=4, hdr_c2=14,
         r1=5, c1=1, r2=12, c2=14, semantic_columns=NAMES, required_tokens=["ANO", "ENERO", "TOTAL"]),
    dict(id_table=3, name="prices", sheet="PRECIOS", hdr_r1=4, hdr_c1=1, hdr_r2=4, hdr_c2=3,
         r1=5, c1=1, r2=12, c2=3, semantic_columns=["year", "price", "change"], required_tokens=["PRECIO"]),
    dict(id_table=4, name="matrix_value_narrow", sheet="VALOR", hdr_r1=4, hdr_c1=1, hdr_r2=4, hdr_c2=14,
         r1=5, c1=1, r2=12, c2=14, semantic_columns=NAMES[:13], required_tokens=["ANO", "JULIO"]),
]
# Header aliases (canonical name -> accepted spellings).
ALIASES = ([("year", a) for a in ("AÑO", "ANO", "ANIO", "YEAR")]
           + [(c, m) for c, m in zip(inputs.MONTH_COLS, MONTHS_UPPER)]
           + [("total", "TOTAL"), ("total", "TOTAL ANUAL")])
TYPES = [("year", "int")] + [(c, "double") for c in inputs.MONTH_COLS] + [("total", "double")]


@per_session
def cells(spark: SparkSession, d: str) -> DataFrame:
    om = inputs.order_months(spark, d)
    per = om.select(F.year("period_date").alias("year"), F.month("period_date").alias("month"), "qty", "value")
    last = F.date_format(om.select(F.max("period_date")).scalar(), "yyyy-MM")
    parts = []
    for sheet, measure in SHEETS.items():
        base = [F.lit(FILE).alias("file"), F.lit(sheet).alias("sheet")]
        row = (F.col("year") - 1990).cast("int").alias("row")
        parts.append(per.select(*base, row, (F.col("month") + 1).cast("int").alias("col"),
                                F.col(measure).cast("decimal(20,2)").cast("string").alias("value")))
        parts.append(per.select("year").distinct().select(
            *base, row, F.lit(1).alias("col"), F.concat(F.col("year").cast("string"), F.lit(".0")).alias("value")))
        parts.append(per.groupBy("year").agg(F.sum(F.col(measure).cast("decimal(20,2)")).alias("t")).select(
            *base, row, F.lit(14).alias("col"), F.col("t").cast("string").alias("value")))
        layout = ([(1, 1, f"EXPORTACIONES MENSUALES - {sheet}"), (2, 1, "Fuente: registro de pedidos"),
                   (2, 2, "2001-02-03 04:05:06"),
                   (3, 1, "Período:"), (4, 1, "AÑO")]
                  + [(4, i + 2, m) for i, m in enumerate(MONTHS_UPPER)] + [(4, 14, "TOTAL")])
        lit_cells = spark.createDataFrame(layout, "row int, col int, value string").select(
            *base, "row", "col", "value")
        parts.append(lit_cells)
        parts.append(om.agg(F.lit(0).alias("_")).select(*base, F.lit(3).alias("row"), F.lit(2).alias("col"),
                                                          last.alias("value")))
    parts.append(spark.createDataFrame([(FILE, "NOTAS", 1, 1, "Notas metodológicas")],
                                       "file string, sheet string, row int, col int, value string"))
    return materialize(reduce(lambda a, b: a.unionByName(b), parts))


def contracts(spark: SparkSession) -> DataFrame:
    return C.contracts_frame(spark, [(k["id_table"], k["name"], k["sheet"], k["hdr_r1"], k["hdr_c1"],
                                      k["hdr_r2"], k["hdr_c2"], k["r1"], k["c1"], k["r2"], k["c2"],
                                      k["semantic_columns"], k["required_tokens"]) for k in CONTRACTS])


def aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ALIASES, "canonical string, alias string")


#: The contracts of the two matrices, over both sheets.
MATRICES = CONTRACTS[:2]


def read_matrix(spark: SparkSession, d: str) -> DataFrame:
    """The ranges of both matrices as raw text, in one read."""
    raw = C.read_ranges(cells(spark, d), MATRICES)
    names = spark.createDataFrame([(k["id_table"], k["name"]) for k in MATRICES], "id_table int, name string")
    return raw.join(names, "id_table").select("file", "name", "_source_row", *[F.col(f"c{i}").alias(n) for i, n in enumerate(NAMES, 1)])


def typed_matrix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return apply_types(read_matrix(spark, d).select("name", *NAMES), [("name", "string"), *TYPES])


def typed(spark: SparkSession, d: str) -> DataFrame:
    """both matrices typed (F1 drops the empty contract rows)."""
    t, _ = typed_matrix(spark, d)
    return t.dropna(how="all", subset=NAMES)


def typed_audit(spark: SparkSession, d: str) -> DataFrame:
    """F7 audit: per column non-null source cells and conversion failures, over
    both matrices."""
    return typed_matrix(spark, d)[1].filter(F.col("column") != "name")


def unpivoted(spark: SparkSession, d: str) -> DataFrame:
    """Both typed matrices back to monthly series under the report cutoff."""
    t = typed(spark, d)
    return reduce(lambda a, b: a.unionByName(b), [
        unpivot_months(t.filter(F.col("name") == k["name"]), "year", inputs.MONTH_COLS, cutoff=inputs.P.report_cutoff).withColumn("name", F.lit(k["name"]))
        for k in MATRICES])


def range_checks(spark: SparkSession, d: str) -> DataFrame:
    """S8."""
    return C.check_ranges(cells(spark, d), contracts(spark))


def headers(spark: SparkSession, d: str) -> DataFrame:
    """S9 (header map rendered as sorted ``name:col`` text)."""
    h = C.locate_header(cells(spark, d), aliases(spark))
    return h.select("file", "sheet", "status", "matches", "header_row",
                    C.header_map_text().alias("header_map"))


def _extent(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = cells(spark, d)
    return c, C.sheet_extent(c, C.locate_header(c, aliases(spark)), required_tokens=("Exportaciones", "registro", "Aduana"))


def extents(spark: SparkSession, d: str) -> DataFrame:
    """S10."""
    _, e = _extent(spark, d)
    return e.select("file", "sheet", "header_row", "last_row", "title", "scope", "generated_at", "preamble_lines",
                    F.array_join("missing_tokens", ",").alias("missing_tokens"))


def structure(spark: SparkSession, d: str) -> DataFrame:
    """S11."""
    _, e = _extent(spark, d)
    return C.structure_hash(e)


def records(spark: SparkSession, d: str) -> DataFrame:
    """Records with source row lineage, year as a 4-digit identifier."""
    c, e = _extent(spark, d)
    return C.extract_records(c, e, {"year": 4}, measures=inputs.MONTH_COLS + ["total"])
