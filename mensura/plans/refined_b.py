"""The refined pipeline of the sub-code source, end to end on cells.

The sub-code fact is laid out as a spreadsheet (``subpartidas.xlsx``,
sheet ``DATOS``): preamble rows 1–3, header on row 7 starting at column 2
(accented, mixed-case names matched through aliases), one data row per
fact row with codes written as spreadsheet numbers (``83.0``, ``8384``,
``83840017`` — leading zeros lost) and labels with stray blanks.  The
pipeline must recover the refined fact exactly:

locate header (S9) → extent (S10) → records with row lineage and
identifier widths 4/6/10 (S12, O9) → clean text (O1) → dedup on the
business columns keeping the first source row (U4) → period parse (O11) →
measures typed (F7/O4) → USD = thousands × 1000 (O12).

Row numbers: ``8 + ((year - 1990) * 12 + month - 1) * 300 + brand * 11 +
product % 11`` (unique for the driver data; sparse rows are fine because
extraction keeps the source row and never assumes contiguity).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_period
from ..functions.numbers import parse_number
from ..functions.text import clean_text
from ..session import materialize, per_session
from ..sources import cells as C
from . import inputs

FILE = "subpartidas.xlsx"
SHEET = "DATOS"
HEADER_ROW = 7
# (canonical name, header text as written in the sheet, column)
LAYOUT = [("period_text", "Período", 2), ("level3_code", "Código Nivel 3", 3), ("level3_label", "Nivel 3", 4),
          ("product_code", "Código Producto Principal", 5), ("product_label", "Producto Principal", 6),
          ("subcode", "Código Subpartida", 7), ("subcode_label", "Subpartida", 8),
          ("tonnes", "TM (Peso Neto)", 9), ("fob_thousands", "FOB (miles USD)", 10)]
ALIASES = [(c, a) for c, a, _ in LAYOUT] + [("period_text", "PERIODO"), ("tonnes", "TONELADAS"),
                                             ("fob_thousands", "FOB MILES USD")]
WIDTHS = {"level3_code": 4, "product_code": 6, "subcode": 10}
TEXTS = ["period_text", "level3_label", "product_label", "subcode_label"]
MEASURES = ["tonnes", "fob_thousands"]


def row_number_expr() -> F.Column:
    brand = F.substring("subcode", 7, 4).cast("int")
    prod = F.col("product_code").cast("int") % 11
    return (F.lit(8) + ((F.col("year") - 1990) * 12 + F.col("month") - 1) * 300 + brand * 11 + prod).cast("int")


@per_session
def cells(spark: SparkSession, d: str) -> DataFrame:
    f = inputs.subcode_fact(spark, d)
    row = row_number_expr()
    values = {
        "period_text": F.col("period_text"),
        "level3_code": F.concat(F.col("level3_code").cast("int").cast("string"), F.lit(".0")),
        "level3_label": F.concat(F.lit(" "), F.col("level3_label")),
        "product_code": F.col("product_code").cast("int").cast("string"),
        "product_label": F.concat(F.col("product_label"), F.lit("  ")),
        "subcode": F.col("subcode").cast("bigint").cast("string"),
        "subcode_label": F.regexp_replace("subcode_label", " ", "  "),
        # numbers rendered as the spreadsheet shows them (shortest round-trip text)
        "tonnes": F.col("tonnes").cast("string"),
        "fob_thousands": F.col("fob_thousands").cast("string"),
    }
    data = f.select(row.alias("row"), F.inline(F.array(*[
        F.struct(F.lit(col).cast("int").alias("col"), values[name].alias("value")) for name, _, col in LAYOUT])))
    base = [F.lit(FILE).alias("file"), F.lit(SHEET).alias("sheet")]
    data = data.select(*base, "row", "col", "value")
    layout = [(1, 1, "EXPORTACIONES POR SUBPARTIDA"), (2, 1, "Fuente: registro de envíos"), (3, 1, "Generado")]
    layout += [(HEADER_ROW, col, text) for _, text, col in LAYOUT]
    lit_cells = spark.createDataFrame(layout, "row int, col int, value string").select(*base, "row", "col", "value")
    gen = f.agg(F.max("period_text").alias("value")).select(*base, F.lit(3).alias("row"), F.lit(2).alias("col"),
                                                            "value")
    return materialize(reduce(lambda a, b: a.unionByName(b), [data, lit_cells, gen]))


def refined(spark: SparkSession, d: str) -> DataFrame:
    """K18 output: the refined sub-code fact with its source row."""
    c = cells(spark, d)
    aliases = spark.createDataFrame(ALIASES, "canonical string, alias string")
    ext = C.sheet_extent(c, C.locate_header(c, aliases))
    rec = C.extract_records(c, ext, WIDTHS, measures=MEASURES, texts=TEXTS)
    rec = rec.withColumns({t: clean_text(t) for t in TEXTS})
    business = TEXTS + list(WIDTHS) + MEASURES
    # U4: dedup on the business columns; the earliest source row is kept
    rec = rec.groupBy(*business).agg(F.min("_source_row").alias("_source_row"))
    y, m, dt = parse_period("period_text")
    typed = {n: parse_number(n) for n in MEASURES}
    out = rec.withColumns({"year": y, "month": m, "period_date": dt, **typed})
    return out.select("period_text", "period_date", "year", "month", "level3_code", "level3_label",
                      "product_code", "product_label", "subcode", "subcode_label", "tonnes", "fob_thousands",
                      (F.col("fob_thousands") * F.lit(1000.0)).alias("fob_usd"), "_source_row")
