"""Spreadsheet operators over a long *cells* table.

``cells(file, sheet, row INT, col INT, value STRING)`` is the distributed
form of any number of workbooks (one row per non-empty cell; produced by
a per-file decoder).  Contracts and header aliases are small declared
tables: they are broadcast explicitly (their size is bounded by the
number of declared ranges / aliases, not by the data).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import identifier
from ..functions.text import measure_text, normalize_match, strip_accents

CONTRACT_SCHEMA = T.StructType([
    T.StructField("id_table", T.IntegerType()), T.StructField("name", T.StringType()),
    T.StructField("sheet", T.StringType()),
    T.StructField("hdr_r1", T.IntegerType()), T.StructField("hdr_c1", T.IntegerType()),
    T.StructField("hdr_r2", T.IntegerType()), T.StructField("hdr_c2", T.IntegerType()),
    T.StructField("r1", T.IntegerType()), T.StructField("c1", T.IntegerType()),
    T.StructField("r2", T.IntegerType()), T.StructField("c2", T.IntegerType()),
    T.StructField("semantic_columns", T.ArrayType(T.StringType())),
    T.StructField("required_tokens", T.ArrayType(T.StringType())),
])


def cells_from_text(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Decode delimited-text sheets (one sheet per file) into the long cells table.

    Each file is read whole (``wholetext``) by one task, split into lines and
    fields with their positions, so row/column numbers are exact; only
    non-blank cells are kept.  Quoted fields containing the separator are not
    supported (exports of the reference's sheets have none).
    """
    import re as _re

    f = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("sheet"), "value")
    lines = f.select("file", "sheet", F.posexplode(F.split("value", r"\r?\n")).alias("r0", "line"))
    c = lines.select("file", "sheet", (F.col("r0") + 1).cast("int").alias("row"),
                     F.posexplode(F.split("line", _re.escape(sep), -1)).alias("c0", "value"))
    return c.filter(F.trim("value") != "").select("file", "sheet", "row",
                                                  (F.col("c0") + 1).cast("int").alias("col"), "value")


def contracts_frame(spark: SparkSession, rows) -> DataFrame:
    """Declared range contracts as a DataFrame (S19: local rows with schema)."""
    return spark.createDataFrame(rows, CONTRACT_SCHEMA)


def read_range(cells: DataFrame, contract: dict) -> DataFrame:
    """The rectangle of one declared contract in every workbook that has
    its sheet (or in ``file``); every row r1..r2 is kept (empty rows too) and columns are named by the contract.

    The rectangle is a plain filter (sheet equality and row/col ranges), so it
    is pushed to the cells scan; the pivot lists its column values.
    """
    k = contract
    names = list(k["semantic_columns"])
    inside = cells.filter((F.col("sheet") == k["sheet"]) & F.col("row").between(k["r1"], k["r2"])
                          & F.col("col").between(k["c1"], k["c2"]))
    if "file" in k:
        inside = inside.filter(F.col("file") == k["file"])
    inside = inside.select("file", "row", (F.col("col") - F.lit(k["c1"]) + 1).alias("idx"), "value")
    wide = inside.groupBy("file", "row").pivot("idx", list(range(1, len(names) + 1))).agg(F.first("value"))
    # every declared row of every workbook that has the sheet
    spine = cells.filter(F.col("sheet") == k["sheet"]).select("file").distinct()
    if "file" in k:
        spine = spine.filter(F.col("file") == k["file"])
    rows = spine.select("file", F.explode(F.sequence(F.lit(k["r1"]), F.lit(k["r2"]))).alias("row"))
    out = rows.join(wide, ["file", "row"], "left")
    return out.select("file", F.col("row").alias("_source_row"),
                      *[F.col(f"`{i}`").alias(n) for i, n in enumerate(names, 1)])


def read_ranges(cells: DataFrame, contracts: list[dict]) -> DataFrame:
    """S7 for all declared contracts at once: (file, id_table, _source_row,
    c1..cN), N the widest contract's columns.

    One range join of the cells with the contracts - equal sheets, rows and
    columns within the rectangle - serves every table.  Every declared row of
    every workbook that has the sheet is kept, empty or not; columns beyond a
    contract's own are null.  Two cells at one place give the lesser text.
    """
    spark = cells.sparkSession
    k = spark.createDataFrame([(c["id_table"], c["sheet"], c["r1"], c["c1"], c["r2"], c["c2"]) for c in contracts],
                              "id_table int, _sheet string, r1 int, c1 int, r2 int, c2 int")
    width = max(len(c["semantic_columns"]) for c in contracts)
    inside = cells.join(k, (F.col("sheet") == F.col("_sheet")) & F.col("row").between(F.col("r1"), F.col("r2"))
                        & F.col("col").between(F.col("c1"), F.col("c2")))
    place = F.col("col") - F.col("c1") + 1
    wide = inside.groupBy("file", "id_table", "row").agg(*[F.min(F.when(place == i, F.col("value"))).alias(f"c{i}") for i in range(1, width + 1)])
    sheets = cells.select("file", "sheet").distinct()
    spine = (sheets.join(k, F.col("sheet") == F.col("_sheet"))
             .select("file", "id_table", F.explode(F.sequence("r1", "r2")).alias("row")))
    return spine.join(wide, ["file", "id_table", "row"], "left").withColumnRenamed("row", "_source_row")


def check_ranges(cells: DataFrame, contracts: DataFrame) -> DataFrame:
    """PASS/FAIL with the reason flags per workbook and contract.

    A contract whose sheet no workbook has gets one row without a file.
    """
    c = contracts.withColumnRenamed("sheet", "_sheet")
    here = cells.select(F.col("file").alias("_file"), F.col("sheet").alias("_s")).distinct()
    base = contracts.join(here, F.col("sheet") == F.col("_s"), "left")
    inside = cells.join(c, cells.sheet == c._sheet)
    hdr = inside.filter(F.col("row").between(F.col("hdr_r1"), F.col("hdr_r2")) & F.col("col").between(F.col("hdr_c1"), F.col("hdr_c2"))) \
        .groupBy("file", "id_table").agg(F.sort_array(F.collect_list(F.struct("row", "col", "value"))).alias("_h"))
    hdr = hdr.select(F.col("file").alias("_hf"), F.col("id_table").alias("_hi"),
                     normalize_match(F.concat_ws(" ", F.col("_h.value"))).alias("header_text"))
    data = inside.filter(F.col("row").between(F.col("r1"), F.col("r2")) & F.col("col").between(F.col("c1"), F.col("c2"))) \
        .groupBy(F.col("file").alias("_df"), F.col("id_table").alias("_di")).agg(F.count_if(F.trim("value") != "").alias("nonblank_cells"))
    j = base.join(hdr, (F.col("_file") == F.col("_hf")) & (F.col("id_table") == F.col("_hi")), "left") \
        .join(data, (F.col("_file") == F.col("_df")) & (F.col("id_table") == F.col("_di")), "left")
    exists = F.col("_file").isNotNull()
    width_ok = (F.col("c2") - F.col("c1") + 1) == F.size("semantic_columns")
    tokens_ok = F.forall("required_tokens", lambda t: F.coalesce(F.instr("header_text", t) > 0, F.lit(False)))
    has_data = F.coalesce(F.col("nonblank_cells"), F.lit(0)) > 0
    ok = exists & width_ok & tokens_ok & has_data
    return j.select(F.col("_file").alias("file"), "id_table", "name", "sheet", exists.alias("sheet_exists"), width_ok.alias("width_ok"),
                    tokens_ok.alias("tokens_ok"), F.coalesce("nonblank_cells", F.lit(0)).alias("nonblank_cells"),
                    F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))


def locate_header(cells: DataFrame, aliases: DataFrame, max_row: int = 40) -> DataFrame:
    """Per sheet the header row (all canonical names matched by an alias
    within the first ``max_row`` rows) and per name its leftmost column.
    ``status``: FOUND, NOT_FOUND or AMBIGUOUS."""
    n_names = aliases.select(F.count_distinct("canonical")).scalar()
    al = aliases.select("canonical", normalize_match("alias").alias("_a")).distinct()
    top = cells.filter(F.col("row") <= max_row).withColumn("_v", normalize_match("value"))
    m = top.join(al, top._v == al._a, "inner")
    per_row = m.groupBy("file", "sheet", "row").agg(
        F.count_distinct("canonical").alias("_n"),
        F.sort_array(F.collect_list(F.struct("canonical", "col"))).alias("_pairs"))
    hdr_rows = per_row.filter(F.col("_n") == n_names)
    sheets = cells.select("file", "sheet").distinct()
    found = hdr_rows.groupBy("file", "sheet").agg(
        F.count(F.lit(1)).alias("matches"), F.min_by("row", "row").alias("header_row"),
        F.min_by("_pairs", "row").alias("_pairs"))
    j = sheets.join(found, ["file", "sheet"], "left")
    # leftmost column per canonical name
    cmap = F.aggregate(
        F.coalesce(F.col("_pairs"), F.array().cast("array<struct<canonical:string,col:int>>")),
        F.create_map().cast("map<string,int>"),
        lambda acc, x: F.when(F.element_at(acc, x["canonical"]).isNull(),
                              F.map_concat(acc, F.create_map(x["canonical"], x["col"]))).otherwise(acc))
    status = (F.when(F.col("matches").isNull(), F.lit("NOT_FOUND"))
              .when(F.col("matches") > 1, F.lit("AMBIGUOUS")).otherwise(F.lit("FOUND")))
    out = j.select("file", "sheet", status.alias("status"), F.coalesce("matches", F.lit(0)).alias("matches"),
                   F.when(status == "FOUND", F.col("header_row")).alias("header_row"),
                   F.when(status == "FOUND", cmap).alias("header_map"))
    return out


def header_map_text(col: str = "header_map"):
    """Canonical text of a header map: ``name:col`` pairs sorted by name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(F.col(col))),
                                    lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")


def sheet_extent(cells: DataFrame, headers: DataFrame, title_token: str = "EXPORTACIONES", scope_token: str = "PERIODO:",
                 required_tokens: tuple = ()) -> DataFrame:
    """Per sheet with a header: last data row (any header column
    non-blank), and from the lines above the header (cells collapsed and joined
    by `` | ``) the first whose folded text has ``title_token``, the first that
    has ``scope_token`` (both empty when none has), the first cell that is a
    date and time, and the ``required_tokens`` that no line has."""
    h = headers.filter(F.col("status") == "FOUND").select(
        "file", "sheet", "header_row", F.map_values("header_map").alias("_cols"), "header_map")
    j = cells.join(h, ["file", "sheet"], "inner")
    below = j.filter((F.col("row") > F.col("header_row")) & F.array_contains("_cols", F.col("col"))
                     & (F.trim("value") != ""))
    last = below.groupBy("file", "sheet").agg(F.max("row").alias("last_row"))
    text = F.trim(F.regexp_replace("value", r"\s+", " "))
    moment = F.when(F.rlike(text, F.lit(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$")), text)
    pre = j.filter((F.col("row") < F.col("header_row")) & (F.trim("value") != "")).groupBy("file", "sheet", "row").agg(
        F.concat_ws(" | ", F.transform(F.sort_array(F.collect_list(F.struct("col", text.alias("value")))),
                                       lambda x: x["value"])).alias("line"),
        F.min_by(moment, F.when(moment.isNotNull(), F.col("col"))).alias("moment"))
    pre = pre.withColumn("folded", normalize_match("line"))

    def first(token: str) -> Column:
        has = F.col("folded").contains(token)
        return F.coalesce(F.min_by(F.when(has, F.col("line")), F.when(has, F.col("row"))), F.lit(""))

    found = [F.max(F.col("folded").contains(F.upper(strip_accents(F.lit(t))))).alias(f"_t{i}") for i, t in enumerate(required_tokens)]
    lines = pre.groupBy("file", "sheet").agg(
        first(title_token).alias("title"), first(scope_token).alias("scope"),
        F.min_by("moment", F.when(F.col("moment").isNotNull(), F.col("row"))).alias("generated_at"),
        F.count(F.lit(1)).alias("preamble_lines"), *found)
    missing = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(~F.coalesce(f"_t{i}", F.lit(False)), F.lit(t)) for i, t in enumerate(required_tokens)]))
    out = h.drop("_cols").join(last, ["file", "sheet"], "left").join(lines, ["file", "sheet"], "left")
    return out.withColumn("missing_tokens", missing).drop(*[f"_t{i}" for i in range(len(required_tokens))])


def require_tokens(extent: DataFrame) -> DataFrame:
    """Raise when a sheet's preamble lacks a required token (the report is not
    the one the contract names); otherwise the extent, unchanged."""
    bad = extent.filter(F.size("missing_tokens") > 0).select("file", "sheet", "missing_tokens").limit(10).collect()
    if bad:
        raise ValueError(f"reports without their required tokens: {[tuple(r) for r in bad]}")
    return extent


def structure_hash(extent: DataFrame) -> DataFrame:
    """SHA-256 over sheet, header row, last row, header map, title, scope."""
    text = F.concat_ws("|", F.col("sheet"), F.col("header_row").cast("string"), F.col("last_row").cast("string"),
                       header_map_text(), F.coalesce("title", F.lit("")), F.coalesce("scope", F.lit("")))
    return extent.select("file", "sheet", F.sha2(text, 256).alias("structure_sha256"))


def extract_records(cells: DataFrame, extent: DataFrame, identifiers: dict, measures=(),
                    texts=()) -> DataFrame:
    """One record per data row with its source row; per-column readers:
    identifier (zero-padded to width), measure (trimmed text), plain text.
    Fully blank rows are dropped (F1)."""
    e = extent.select("file", "sheet", "header_row", "last_row",
                      F.explode("header_map").alias("canonical", "col"))
    j = cells.join(e, ["file", "sheet", "col"], "inner").filter(
        (F.col("row") > F.col("header_row")) & (F.col("row") <= F.col("last_row")))
    names = list(identifiers) + list(measures) + list(texts)
    wide = j.groupBy("file", "sheet", F.col("row").alias("_source_row")).pivot("canonical", names) \
        .agg(F.first("value"))
    cols = [identifier(F.col(n), w).alias(n) for n, w in identifiers.items()]
    cols += [measure_text(F.col(n)).alias(n) for n in measures]
    cols += [F.col(n).cast("string").alias(n) for n in texts]
    out = wide.select("file", "sheet", "_source_row", *cols)
    blank = [F.when(F.trim(F.col(n)) == "", F.lit(None)).otherwise(F.col(n)) for n in names]
    return out.withColumns({n: b for n, b in zip(names, blank)}).dropna(how="all", subset=names)
