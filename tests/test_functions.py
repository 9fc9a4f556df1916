"""Edge cases of the scalar functions (O1–O29) on inline rows."""

import datetime as dt
import hashlib
import random
import re
import unicodedata

from pyspark.sql import functions as F

from mensura import functions as M
from mensura.functions.text import NULL_TOKENS_WITH_DASH


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def many(spark, fn, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r["r"] for r in df.select(fn(F.col("v")).alias("r")).collect()]


def test_clean_text(spark):
    out = many(spark, M.clean_text, ["A B", "  a \t b  ", "n/a", "-", "​X", None, "nan", " NULL "])
    assert out == ["AB", "a b", None, "-", "X", None, None, None]
    assert many(spark, lambda c: M.clean_text(c, NULL_TOKENS_WITH_DASH), ["-", "x"]) == [None, "x"]


def test_normalize_match(spark):
    assert many(spark, M.normalize_match, ["Ñandú  camarón ", "Ça"]) == ["NANDU CAMARON", "CA"]
    assert many(spark, lambda c: M.normalize_match(c, "lower"), ["ÁB"]) == ["ab"]
    assert many(spark, M.normalize_match, ["ﬁn  é", "\u2003ª１\u00a0", "हिन्दी"]) == ["FIN E", "A1", "हिनदी"]
    assert many(spark, lambda c: M.normalize_match(c, "lower"), ["ÑANDÚ ÉL"]) == ["nandu el"]


def _assigned():
    return [chr(cp) for cp in range(1, 0x110000) if not 0xD800 <= cp < 0xE000 and unicodedata.category(chr(cp)) not in ("Cn", "Co")]


def _fold(v):
    return "".join(ch for ch in unicodedata.normalize("NFKD", v) if not unicodedata.combining(ch))


def test_folding_and_composition_on_every_assigned_code_point(spark):
    df = spark.createDataFrame([(c,) for c in _assigned()], "c string").repartition(8)
    assert [r.c for r in df.select("c", M.strip_accents("c").alias("x")).collect() if r.x != _fold(r.c)] == []
    assert [r.c for r in df.select("c", M.nfkc("c").alias("x")).collect() if r.x != unicodedata.normalize("NFKC", r.c)] == []


def test_composition_of_random_sequences(spark):
    rnd, every = random.Random(2), _assigned()
    marks = [c for c in every if unicodedata.combining(c)]
    parts = [c for c in every if unicodedata.normalize("NFKD", c) != c and not 0xAC00 <= ord(c) < 0xD7A4]
    jamo = [chr(c) for c in [*range(0x1100, 0x1113), *range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]] + ["가", "각", "힣"]
    texts = ["".join(rnd.choice([rnd.choice("aeioucnAEs "), rnd.choice(marks), rnd.choice(marks[:60]), rnd.choice(parts), rnd.choice(jamo), rnd.choice(every)])
                     for _ in range(rnd.randint(0, 12))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "c string").repartition(8)
    assert [r.c for r in df.select("c", M.nfkc("c").alias("x")).collect() if r.x != (r.c and unicodedata.normalize("NFKC", r.c))] == []
    assert [r.c for r in df.select("c", M.normalize_match("c", None).alias("x")).collect()
            if r.x != (r.c and re.sub(r"\s+", " ", _fold(r.c)).strip())] == []


def test_file_names_are_composed(spark):
    assert many(spark, M.safe_filename, ["http://x/ﬁle１.xlsx", "http://x/e%CC%81t%C3%A9.pdf", "http://x/a%C2%A0b.csv"]) == ["file1.xlsx", "été.pdf", "a b.csv"]


def test_loses_at_scale(spark):
    assert many(spark, lambda c: M.loses_at_scale(c.cast("double"), 6), ["1.5", "0.1234567", "123456789.12", "1e-9", None]) == [False, True, False, True, None]


def test_canonical_label(spark):
    assert many(spark, M.canonical_label, [" eeuu ", "Perú", "Çà", "usa", "-"]) == \
        ["ESTADOS UNIDOS", "PERU", "ÇÀ", "ESTADOS UNIDOS", None]


def test_parse_number_and_int(spark):
    vals = ["1,234", "12,5", "1.234,5", "1,234.56", "12%", "$5", "abc", "1234,56", "-3", None]
    assert many(spark, M.parse_number, vals) == [1234.0, 12.5, None, 1234.56, 12.0, 5.0, None, 1234.56, -3.0, None]
    assert many(spark, M.parse_int, ["2025.7", "1,234", "x"]) == [2025, 1234, None]


def test_parse_date(spark):
    d = dt.date(2026, 5, 1)
    assert many(spark, M.parse_date, ["2026-05-01 00:00:00", "2026-05-01", "01/05/2026", "garbage", None]) == \
        [d, d, d, None, None]


def test_infer_month_and_year(spark):
    # "_" is a word character, so "informe_mayo" names no month (as in the source rule)
    assert many(spark, M.infer_month, ["informe mayo 2025.xlsx", "ENERO y MAYO", "MAYORISTA", None,
                                       "informe_mayo_2025"]) == [5, 1, None, None, None]
    df = spark.createDataFrame([("f 2024.xlsx", "http://x/2023/", "a"), (None, "http://x/2023/a", None),
                                ("a", "b", "c 2019"), ("f_2024.xlsx", "u", "a")], "f string, u string, a string")
    assert [r[0] for r in df.select(M.infer_year("f", "u", "a")).collect()] == [2024, 2023, 2019, None]


def test_identifier(spark):
    vals = ["1402.0", "306160000", "0306.0", "ABC", "12345", " 7 "]
    assert many(spark, lambda c: M.identifier(c, 4), vals) == ["1402", "306160000", "0306", "ABC", "12345", "0007"]
    assert many(spark, lambda c: M.identifier(c, 10), ["306160000"]) == ["0306160000"]


def test_parse_period(spark):
    df = spark.createDataFrame([("2021 / 01 - Enero",), ("2021/13 - X",), ("bad",)], "p string")
    y, m, d = M.parse_period("p")
    out = [tuple(r) for r in df.select(y, m, d).collect()]
    assert out == [(2021, 1, dt.date(2021, 1, 1)), (2021, 13, None), (None, None, None)]


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2025, 5, 1),)], "d date")
    r = df.select(*[v.alias(k) for k, v in M.calendar_columns("d").items()]).first().asDict()
    assert r == {"date_key": 20250501, "year": 2025, "month": 5, "month_name": "Mayo", "year_month": "2025-05",
                 "quarter": 2, "semester": 1}
    assert many(spark, M.month_name, [13, 0, 12], "v int") == [None, None, "Diciembre"]


def test_ratio_growth_tolerance(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (10.0, None), (None, 2.0)], "n double, d double")
    assert [r[0] for r in df.select(M.ratio("n", "d")).collect()] == [None, 2.5, None, None]
    assert [r[0] for r in df.select(M.ratio("n", "d", den_factor=1000.0)).collect()] == [None, 0.0025, None, None]
    t = spark.createDataFrame([(100.0, 100.5), (100.0, 102.0)], "a double, b double")
    assert [r[0] for r in t.select(M.within_tolerance("a", "b", 1.0, 1e-6)).collect()] == [True, False]


def test_dual_scale_and_match_label(spark):
    df = spark.createDataFrame([(112.0, 100.0, 0.12), (112.0, 100.0, 12.0), (112.0, 100.0, 5.0)],
                               "c double, p double, s double")
    assert [r[0] for r in df.select(M.dual_scale_violation("c", "p", "s")).collect()] == [False, False, True]
    m = spark.createDataFrame([(None, 0.1), (1e-7, 0.1), (0.5, 0.1)], "d double, r double")
    assert [r[0] for r in m.select(M.match_label("d", "r")).collect()] == ["NO_COMPARABLE", "COINCIDE", "REVISAR"]


def test_hashes_and_names(spark):
    assert one(spark, M.surrogate_key(F.col("v")), "PERU") == hashlib.sha256(b"PERU").hexdigest()
    assert one(spark, M.resource_id(F.col("v")), "http://a") == hashlib.sha256(b"http://a").hexdigest()[:12]
    urls = ["http://x/a%20b/Informe%3AMayo.xlsx?x=1", "http://x/", "http://x/ .a. ",
            "http://x/a%3Fb.xlsx", "http://x/a+b.pdf?q#f", "http://x/d/a%2Fb.xls"]
    assert many(spark, M.safe_filename, urls) == ["Informe_Mayo.xlsx", "archivo_descargado", "a", "a_b.xlsx", "a+b.pdf", "b.xls"]
    assert many(spark, M.normalize_match, ["cafe\u0301 Ñandú", " a  b "]) == ["CAFE NANDU", "A B"]
    assert one(spark, M.normalize_match(F.col("v"), case="lower"), "CAFE\u0301") == "cafe"


def test_row_sum_and_json(spark):
    df = spark.createDataFrame([(1.0, None, 2.0)], "b double, a double, c double")
    assert df.select(M.row_sum(["a", "b", "c"])).first()[0] == 3.0
    assert df.select(M.canonical_json(df)).first()[0] == '{"a":null,"b":1.0,"c":2.0}'


def test_exact_sum_is_order_independent(spark):
    vals = [(0.1,), (0.2,), (0.3,)] * 50
    a = spark.createDataFrame(vals, "v double").repartition(7)
    b = spark.createDataFrame(list(reversed(vals)), "v double").coalesce(1)
    assert a.agg(M.exact_sum("v", 6)).first()[0] == b.agg(M.exact_sum("v", 6)).first()[0] == 30.0


def test_exact_sum_needs_a_scale_that_holds_the_values(spark):
    df = spark.createDataFrame([(1e-7,), (2e-7,), (1.25,)], "v double")
    assert [r[:] for r in df.select(M.loses_at_scale("v", 6), M.loses_at_scale("v", 8)).collect()] == [(True, False), (True, False), (False, False)]
    assert df.select(M.exact_sum("v", 8)).first()[0] == 1.2500003
