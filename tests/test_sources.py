"""Link discovery, page fingerprints and spreadsheet cells on inline fixtures."""

import hashlib

import pytest

from mensura.sources import cells as C
from mensura.sources import links as L

HTML = ('<html><head><script>var a="<a href=\\"x\\">";</script><style>p{}</style></head><body>'
        '<nav><a href="/datos/Informe%20Mayo%202025.xlsx">Informe <b>mayo</b> 2025</a>'
        '<a class="c" href="anexo.pdf">Anexo</a>'
        '<a href="https://other.org/a.xlsx#frag">Datos 2024</a>'
        '<a href="//cdn.org/ad.xlsx">publicidad</a>'
        '<a href="/datos/Informe%20Mayo%202025.xlsx">again</a></nav>'
        '<p>Precio &amp; volumen</p><!-- hidden --></body></html>')


def test_anchors_and_discovery(spark):
    pages = spark.createDataFrame([(1, "https://site.org/es/reportes/index.html?x=1", HTML)],
                                  "page_id long, url string, html string")
    a = {r["pos"]: (r["link_url"], r["anchor_text"]) for r in L.anchors(pages).collect()}
    assert a[0] == ("https://site.org/datos/Informe%20Mayo%202025.xlsx", "Informe mayo 2025")
    assert a[1][0] == "https://site.org/es/reportes/anexo.pdf"
    assert a[2][0] == "https://other.org/a.xlsx"
    assert a[3][0] == "https://cdn.org/ad.xlsx"
    cfg = L.LinkConfig(extensions=(".xlsx",), include=("informe", "datos"), exclude=("publicidad",))
    got = {r["link_url"]: (r["pos"], r["year"], r["month"]) for r in L.discover_links(pages, cfg).collect()}
    # the name is decoded before the year and month are looked for
    assert got == {"https://site.org/datos/Informe%20Mayo%202025.xlsx": (0, 2025, 5),
                   "https://other.org/a.xlsx": (2, 2024, None)}


def test_visible_text_and_fingerprint(spark):
    pages = spark.createDataFrame([(1, "https://s.org/", HTML)], "page_id long, url string, html string")
    vt = pages.select(L.visible_text("html")).first()[0]
    assert vt == "Informe mayo 2025 Anexo Datos 2024 publicidad again Precio & volumen"
    cfg = L.LinkConfig(extensions=(".xlsx",), include=("informe", "datos"), exclude=("publicidad",))
    fp = L.page_fingerprint(pages, cfg).first()
    urls = sorted({"https://s.org/datos/Informe%20Mayo%202025.xlsx", "https://other.org/a.xlsx"})  # candidates only
    assert fp["url_set_sha256"] == hashlib.sha256("\n".join(urls).encode()).hexdigest()
    assert fp["visible_text_sha256"] == hashlib.sha256(vt.lower().encode()).hexdigest()
    assert fp["total_discovered_urls"] == 2
    prev = spark.createDataFrame([(1, fp["visible_text_sha256"], "old")],
                                 "page_id long, visible_text_sha256 string, url_set_sha256 string")
    cmp_ = L.compare_fingerprints(prev, L.page_fingerprint(pages, cfg)).first()
    assert cmp_["comparable"] and cmp_["changed"] and not cmp_["visible_text_changed"]


def test_anchor_forms(spark):
    html = """<A HREF='../d.pdf'>foo<b>bar</b></A> <a
      href="x/./y/../z.pdf?q=1#f">two
      lines</a><a href="mailto:a@b.c">mail</a><a id=k href="?p=2">q</a><a name="n">no</a><a href='a.pdf?x=1&amp;y=2'>&lt;e&gt;</a><a href="../../../up.pdf">u</a>"""
    pages = spark.createDataFrame([(1, "http://h.org/a/b/c.html?x", html)], "page_id long, url string, html string")
    got = [(r.link_url, r.anchor_text) for r in L.anchors(pages).orderBy("pos").collect()]
    assert got == [("http://h.org/a/d.pdf", "foo bar"), ("http://h.org/a/b/x/z.pdf?q=1", "two lines"), ("http://h.org/a/b/c.html?p=2", "q"),
                   ("http://h.org/a/b/a.pdf?x=1&y=2", "<e>"), ("http://h.org/up.pdf", "u")]
    years = L.LinkConfig(extensions=(".pdf",), years=(2025,))
    page = spark.createDataFrame([(1, "http://h.org/", '<a href="Informe%202025.pdf">a</a><a href="b2025.pdf">b</a><a href="c.pdf">mayo 2025</a>')],
                                 "page_id long, url string, html string")
    assert sorted((r.link_url, r.year, r.month) for r in L.discover_links(page, years).collect()) == [
        ("http://h.org/Informe%202025.pdf", 2025, None), ("http://h.org/c.pdf", 2025, 5)]


def test_ranges_by_workbook(spark):
    rows = [("f1", "V", 1, 1, "AÑO"), ("f1", "V", 2, 1, "1"), ("f2", "V", 1, 1, "OTRO"), ("f2", "V", 2, 1, "2"), ("f2", "V", 3, 2, "x"), ("f3", "W", 1, 1, "w")]
    cells = spark.createDataFrame(rows, "file string, sheet string, row int, col int, value string")
    rng = C.read_range(cells, dict(sheet="V", r1=2, r2=3, c1=1, c2=2, semantic_columns=["a", "b"]))
    assert sorted(map(tuple, rng.collect()), key=str) == [("f1", 2, "1", None), ("f1", 3, None, None), ("f2", 2, "2", None), ("f2", 3, None, "x")]
    con = C.contracts_frame(spark, [(1, "t", "V", 1, 1, 1, 2, 2, 1, 3, 2, ["a", "b"], ["ANO"]), (2, "t", "Z", 1, 1, 1, 2, 2, 1, 3, 2, ["a", "b"], [])])
    assert sorted(((r.file, r.id_table, r.status, r.nonblank_cells) for r in C.check_ranges(cells, con).collect()), key=str) == [
        ("f1", 1, "PASS", 1), ("f2", 1, "FAIL", 2), (None, 2, "FAIL", 0)]


def test_cells_header_extent_records(spark):
    rows = [("f", "S", 1, 1, "Título del reporte"), ("f", "S", 2, 1, " Período:  mayo"), ("f", "S", 2, 2, "2025"),
            ("f", "S", 3, 1, "2025-06-01 10:00:00"), ("f", "S", 3, 2, "Exportaciónes"),
            ("f", "S", 4, 2, "Código"), ("f", "S", 4, 3, "Valor"), ("f", "S", 4, 5, "Código"),
            ("f", "S", 5, 2, "1402.0"), ("f", "S", 5, 3, " 10,5 "), ("f", "S", 6, 2, ""), ("f", "S", 6, 3, " "),
            ("f", "S", 7, 2, "306"), ("f", "S", 7, 3, "7"), ("f", "T", 1, 1, "nada")]
    cells = spark.createDataFrame(rows, "file string, sheet string, row int, col int, value string")
    aliases = spark.createDataFrame([("code", "CODIGO"), ("value", "VALOR")], "canonical string, alias string")
    h = {r["sheet"]: r for r in C.locate_header(cells, aliases).collect()}
    assert h["S"]["status"] == "FOUND" and h["S"]["header_row"] == 4 and h["S"]["header_map"] == {"code": 2,
                                                                                                  "value": 3}
    assert h["T"]["status"] == "NOT_FOUND"
    extent = C.sheet_extent(cells, C.locate_header(cells, aliases), required_tokens=("reporte", "período", "banco"))
    ext = extent.first()
    assert (ext["last_row"], ext["title"], ext["scope"]) == (7, "2025-06-01 10:00:00 | Exportaciónes", "Período: mayo | 2025")
    assert (ext["generated_at"], ext["missing_tokens"]) == ("2025-06-01 10:00:00", ["banco"])
    with pytest.raises(ValueError, match="banco"):
        C.require_tokens(extent)
    rec = C.extract_records(cells, C.sheet_extent(cells, C.locate_header(cells, aliases)), {"code": 4},
                            measures=["value"]).orderBy("_source_row").collect()
    assert [(r["_source_row"], r["code"], r["value"]) for r in rec] == [(5, "1402", "10,5"), (7, "0306", "7")]
    rng = C.read_range(cells, dict(sheet="S", r1=5, r2=8, c1=2, c2=3, semantic_columns=["code", "value"]))
    assert [r["_source_row"] for r in rng.orderBy("_source_row").collect()] == [5, 6, 7, 8]


def test_cells_from_text(spark, tmp_dir):
    import os

    os.makedirs(os.path.join(tmp_dir, "wb"))
    with open(os.path.join(tmp_dir, "wb", "VALOR.csv"), "w", encoding="utf-8") as fh:
        fh.write("Exportaciones\nFuente: registro\n\nAño;Enero;Total\n2024.0;1,5;1,5\n;;\n2025.0;2;2\n")
    cells = C.cells_from_text(spark, os.path.join(tmp_dir, "wb"))
    got = {(r["sheet"], r["row"], r["col"]): r["value"] for r in cells.collect()}
    assert got[("VALOR", 4, 1)] == "Año" and got[("VALOR", 5, 2)] == "1,5" and got[("VALOR", 7, 1)] == "2025.0"
    assert not any(k[1] == 6 for k in got)
    aliases = spark.createDataFrame([("year", "ANO"), ("jan", "ENERO"), ("total", "TOTAL")],
                                    "canonical string, alias string")
    h = C.locate_header(cells, aliases).first()
    assert h["status"] == "FOUND" and h["header_row"] == 4
    rec = C.extract_records(cells, C.sheet_extent(cells, C.locate_header(cells, aliases)), {"year": 4},
                            measures=["jan", "total"]).orderBy("_source_row").collect()
    assert [(r["_source_row"], r["year"], r["jan"]) for r in rec] == [(5, "2024", "1,5"), (7, "2025", "2")]
