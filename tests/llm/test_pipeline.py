"""The pipeline, stage by stage: decisions take effect, the rest stays."""

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(name):
    return dict(P.STAGES)[name]


def docs(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_order_of_stages():
    assert [n for n, _ in P.STAGES] == ["toxicity", "jaccard_join", "decontaminate", "pii", "packing"]


def test_run_equals_the_stages_one_by_one(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    seen = set(r.doc_id for r in d.collect())
    for name, f in P.STAGES[:-1]:
        d = f(spark, d, SF)
        assert d.columns == COLUMNS
        now = [r.doc_id for r in d.collect()]
        assert len(now) == len(set(now)) and set(now) <= seen
        seen = set(now)
        d = P.staged(d, name)
    packed = P.STAGES[-1][1](spark, d, SF)
    assert set(r.doc_id for r in packed.collect()) == seen
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, packed.collect()))


def test_near_duplicates_leave_the_smallest_id(spark):
    words = [f"w{i}" for i in range(80)]
    near = words[:78] + ["x", "y"]
    rows = [(5, " ".join(words)), (3, " ".join(near)), (9, " ".join(words)), (9, " ".join(words)), (1, "another text of some words"), (2, None), (4, ""), (None, "no id"), (None, "no id")]
    got = sorted((r.doc_id or -1, r.text or "") for r in stage("jaccard_join")(spark, docs(spark, rows), SF).collect())
    assert got == [(-1, "no id"), (-1, "no id"), (1, "another text of some words"), (2, ""), (3, " ".join(near)), (4, "")]


def test_contaminated_documents_go(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(1, "Start " + item.upper()), (2, "clean words only"), (None, item), (None, "clean, without an id"), (3, None), (4, item), (4, "clean, with the id of another")]
    got = sorted(((r.doc_id or -1), r.text or "") for r in stage("decontaminate")(spark, docs(spark, rows), SF).collect())
    assert got == [(-1, "clean, without an id"), (2, "clean words only"), (3, ""), (4, "clean, with the id of another")]


def test_redaction_counts_characters_anew(spark):
    rows = [(1, "write to someone.77@mail1.example.com now"), (2, "nothing here"), (3, None)]
    got = {r.doc_id: r for r in stage("pii")(spark, docs(spark, rows), SF).collect()}
    assert got[1].text == "write to [EMAIL] now" and got[1].n_chars == len(got[1].text) and got[1].lang == "en"
    assert got[2].text == "nothing here" and got[3].text is None


def test_stages_take_an_empty_table(spark):
    nothing = docs(spark, [])
    for name, f in P.STAGES:
        assert f(spark, nothing, SF).count() == 0, name
