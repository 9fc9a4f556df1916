"""Language identification: automata, parses and predictions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mensura.llm import language as L
from mensura.llm.common import table

ROOT = "/root/testdata/sf0.01"


def test_automaton_takes_exactly_the_substrings():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5, 30):
        text = rng.integers(0, 3, n).tolist()
        step = L.suffix_automaton(text)
        inside = {tuple(text[i:j]) for i in range(n) for j in range(i, n + 1)} | {()}
        assert len(step) <= max(1, 2 * n)
        for size in range(5):
            for code in range(3 ** size):
                word = tuple(code // 3 ** k % 3 for k in range(size))
                state = 0
                for c in word:
                    state = step[state].get(c) if state is not None else None
                assert (state is not None) == (word in inside)


def phrases(text, pool, known):
    """Greedy longest matches, one symbol at least, cut every BLOCK symbols."""
    count = 0
    for lo in range(0, len(text), L.BLOCK):
        part, at = text[lo:lo + L.BLOCK], 0
        while at < len(part):
            size = 1
            while at + size < len(part) and part[at:at + size + 1] in pool:
                size += 1
            count, at = count + 1, at + size
    return count


def test_parse_is_greedy_longest_match():
    pools = {"xx": ["abc abd, the cab", "ein Öl"], "yy": ["zzz yyy zy é" * 4]}
    model = L.Model(pools)
    parser = L.Parser(model)
    texts = ["abc", "Abd cab!!  the ZYzy", "unknown кот 中", "é" * 3, "ab " * 300, "", None, "12 --"]
    cost, n = parser.costs(texts)
    for i, text in enumerate(texts):
        s = L.symbols(text or "", model.symbol)
        if not (s != L.BLANK).any():
            assert n[i] == 0
            continue
        as_text = "".join(map(chr, s + 100))
        for j, name in enumerate(model.languages):
            own = L.symbols("\n".join(pools[name]).lower(), model.symbol)
            pool = "".join(map(chr, own[own != L.OTHER] + 100))
            assert cost[j, i] * n[i] == pytest.approx(phrases(as_text, pool, own) * np.log2(len(own)))


def test_held_out_accuracy(spark):
    docs = table(spark, ROOT, "documents")
    model = L.train(docs.where(~L.held_out()))
    got = L.predict(docs.withColumn("held", L.held_out()), model, ("doc_id", "lang", "held")).where("held AND lang IS NOT NULL")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right / n > 0.97


def test_odd_rows_and_empty_tables(spark, odd, nothing):
    taught = spark.createDataFrame([("the and of with", "en"), ("der und die mit", "de"), (None, "fr"), ("x", None)], "text string, lang string")
    model = L.train(taught)
    assert model.languages == ["de", "en"]
    got = L.predict(odd, model, ("doc_id", "kind")).select("doc_id", "lang_pred").collect()
    assert {r[1] for r in got if r[0] in (1, 2, 3)} == {"und"}
    assert all(r[1] in ("de", "en") for r in got if r[0] not in (1, 2, 3)) and len(got) == odd.count()
    assert L.predict(nothing, model, ("doc_id",)).count() == 0
    blank = L.train(taught.limit(0))
    assert {tuple(r) for r in L.predict(odd, blank).collect()} == {("und", 0.0)}


def test_score_is_between_zero_and_one(spark):
    taught = spark.createDataFrame([("the and of with", "en"), ("der und die mit", "de")], "text string, lang string")
    got = L.predict(spark.createDataFrame([("the und",), ("q",), ("the " * 999,)], "text string"), L.train(taught)).collect()
    assert all(0 < r["score"] <= 1 for r in got) and got[1]["lang_pred"] == "de" and got[1]["score"] == 0.5


def test_hot_text_does_not_crowd_out_the_sample(spark):
    taught = spark.range(2000).select(F.when(F.col("id") < 1500, "the same text").otherwise(F.concat(F.lit("another text "), F.col("id"))).alias("text"), F.lit("en").alias("lang"))
    assert len(L.train(taught).edges[0][1]) > 1000
