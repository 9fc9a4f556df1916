"""Chosen-path join against all pairs."""

import random
import re

from mensura.llm import setjoin


def brute(rows):
    """{(doc_id, text key): (class, copy, links, text links)} by all pairs."""
    sets = {}
    for d, t in set(rows):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        if w and d is not None:
            sets[(d, t)] = frozenset(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else frozenset([tuple(w)])
    link = {a: [b for b in sets if b != a and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])] for a in sets}
    out = {}
    for a in sets:
        seen, todo = {a}, [a]
        while todo:
            for b in link[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        same = [b for b in sets if sets[b] == sets[a]]
        out[a] = (min(b[0] for b in seen), min(b[0] for b in same), len(link[a]), len({sets[b] for b in link[a] if sets[b] != sets[a]}))
    return out


def near(rnd, words, n):
    """n words changed; in different places each time."""
    w = list(words)
    for i in rnd.sample(range(len(w)), n):
        w[i] = f"other{rnd.randrange(10**6)}"
    return " ".join(w)


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.class_id, r.copy_id, r.n_links, r.n_text_links) for r in setjoin.similar_documents(df).collect() if r.n_shingles and r.doc_id is not None}
    want = brute(rows)
    assert {(x[0], *x[2:]) for x in got} == {(d, *v) for (d, _), v in want.items()}


def test_same_links_as_all_pairs(spark):
    rnd = random.Random(5)
    rows = []
    for g in range(30):
        words = [f"w{rnd.randrange(4000)}" for _ in range(rnd.choice([8, 60, 150, 400]))]
        for _ in range(rnd.choice([1, 2, 5])):
            rows.append((len(rows), near(rnd, words, rnd.choice([0, 0, 1, 2, 3]))))
    rows += [(900, "Only Four words here"), (901, "only four, words HERE!"), (902, "")]
    check(spark, rows)


def test_large_group_of_near_copies_and_a_shared_passage(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "LEAF", 16)
    monkeypatch.setattr(setjoin, "BLOCK", 16)
    rnd = random.Random(6)
    words = [f"v{rnd.randrange(900)}" for _ in range(120)]
    rows = [(i, near(rnd, words, rnd.choice([0, 1, 2]))) for i in range(90)]
    passage = [f"p{i}" for i in range(60)]
    rows += [(1000 + i, " ".join(passage + [f"q{rnd.randrange(10**6)}" for _ in range(60)])) for i in range(60)]
    check(spark, rows)


def test_recall_of_the_paths():
    assert setjoin.recall() > 0.99999
    assert setjoin.recall(setjoin.MAX_DEPTH) > 0.99


def test_odd_rows(spark, odd, nothing):
    got = {(r.doc_id, r.class_id, r.n_links, r.n_shingles) for r in setjoin.similar_documents(odd).collect()}
    assert (1, 1, 0, 0) in got and (2, 2, 0, 0) in got and (4, 4, 0, 1) in got and (None, None, 0, 4) in got
    assert len(got) == 8  # the repeated row counts once
    assert setjoin.similar_documents(nothing).count() == 0


def test_recall_by_similarity_band(spark):
    """Planted pairs, alone and beside a large group of near copies, against
    exact similarity: the links found in each band."""
    rnd = random.Random(21)
    rows, pairs = [], []
    for k in range(240):
        size = rnd.choice([60, 120, 400])
        words = [f"p{k}x{rnd.randrange(10 ** 6)}" for _ in range(size)]
        other = near(rnd, words, max(1, int(size * rnd.uniform(0.003, 0.026))))
        rows += [(2 * k, " ".join(words)), (2 * k + 1, other)]
        pairs.append((2 * k, 2 * k + 1))
    hub = [f"hub{i}" for i in range(400)]
    rows += [(10_000 + i, near(rnd, hub, 2)) for i in range(450)]  # one bucket of more than a leaf
    rows.append((20_000, near(rnd, hub, 6)))
    text = dict(rows)

    def shingles(t):
        w = t.split()
        return set(zip(*(w[i:] for i in range(5))))

    got = {r.doc_id: r for r in setjoin.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    bands = {}
    for a, b in pairs:
        x, y = shingles(text[a]), shingles(text[b])
        s = len(x & y) / len(x | y)
        assert (got[a].class_id == got[b].class_id) <= (s >= 0.8)  # no false link
        if s >= 0.8:
            bands.setdefault(min(int(s * 20), 19), []).append(got[a].class_id == got[b].class_id)
    assert set(bands) == {16, 17, 18, 19} and min(map(len, bands.values())) >= 10
    for band, found in bands.items():
        assert sum(found) / len(found) >= 0.95, (band / 20, len(found), sum(found))
    x = shingles(text[20_000])
    want = sum(10 * len(x & (y := shingles(text[10_000 + i]))) >= 8 * len(x | y) for i in range(450))
    assert want > 100 and got[20_000].n_links >= 0.95 * want
