"""Importance resampling against a plain version of its definition."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from mensura.llm import resample as R

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def features(text, lo, hi):
    w = WORDS.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i:i + k]) for k in range(lo, hi + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, lo, hi, buckets, least, percent, seed):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, x in docs for f in features(x, lo, hi)[1])
    t = Counter(bucket(f) for x in target for f in features(x, lo, hi)[1])
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, x in docs:
        w, f = features(x, lo, hi)
        g = [math.floor(1000 * math.log((t[bucket(y)] + 1) * (S + buckets) / ((s[bucket(y)] + 1) * (T + buckets)))) for y in f]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return sorted((tuple(r) + (rank.get(id(r)),) for r in out), key=str)


TEXTS = ["The quick brown fox", "the QUICK fox\x00jumps_over the lazy dog é中文 ü", None, "", " \n", "😀 a1 b2 " * 30, "one two three four five six seven " * 5]


@pytest.mark.parametrize("lo,hi,percent", [(1, 1, 40), (1, 3, 50), (2, 2, 100)])
def test_same_as_plain_version(spark, frame, lo, hi, percent):
    docs = [(i, TEXTS[i % len(TEXTS)] and TEXTS[i % len(TEXTS)] + f" extra{i % 3}") for i in range(40)] + [(None, "no id but some words here")]
    target = ["brown fox and lazy dog", None, "three four extra1"]
    got = R.resample(frame(docs), spark.createDataFrame([(x,) for x in target], "text string"), lo, hi, 50, 4, percent, 7)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, target, lo, hi, 50, 4, percent, 7)


def test_pieces_keep_words_offsets_and_windows(monkeypatch):
    text = "Aa bb, cc " + "d" * 50 + " ee ff gg"
    whole = [(m.group(), m.span()) for m in WORDS.finditer(text.translate(LOWER))]
    want = Counter(features(text, 1, 3)[1])
    for piece in (1, 3, 7, 1000):
        monkeypatch.setattr(R, "PIECE", piece)
        split = R.splitter()
        assert [w for p in R.split_words(text, split) for w in p] == whole
        assert R.feature_counts(text, split, 1, 3) == (len(whole), want)


def test_odd_and_empty(spark, odd, nothing):
    target = spark.createDataFrame([("one two",)], "text string")
    assert R.resample(odd, target, least_words=1, percent=50).count() == odd.count()
    ranks = sorted(r["rank"] for r in R.resample(odd, target, least_words=1, percent=50).collect() if r["rank"])
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == 3  # seven of nine rows have words
    assert R.resample(nothing, target).count() == 0
    none = R.resample(odd, target.limit(0), least_words=1).collect()
    assert len(none) == odd.count()


def test_repeated_rows_each_take_a_rank(frame, spark):
    docs = frame([(1, "a b c d")] * 30 + [(2, "e f g h")] * 10)
    got = R.resample(docs, spark.createDataFrame([("a b",)], "text string"), least_words=2, percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 21)) and len(got) == 40
