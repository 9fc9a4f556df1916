"""Document quality by a weak-label model.

Ten heuristic labellers overlap: eight vote bad on a defect, two vote good on
what looks like plain text and like prose, and each abstains otherwise.
Expectation-maximisation over the counts of vote patterns - all documents, a
bounded number of patterns - estimates each labeller's accuracies, and with
them the posterior that a pattern is good.  The posteriors label a bounded
sample of documents, on which a hashed linear scorer is trained; it reads the
text itself, so it also judges where the labellers abstain or disagree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features as X
from .common import sampled, table
from .words import U64, Words, buffers, mix, slices, words

DEFECTS = ("repeats", "symbols", "pipes", "capitals", "stops", "variety", "word_length", "line_length")
LABELLERS = (*DEFECTS, "plain", "prose")
#: A document is kept from this score on.
KEEP = 0.5
#: Documents the scorer is trained on, about (a share of all, chosen by hash).
TRAINING_ROWS = 10_000
BITS = 18
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#$%&*|{}<>~^@\\_=+"]] = True


def _by_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[off[1:]] - total[off[:-1]]).astype(float)


def repeats(w: Words, h: np.ndarray) -> np.ndarray:
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (w.row[1:] == w.row[:-1])
    return again


def votes(texts: pa.Array, w: Words) -> np.ndarray:
    """[row, labeller]: 1 good, 0 bad, -1 abstains."""
    raw, off = buffers(texts)
    h, rows = w.hashes(), len(texts)
    n = np.diff(w.first).astype(float)
    some, size = np.maximum(n, 1), np.maximum(np.diff(off), 1)
    distinct = np.bincount(np.unique(w.row * (1 << 40) + (h >> U64(24)).astype(np.int64)) >> 40, minlength=rows)
    stats = {
        "repeats": np.bincount(w.row, repeats(w, h), rows) / some,
        "symbols": _by_row(_SYMBOL[raw], off) / size,
        "pipes": _by_row(raw == 124, off) / some,
        "capitals": _by_row((raw >= 65) & (raw <= 90), off) / size,
        "stops": _by_row((raw == 33) | (raw == 46) | (raw == 63), off) / some,
        "variety": distinct / some,
        "word_length": np.bincount(w.row, w.end - w.start, rows) / some,
        "line_length": n / (_by_row(raw == 10, off) + 1),
    }
    fine = {"repeats": (0, 0.2), "symbols": (0, 0.02), "pipes": (0, 0.1), "capitals": (0, 0.2), "stops": (0, 0.6),
            "variety": (0.25, 1), "word_length": (2.5, 9), "line_length": (2.5, 1e9)}  # beyond it: bad
    good = {"plain": {"repeats": (0, 0.05), "symbols": (0, 0.005), "pipes": (0, 0.001), "capitals": (0.002, 0.06)},
            "prose": {"stops": (0.03, 0.3), "variety": (0.45, 1), "word_length": (4, 7), "line_length": (6, 1e9)}}
    out = np.full((rows, len(LABELLERS)), -1)
    for j, name in enumerate(DEFECTS):
        out[(stats[name] < fine[name][0]) | (stats[name] > fine[name][1]), j] = 0
    for j, name in enumerate(good, len(DEFECTS)):
        out[np.logical_and.reduce([(stats[k] >= a) & (stats[k] <= b) for k, (a, b) in good[name].items()]), j] = 1
    out[n < 5] = -1  # too short for any share to mean something
    return out


def label_model(patterns: np.ndarray, n: np.ndarray, steps: int = 500) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of good by pattern, P(vote | class) as [labeller, class,
    vote + 1], prior of good), by EM from the majority of votes."""
    vote = patterns + 1
    post = np.where((patterns == 0).any(1), 0.05, np.where((patterns == 1).any(1), 0.95, 0.7))
    given, prior = np.zeros((vote.shape[1], 2, 3)), 0.5
    for _ in range(steps):
        weight = np.stack([n * (1 - post), n * post])
        prior = float((weight[1].sum() + 1) / (n.sum() + 2))
        odds = np.full(len(n), np.log(prior / (1 - prior)))
        for j in range(vote.shape[1]):
            for y in (0, 1):
                t = np.bincount(vote[:, j], weights=weight[y], minlength=3) + 0.5
                given[j, y] = t / t.sum()
            odds += np.log(given[j, 1, vote[:, j]] / given[j, 0, vote[:, j]])
        new = X.sigmoid(odds)
        done = np.abs(new - post).max() < 1e-6
        post = new
        if done:
            break
    return post, given, prior


def _coded(votes_: np.ndarray) -> np.ndarray:
    """A pattern as one number, base 3."""
    return ((votes_ + 1) * 3 ** np.arange(votes_.shape[1])).sum(1)


def _decoded(code: np.ndarray) -> np.ndarray:
    return code[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1


def encode(texts: pa.Array, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the scorer's hashed features: each word; each stretch
    between words with how common it is in the text (by powers of two); how
    common repeats of the word before and words in capitals are."""
    raw, off = buffers(texts)
    h = w.hashes()
    n = np.maximum(np.diff(w.first), 1)

    def shares(row: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pair, count = np.unique(np.stack([row, what.view(np.int64)]), axis=1, return_counts=True) if len(row) else (np.zeros((2, 0), np.int64), np.zeros(0))
        step = np.floor(np.log2(np.maximum(count, 1) / n[pair[0]])).astype(np.int64).clip(-8, 1)
        return pair[0], mix(pair[1].view(np.uint64) + step.astype(np.uint64) * U64(0x9E3779B9))

    near = np.flatnonzero(w.row[1:] == w.row[:-1])
    gap = w.spans(w.end[near], w.start[near + 1])
    again = repeats(w, h)
    first = raw[w.start] if len(h) else raw[:0]
    last = raw[w.end - 1] if len(h) else raw[:0]
    capital = (first >= 65) & (first <= 90) & (((last >= 65) & (last <= 90)) | (last >= 128)) & (w.end - w.start > 1)
    parts = [(w.row, h), shares(w.row[near + 1], gap), shares(w.row[again], np.full(int(again.sum()), 11, np.uint64)),
             shares(w.row[capital], np.full(int(capital.sum()), 12, np.uint64))]
    row = np.concatenate([p[0] for p in parts])
    col = (mix(np.concatenate([p[1] for p in parts])) >> U64(64 - BITS)).astype(np.int64)
    return X.present(row, col, 1 << BITS)


def pattern_counts(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the vote patterns of all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for lo, hi in slices(rb.column(0)):
                texts = rb.column(0).slice(lo, hi - lo)
                code, n = np.unique(_coded(votes(texts, words(texts))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(n, pa.int64())], ["code", "n"])

    got = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").collect()
    return np.array([r["code"] for r in got], np.int64), np.array([r["n"] for r in got], float)


def train_scorer(docs: DataFrame, codes: np.ndarray, post: np.ndarray, total: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray, float]:
    """(kept columns, weights, intercept), fitted in one task on the sample."""
    own = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).alias("id"))
    sample = sampled(own, ["id", "text"], TRAINING_ROWS, total)

    def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for lo, hi in slices(rb.column(0)):
                texts = rb.column(0).slice(lo, hi - lo)
                w = words(texts)
                row, col = encode(texts, w)
                target = post[np.searchsorted(codes, _coded(votes(texts, w)))]
                cols = X.to_array(np.searchsorted(row, np.arange(hi - lo + 1)), col.astype(np.int32))
                yield pa.RecordBatch.from_arrays([cols, pa.array(target)], ["cols", "target"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        target = np.concatenate([b.column("target").to_numpy() for b in got]) if got else np.zeros(0)
        sizes = np.concatenate([np.diff(b.column("cols").offsets.to_numpy()) for b in got]) if got else np.zeros(0, int)
        col = np.concatenate([b.column("cols").flatten().to_numpy() for b in got]).astype(np.int64) if got else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(target)), sizes)
        kept, w, b = np.zeros(0, np.int64), np.zeros(0), 0.0
        if len(target):
            kept = X.select(row, col, target, 4_000, BITS)
            at = np.searchsorted(kept, col)
            at[at == len(kept)] = 0
            hit = kept[at] == col if len(kept) else np.zeros(len(col), bool)
            w, _, b = X.logistic(row[hit], at[hit], np.zeros((len(target), 0)), target, len(kept), l2=0.3, rate=0.2)
        yield pa.RecordBatch.from_arrays([pa.array([kept], pa.list_(pa.int64())), pa.array([w], pa.list_(pa.float64())), pa.array([b], pa.float64())], ["kept", "w", "b"])

    got = sample.select("text").mapInArrow(features_of, "cols array<int>, target double").repartition(1).mapInArrow(fit, "kept array<long>, w array<double>, b double").first()
    return np.array(got["kept"], np.int64), np.array(got["w"]), got["b"]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, votes (good, bad or abstain by labeller:
    ``1 0 -``), posterior (of the label model), score (of the scorer), keep.

    All labellers abstain on texts of fewer than five words, null and empty
    ones included: their posterior is the prior, and they are kept.  Repeated
    rows are each scored; other columns are not read; an empty table gives no rows.
    """
    codes, n = pattern_counts(docs, text_col)
    post, _, prior = label_model(_decoded(codes), n) if len(codes) else (np.zeros(0), None, 0.5)
    kept, weights, b = train_scorer(docs, codes, post, int(n.sum()), id_col, text_col)
    silent = int(_coded(np.full((1, len(LABELLERS)), -1))[0])
    names = ["doc_id", "votes", "posterior", "score", "keep"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for lo, hi in slices(rb.column(1)):
                texts = rb.column(1).slice(lo, hi - lo)
                w = words(texts)
                v = votes(texts, w)
                code = _coded(v)
                row, col = encode(texts, w)
                at = np.searchsorted(kept, col)
                at[at == len(kept)] = 0
                hit = kept[at] == col if len(kept) else np.zeros(len(col), bool)
                s = X.sigmoid(np.bincount(row[hit], weights=weights[at[hit]], minlength=hi - lo) + b)
                s[code == silent] = prior
                yield pa.RecordBatch.from_arrays([
                    rb.column(0).slice(lo, hi - lo), pa.array(["".join("01-"[x] for x in r) for r in v.tolist()]),
                    pa.array(post[np.searchsorted(codes, code)]), pa.array(s), pa.array((s >= KEEP) | (code == silent))], names)

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, votes string, posterior double, score double, keep boolean")


def op6_quality(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
