"""Toxicity by a classifier chain.

Categories are predicted in a fixed order, each by a logistic model over
hashed features plus the probabilities of the categories before it.  While
training, those probabilities are out-of-fold predictions, so a later model
sees them as good as they will be on new text; for scoring, models fitted on
all training rows feed each other.

The only given label is ``toxic``.  The earlier categories of the chain split
it by the kind of abuse: a toxic text that names a person (``insult``) or
holds a thing or person in contempt (``contempt``); the last link is ``toxic``
itself, which also learns the abuse that the seed words do not name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features as X
from .common import sampled, staged, table
from .words import slices, words

#: Seed words of the first categories (fixed values).
SEEDS = {
    "insult": ("idiot", "moron", "loser", "clown", "stupid"),
    "contempt": ("scum", "trash", "worthless", "pathetic", "disgusting"),
}
CHAIN = ("insult", "contempt", "toxic")

#: Labelled rows used for training, about (a share of the labels, chosen by
#: hash): models of this size stop improving well before.
TRAINING_ROWS = 12_000
FOLDS, KEEP = 5, 1_500


@dataclass
class Link:
    """One model of the chain."""

    kept: np.ndarray  # hashed columns, sorted
    weights: np.ndarray
    earlier: np.ndarray  # weights of the logits of earlier categories
    intercept: float

    def score(self, row: np.ndarray, col: np.ndarray, before: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.kept, col)
        at[at == len(self.kept)] = 0
        hit = self.kept[at] == col if len(self.kept) else np.zeros(len(col), bool)
        z = np.bincount(row[hit], weights=self.weights[at[hit]], minlength=len(before))
        return X.sigmoid(z + (before * self.earlier).sum(1) + self.intercept)


def fit_chain(row: np.ndarray, col: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> tuple[list[Link], np.ndarray]:
    """(links fitted on all rows, out-of-fold probabilities by category).

    Columns are chosen for each fit from its own training rows: counts by fold
    are added up without the fold that is left out.
    """
    n, k = labels.shape
    total = np.bincount(col, minlength=1 << X.BITS)
    seen = np.flatnonzero(total >= 3)
    index = np.full(1 << X.BITS, -1, dtype=np.int32)
    index[seen] = np.arange(len(seen), dtype=np.int32)
    col = index[col]
    row, col = row[col >= 0].astype(np.int32), col[col >= 0]
    of = fold[row].astype(np.int8)
    width = len(seen)
    count = np.stack([np.bincount(col[of == f], minlength=width) for f in range(FOLDS)])
    outside = np.zeros((n, k))
    links = []
    for c in range(k):
        y, before = labels[:, c].astype(float), outside[:, :c].copy()
        own = y[row] > 0
        positive = np.stack([np.bincount(col[own & (of == f)], minlength=width) for f in range(FOLDS)])
        for left_out in (*range(FOLDS), None):
            use = [f for f in range(FOLDS) if f != left_out]
            train = np.isin(fold, use)
            kept = X.best_columns(positive[use].sum(0), count[use].sum(0), float(y[train].sum()), float(train.sum()), KEEP)
            place = np.full(width, -1, dtype=np.int32)
            place[kept] = np.arange(len(kept), dtype=np.int32)
            at = place[col]
            r, at = row[at >= 0], at[at >= 0]
            inside, number = train[r], np.cumsum(train) - 1
            if train.any():
                w, e, b = X.logistic(number[r[inside]], at[inside], before[train], y[train], len(kept), l2=0.3, steps=200, rate=0.25)
            else:
                w, e, b = np.zeros(len(kept)), np.zeros(c), -35.0
            if left_out is None:
                links.append(Link(seen[kept], w, e, b))
            else:
                p = X.sigmoid(np.bincount(r, weights=w[at], minlength=n) + (before * e).sum(1) + b)
                outside[fold == left_out, c] = p[fold == left_out]
    return links, outside


def threshold(score: np.ndarray, label: np.ndarray) -> float:
    """The cut with the best F1 on out-of-fold scores, in the middle of the
    gap to the next score below."""
    if not len(label) or not label.any():
        return 1.1
    order = np.argsort(-score, kind="stable")
    s, hits = score[order], np.cumsum(label[order])
    f1 = 2 * hits / (np.arange(1, len(s) + 1) + label.sum())
    last = np.append(s[1:] != s[:-1], True)  # equal scores fall on one side
    best = int(np.argmax(np.where(last, f1, -1)))
    return float((s[best] + (s[best + 1] if best + 1 < len(s) else 0)) / 2)


def train(labelled: DataFrame, categories: tuple[str, ...] = CHAIN, text_col: str = "text") -> tuple[list[Link], float]:
    """Chain and cut of the last category, fitted in one task on ``labelled``,
    a bounded sample (``sample_of``).  Repeated texts fall into one fold."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = labelled.select(text.alias("text"), *[F.col(c).cast("int").alias(c) for c in categories]).where(
        " AND ".join(f"`{c}` IS NOT NULL" for c in categories))
    sample = rows.withColumn("key", F.xxhash64("text"))
    names = ["key", "cols", *categories]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            texts = rb.column("text")
            for lo, hi in slices(texts):
                row, col = X.of_texts(texts.slice(lo, hi - lo))
                cols = X.to_array(np.searchsorted(row, np.arange(hi - lo + 1)), col.astype(np.int32))
                yield pa.RecordBatch.from_arrays([rb.column("key").slice(lo, hi - lo), cols,
                                                  *[rb.column(c).slice(lo, hi - lo) for c in categories]], names)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        got = list(batches)
        key = np.concatenate([b.column("key").to_numpy() for b in got]) if got else np.zeros(0, np.int64)
        labels = np.stack([np.concatenate([b.column(c).to_numpy() for b in got]) if got else np.zeros(0) for c in categories], 1)
        sizes = np.concatenate([np.diff(b.column("cols").offsets.to_numpy()) for b in got]) if got else np.zeros(0, int)
        col = np.concatenate([b.column("cols").flatten().to_numpy() for b in got]).astype(np.int64) if got else np.zeros(0, np.int64)
        links, outside = fit_chain(np.repeat(np.arange(len(key)), sizes), col, labels, X.fold_of(key, FOLDS))
        cut = threshold(outside[:, -1], labels[:, -1])
        yield pa.RecordBatch.from_pandas(pd.DataFrame({
            "kept": [x.kept for x in links], "weights": [x.weights for x in links],
            "earlier": [x.earlier for x in links], "intercept": [x.intercept for x in links], "cut": cut}))

    # One task fits: its rows are the bounded sample.
    models = (sample.mapInArrow(encode, "key long, cols array<int>, " + ", ".join(f"`{c}` int" for c in categories))
              .repartition(1).mapInArrow(fit, "kept array<long>, weights array<double>, earlier array<double>, intercept double, cut double"))
    got = models.collect()
    links = [Link(np.array(r.kept, np.int64), np.array(r.weights), np.array(r.earlier), r.intercept) for r in got]
    return links, got[0].cut


def score(docs: DataFrame, links: list[Link], cut: float, categories: tuple[str, ...] = CHAIN,
          text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``p_<category>`` for each category and ``rejected``.

    A null or empty text has no features: its scores are the intercepts', and
    it is never rejected.  Every row is scored by itself, repeats alike.
    """
    every = np.unique(np.concatenate([x.kept for x in links])) if links else np.zeros(0, np.int64)
    table_of = np.zeros(1 << X.BITS, dtype=bool)
    table_of[every] = True
    packed = np.packbits(table_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(packed).astype(bool)
        for rb in batches:
            texts = rb.column(0)
            for lo, hi in slices(texts):
                part = words(texts.slice(lo, hi - lo))
                row, col = X.columns(part)
                use = wanted[col]
                row, col = X.present(row[use], col[use], 1 << X.BITS)
                p = np.zeros((hi - lo, len(links)))
                for c, link in enumerate(links):
                    p[:, c] = link.score(row, col, p[:, :c])
                bad = (p[:, -1] >= cut) & (np.diff(part.first) > 0)
                yield pa.RecordBatch.from_arrays([*[c.slice(lo, hi - lo) for c in rb.columns[1:]],
                                                  *[pa.array(p[:, c]) for c in range(len(links))], pa.array(bad)], names)

    held = docs.select(*[F.col(c) for c in keep])
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema],
                        *[f"`p_{c}` double" for c in categories], "rejected boolean"])
    names = [*held.columns, *[f"p_{c}" for c in categories], "rejected"]
    return docs.select(F.col(text_col).alias("_text"), *keep).mapInArrow(run, schema)


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts with the chain's labels; the seeds divide ``toxic`` into kinds.

    Rows without a label (null) are left out.  A document labelled twice
    counts twice.
    """
    d = docs.select("doc_id", "text")
    y = labels.select(F.col("doc_id").alias("l_doc_id"), F.col("toxic")).where("toxic IS NOT NULL")
    low = F.lower(F.coalesce("text", F.lit("")))
    kinds = [((F.col("toxic") == 1) & F.rlike(low, F.lit(r"\b(" + "|".join(seeds) + r")\b"))).cast("int").alias(c) for c, seeds in SEEDS.items()]
    return y.join(d, d.doc_id == y.l_doc_id).select("text", *kinds, "toxic")


def toxic_scores(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    links, cut = train(staged(sample_of(docs, labels), "op3-labelled"))
    return score(docs, links, cut, keep=keep)


def sample_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labels used for training, with their texts: labels are first cut to
    about ``TRAINING_ROWS``, so that only their texts are joined."""
    usable = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "toxic")
    return labelled_rows(docs, F.broadcast(sampled(usable, ["doc_id", "toxic"], TRAINING_ROWS, usable.count())))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxic_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
