"""Hashed text features and small linear models (numpy) for the classifiers.

Features of a text: presence of each word, of the first four and five bytes of
each word (stems that take endings), and of each pair of adjacent words, all
hashed into ``2 ** bits`` columns.  A selection on labelled rows keeps the
columns whose log-likelihood ratio with the label is largest, so that long
clean texts do not add up noise from many slight weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .words import U64, Words, mix, words

BITS = 20


def columns(w: Words, bits: int = BITS, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of every feature occurrence, with repeats."""
    h = w.hashes()
    parts, rows = [h], [w.row]
    for n in (4, 5):
        parts.append(w.prefixes(n) + U64(n))
        rows.append(w.row)
    if pairs and len(h) > 1:
        near = w.row[1:] == w.row[:-1]
        parts.append(mix(h[:-1] * U64(3) + h[1:])[near])
        rows.append(w.row[1:][near])
    col = (np.concatenate(parts) >> U64(64 - bits)).astype(np.int64)
    return np.concatenate(rows), col


def present(row: np.ndarray, col: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, column) pairs, ordered."""
    key = np.unique(row.astype(np.int64) * width + col)
    return key // width, key % width


def of_texts(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    row, col = columns(words(texts), bits)
    return present(row, col, 1 << bits)


def best_columns(positive: np.ndarray, count: np.ndarray, n_positive: float, n: float, keep: int) -> np.ndarray:
    """Columns with the largest log-likelihood ratio (G2) with the label, given
    in how many positive rows, and in how many rows, each is present."""
    seen = np.flatnonzero(count >= 2)
    if not len(seen) or n_positive <= 0 or n_positive >= n:
        return np.zeros(0, np.int64)
    a, here = positive[seen].astype(float), count[seen].astype(float)
    g = np.zeros(len(seen))
    for x, total, part in ((a, n_positive, here), (here - a, n - n_positive, here), (n_positive - a, n_positive, n - here), (n - n_positive - here + a, n - n_positive, n - here)):
        e = part * total / n
        g += np.where(x > 0, x * np.log(np.maximum(x, 1e-12) / np.maximum(e, 1e-12)), 0)
    best = np.argsort(-g, kind="stable")[:keep]
    return np.sort(seen[best][g[best] > 4])


def select(row: np.ndarray, col: np.ndarray, label: np.ndarray, keep: int, bits: int = BITS) -> np.ndarray:
    width = 1 << bits
    return best_columns(np.bincount(col, weights=label[row], minlength=width), np.bincount(col, minlength=width), float(label.sum()), float(len(label)), keep)


def logistic(row: np.ndarray, col: np.ndarray, extra: np.ndarray, label: np.ndarray, width: int,
             l2: float = 1.0, steps: int = 300, rate: float = 0.5) -> tuple[np.ndarray, np.ndarray, float]:
    """(weights of the sparse columns, weights of ``extra``, intercept): L2
    logistic regression by full-batch Adam; the label may be a probability."""
    n, k = len(label), extra.shape[1]
    w, b = np.zeros(width + k), float(np.log((label.mean() + 1e-3) / (1 - label.mean() + 1e-3)))
    m1, m2, b1, b2 = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=w[col], minlength=n) + (extra * w[width:]).sum(1) + b
        err = sigmoid(z) - label
        g = np.concatenate([np.bincount(col, weights=err[row], minlength=width), (extra * err[:, None]).sum(0)]) / n + l2 * w / n
        gb = err.mean()
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        b1, b2 = 0.9 * b1 + 0.1 * gb, 0.999 * b2 + 0.001 * gb * gb
        fix1, fix2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        step = rate * (1 - 0.9 * t / steps)
        w -= step * (m1 / fix1) / (np.sqrt(m2 / fix2) + 1e-8)
        b -= step * (b1 / fix1) / (np.sqrt(b2 / fix2) + 1e-8)
    return w[:width], w[width:], float(b)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fold_of(ids: np.ndarray, folds: int) -> np.ndarray:
    """Fold of each training row, by a hash of its text's key."""
    return (mix(ids.astype(np.uint64)) % U64(folds)).astype(np.int64)


def to_array(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
