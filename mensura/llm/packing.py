"""Sequence packing by cutting-stock column generation.

A document's ids are cut into pieces of one whole sequence and a rest.  The
rests form a histogram over length classes (``unit`` ids wide), the only thing
the driver sees: at most ``capacity / unit`` numbers, whatever the corpus.
Over it a linear program in patterns (how many pieces of each class share a
sequence) is solved by column generation: the simplex method keeps one basic
pattern per class, and a knapsack dynamic program over the dual prices finds
the next pattern, until none prices below zero.  Patterns are rounded down,
what remains is placed first-fit decreasing, and the pieces, ranked within
their class in Spark, take the slots.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, table
from .words import slices

CAPACITY, UNIT, END_ID = 2048, 8, 1
#: Entries of a task's cache of encoded words; it starts anew when full.
CACHE = 300_000


def byte_values() -> dict[str, int]:
    """Byte-level files name byte b by chr(b) where that prints, and the other
    bytes, in order, by the characters from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts under a byte-level BPE file of ``tokenizers``.

    The file's vocabulary (its ids follow the order of its merges) is given to
    ``tiktoken``, which yields the same ids and is faster on single words.  The
    split pattern always cuts before a blank between two other characters, so
    such chunks are encoded alone; they repeat, and a bounded cache holds
    their ids as little-endian 32-bit bytes.  The file's added tokens are cut
    out first, longest first, and stand for their ids, as in ``tokenizers``.
    """

    #: The split pattern of such files (a fixed value of the format).
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = {t["content"]: array("I", [t["id"]]).tobytes() for t in spec.get("added_tokens", ())}
        if any(t.get(flag) for t in spec.get("added_tokens", ()) for flag in ("lstrip", "rstrip", "single_word")):
            raise ValueError("added tokens that depend on what stands beside them are not supported")
        self.cuts = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        byte = byte_values()
        ranks = {bytes(byte[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in self.added}
        self.own = tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, bytes | None] = {}

    def encode(self, text: str) -> bytes:
        return array("I", self.own.encode_ordinary(text)).tobytes()

    def _known(self, unit: str) -> bytes | None:
        """Ids of a blank and ``unit``; None where they can't be cut off."""
        try:
            return self.cache[unit]
        except KeyError:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            whole = unit and not unit[0].isspace() and not unit[-1].isspace()
            self.cache[unit] = got = self.encode(" " + unit) if whole else None
            return got

    def __call__(self, text: str) -> bytes:
        if self.cuts is None or not self.cuts.search(text):
            return self._plain(text)
        return b"".join(self.added.get(part) or self._plain(part) for part in self.cuts.split(text) if part)

    def _plain(self, text: str) -> bytes:
        units = text.split(" ")
        out, chunk, known = [], units[0], self._known
        for unit in units[1:]:
            ids = known(unit)
            if ids is not None and chunk is None:
                out.append(ids)
            elif ids is not None and chunk and not chunk[-1].isspace():
                out += (self.encode(chunk), ids)
                chunk = None
            else:  # blanks meet other white space: no cut here
                if chunk is None:
                    chunk = ""
                chunk += " " + unit
        if chunk is not None:
            out.append(self.encode(chunk))
        return b"".join(out)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Cut every document's ids (then ``end_id``) into whole sequences and a rest."""
    id_type = docs.schema[id_col].dataType
    schema = f"doc_id {id_type.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for rb in batches:
            ids, texts = rb.column(0), rb.column(1).fill_null("")
            for lo, hi in slices(texts):
                at, rest = [], []
                for i, text in enumerate(texts.slice(lo, hi - lo).to_pylist()):
                    got = encoder(text) + end
                    n = len(got) // 4
                    for start in range(0, n, capacity):
                        piece = got[4 * start:4 * (start + capacity)]
                        at.append(lo + i)
                        rest.append((start, len(piece) // 4, zlib.crc32(piece), n, piece)[:4 + with_ids])
                cols = [pa.array(c, pa.binary() if k == 4 else pa.int64()) for k, c in enumerate(zip(*rest))]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), *cols], names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


# --- the linear program -----------------------------------------------------

def _knapsack(size: np.ndarray, worth: np.ndarray, room: int) -> np.ndarray:
    """How many of each class the most valuable sequence holds."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    order = np.argsort(size, kind="stable")
    s, v = size[order], worth[order]
    upto = np.searchsorted(s, np.arange(room + 1), side="right")
    for w in range(1, room + 1):
        best[w] = best[w - 1]
        if k := upto[w]:
            got = v[:k] + best[w - s[:k]]
            j = int(got.argmax())
            if got[j] > best[w] + 1e-12:
                best[w], pick[w] = got[j], order[j]
    out, w = np.zeros(len(size), dtype=np.int64), room
    while w > 0:
        if pick[w] < 0:
            w -= 1
        else:
            out[pick[w]] += 1
            w -= size[pick[w]]
    return out


def starting_basis(size: np.ndarray, demand: np.ndarray, room: int) -> np.ndarray:
    """First-fit decreasing in fractions: every pattern is used until a class
    is exhausted, and is that class's basic column.  Classes exhausted in
    passing get a pattern of their own at level zero."""
    basis = np.diag(room // size).astype(float)
    left = demand.astype(float)
    while (left > 0).any():
        pattern, space = np.zeros(len(size)), room
        for c in np.flatnonzero(left > 0)[::-1]:  # classes are sorted by size
            pattern[c] = min(np.ceil(left[c]), space // size[c])
            space -= int(pattern[c]) * int(size[c])
        held = np.flatnonzero(pattern)
        ratio = left[held] / pattern[held]
        r = held[ratio.argmin()]
        left = left - ratio.min() * pattern
        left[(left < 1e-9) & (pattern > 0)] = 0
        left[r] = 0
        basis[:, r] = pattern
    return basis


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row vector by matrix or matrix by column vector, by plain sums: the
    sizes are small, and no library threads start in the driver."""
    return (a[:, None] * b).sum(0) if a.ndim == 1 else (a * b).sum(1)


def inverse_of(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with the largest pivot of a column."""
    m = len(matrix)
    work = np.hstack([matrix.astype(float), np.eye(m)])
    for c in range(m):
        r = c + int(np.abs(work[c:, c]).argmax())
        work[[c, r]] = work[[r, c]]
        work[c] /= work[c, c]
        rows = np.flatnonzero(work[:, c])
        rows = rows[rows != c]
        work[rows] -= work[rows, c][:, None] * work[c]
    return work[:, m:]


def column_generation(size: np.ndarray, demand: np.ndarray, room: int, gap: float = 0.001,
                      most: int = 2_000) -> tuple[np.ndarray, np.ndarray]:
    """Basic patterns (rows) and their fractional uses: minimise the number of
    sequences such that every class gets at least its demand.

    Ends when the objective is proved within ``gap`` of the optimum, by the
    room that all pieces take or the dual bound (objective over the best
    pattern's worth), or after ``most`` columns: the patterns then still hold
    every piece.
    """
    m = len(size)
    basis = starting_basis(size, demand, room)  # a column for each basic variable
    cost = np.ones(m)
    inverse = inverse_of(basis)
    x = times(inverse, demand)
    bound = float((size * demand).sum()) / room
    for step in range(most):
        price = times(cost, inverse)
        if price.min() < -1e-9:  # a surplus of that class is worth having
            c = int(price.argmin())
            column, c_cost = np.zeros(m), 0.0
            column[c] = -1
        else:
            column, c_cost = _knapsack(size, price, room).astype(float), 1.0
            worth = float((price * column).sum())
            value = float((cost * x).sum())
            bound = max(bound, value / max(1.0, worth))
            if value - bound <= gap * value or worth <= 1 + 1e-9:
                break
        u = times(inverse, column)
        ratio = np.where(u > 1e-9, np.maximum(x, 0) / np.where(u > 1e-9, u, 1), np.inf)
        r = int(ratio.argmin())
        if not np.isfinite(ratio[r]):
            break
        inverse[r] /= u[r]
        others = np.arange(m) != r
        inverse[others] -= np.outer(u[others], inverse[r])
        basis[:, r], cost[r] = column, c_cost
        if step % 50 == 49:
            inverse = inverse_of(basis)
        x = times(inverse, demand)
    used = (cost > 0) & (x > 1e-9)
    return basis.T[used].round().astype(np.int64), x[used]


def first_fit_decreasing(size: np.ndarray, left: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Patterns for the pieces that rounding left over: (pattern, uses).

    Fills one sequence at a time, largest class first, and repeats the pattern
    as often as the classes allow.
    """
    left, out = left.copy(), []
    order = np.argsort(-size, kind="stable")
    while left.any():
        pattern, space = np.zeros(len(size), dtype=np.int64), room
        for c in order:
            if k := min(int(left[c]), space // int(size[c])):
                pattern[c], space = k, space - k * int(size[c])
        uses = int((left[pattern > 0] // pattern[pattern > 0]).min())
        out.append((pattern, uses))
        left -= uses * pattern
    return out


def plan(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """[(pieces by class, uses)] that hold every piece of the histogram."""
    if not histogram:
        return []
    size = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[s] for s in size], dtype=np.int64)
    patterns, uses = column_generation(size, demand.astype(float), room)
    out, left = [], demand.copy()
    for pattern, use in sorted(zip(patterns.tolist(), uses.tolist()), key=lambda p: -p[1]):
        pattern = np.array(pattern)
        held = pattern > 0
        use = min(int(use + 1e-6), int((left[held] // pattern[held]).min()))
        if use > 0:
            out.append((pattern, use))
            left -= use * pattern
    out += first_fit_decreasing(size, left, room)
    return [({int(s): int(k) for s, k in zip(size, p) if k}, u) for p, u in out]


# --- assignment ---------------------------------------------------------------

def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, unit: int = UNIT, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (gapless from 0 in its sequence) and, with ``with_ids``,
    the piece's ids as little-endian 32-bit ``ids``.

    A null or empty text is one piece, the end id.  Repeated rows are packed
    each on its own.  Further columns are not read.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = staged(pieces(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids), "op8-pieces")
    full = capacity // unit + 1
    small = cut.drop("ids").withColumn("kind", F.when(F.col("length") == capacity, full).otherwise(F.ceil(F.col("length") / unit)).cast("int"))
    counts = {r["kind"]: r["n"] for r in small.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    layout = plan({k: n for k, n in counts.items() if k != full}, capacity // unit)

    # Rank within a class without one task per class: count by (class, salt),
    # add up the counts of the salts before, and number the rows of a salt.
    salts = max(64, sum(counts.values()) // 1_000_000)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    dealt = small.withColumn("salt", F.pmod(F.xxhash64(*key), F.lit(salts)))
    by_salt = dealt.groupBy("kind", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("kind").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_salt.select("kind", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (dealt.withColumn("nth", F.row_number().over(Window.partitionBy("kind", "salt").orderBy(*key)) - 1)
              .join(offsets, ["kind", "salt"]).withColumn("rank", F.col("base") + F.col("nth")))

    slots: dict[int, list[tuple[int, int, int]]] = {}  # class -> (first rank, first sequence, pieces a sequence)
    taken: dict[int, int] = {}
    sequences = counts.get(full, 0)
    for pattern, uses in layout:
        for c, k in pattern.items():
            slots.setdefault(c, []).append((taken.get(c, 0), sequences, k))
            taken[c] = taken.get(c, 0) + k * uses
        sequences += uses
    tables = {c: tuple(np.array(x, dtype=np.int64) for x in zip(*rows)) for c, rows in slots.items()}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rank, kind = pdf["rank"].to_numpy(), pdf["kind"].to_numpy()
            to = rank.copy()  # a whole sequence has its own
            for c in np.unique(kind):
                if c in tables:
                    first, sequence, each = tables[c]
                    at = np.flatnonzero(kind == c)
                    j = np.searchsorted(first, rank[at], side="right") - 1
                    to[at] = sequence[j] + (rank[at] - first[j]) // each[j]
            yield pdf[[*key, "kind", "rank"]].assign(sequence_id=to)

    id_type = docs.schema[id_col].dataType.simpleString()
    placed = ranked.select(*key, "kind", "rank").mapInPandas(
        place, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, kind int, rank long, sequence_id long")
    ahead = Window.partitionBy("sequence_id").orderBy(F.desc("kind"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)).cast("long")).select(*key, "sequence_id", "offset")
    if with_ids:
        # Repeated rows have equal ids, so one copy of each piece is enough.
        held = cut.select(*[F.col(k).alias(f"i_{k}") for k in key], "ids").dropDuplicates([f"i_{k}" for k in key])
        out = out.join(held, [out[k].eqNullSafe(held[f"i_{k}"]) for k in key]).select(*key, "sequence_id", "offset", "ids")
    return out


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_pack(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
