"""Importance resampling of a corpus towards a target distribution.

Words come from an untrained pre-tokeniser: a Regex Split over ASCII-lowered
text, which returns each word with its offsets.  A feature is a window over
the offset pairs - one to ``longest`` consecutive words, joined by one space -
and falls into a bucket by the CRC of its UTF-8 bytes.  Corpus and target each
give a histogram of buckets; a bucket's gain is the logarithm of how much more
common it is in the target, a document's weight the mean of its features'
gains.  Weights plus Gumbel noise from a hash of the id are drawn without
replacement by taking the highest.

Texts are split once: the buckets of each document are written to the shared
folder, histograms and weights read them there.  The draw needs no total sort
of the corpus: counts by score give the lowest score that can be drawn, and
only the rows above it are put in order, over as many tasks as the session
shuffles with.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, table

#: Words: maximal runs of digits, ASCII letters and non-ASCII characters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A separator of words, where a very long text may be cut.
BREAK = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
FOLD = {c: c + 32 for c in range(65, 91)}
#: Characters handed to the pre-tokeniser at a time (a longer word stays whole).
PIECE = 1 << 18
BUCKETS = 10_000
LEAST_WORDS, PERCENT, SEED = 20, 10, 2024


def splitter():
    """The pre-tokeniser; ``invert`` makes what the pattern matches the words."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), "removed", invert=True)


def split_words(text: str, split) -> Iterator[list[tuple[str, tuple[int, int]]]]:
    """Words of a text with their offsets in it, piece by piece."""
    lo = 0
    while lo < len(text):
        cut = BREAK.search(text, lo + PIECE) if lo + PIECE < len(text) else None
        hi = cut.start() if cut else len(text)
        piece = text[lo:hi].translate(FOLD)
        yield [(w, (a + lo, b + lo)) for w, (a, b) in split.pre_tokenize_str(piece)] if lo else split.pre_tokenize_str(piece)
        lo = hi


def feature_counts(text: str, split, shortest: int, longest: int) -> tuple[int, Counter]:
    """(words, features with their counts) of a text: all windows of
    ``shortest`` to ``longest`` offset pairs.  Windows run on across pieces."""
    n, counts, tail = 0, Counter(), []
    for piece in split_words(text, split):
        n += len(piece)
        run = tail + [w for w, _ in piece]
        for k in range(shortest, longest + 1):
            if k == 1:
                counts.update(w for w, _ in piece)
            else:
                # Windows wholly inside the tail were counted with the piece before.
                first = max(0, len(tail) - k + 1)
                counts.update(" ".join(run[i:i + k]) for i in range(first, len(run) - k + 1))
        tail = run[max(0, len(run) - longest + 1):] if longest > 1 else []
    return n, counts


def bucketed(df: DataFrame, text_col: str, keep: tuple[str, ...] = (), shortest: int = 1, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``keep`` columns, n_words, n_features, and the features' buckets with
    their counts (parallel arrays, by bucket)."""
    fields = [df.schema[c] for c in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["n_words long, n_features long, bucket array<int>, times array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter()
        for rb in batches:
            words, features, ends, cols, times = [], [], [0], [], []
            for text in rb.column(len(fields)):
                n, counts = feature_counts(text.as_py() or "", split, shortest, longest)
                col = np.fromiter((zlib.crc32(f.encode("utf-8", "surrogatepass")) % buckets for f in counts), np.int64, len(counts))
                sums = np.bincount(col, weights=np.fromiter(counts.values(), np.float64, len(counts)), minlength=1) if len(col) else np.zeros(0)
                own = np.flatnonzero(sums)
                words.append(n)
                features.append(int(sums.sum()))
                ends.append(ends[-1] + len(own))
                cols.append(own.astype(np.int32))
                times.append(sums[own].astype(np.int32))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x) if x else [], pa.int32())) for x in (cols, times)]
            yield pa.RecordBatch.from_arrays(
                [rb.column(i) for i in range(len(fields))] + [pa.array(words, pa.int64()), pa.array(features, pa.int64()), *lists],
                [f.name for f in fields] + ["n_words", "n_features", "bucket", "times"])

    return df.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def histogram(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Feature counts by bucket over all rows; ``buckets`` numbers at most."""
    pairs = features.select(F.explode(F.arrays_zip("bucket", "times")).alias("p"))
    out = np.zeros(buckets, np.int64)
    for r in pairs.groupBy("p.bucket").agg(F.sum(F.col("p.times").cast("long")).alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed frequencies, floored."""
    s_all, t_all, n = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weighed(features: DataFrame, gain: np.ndarray, id_col: str, seed: int) -> DataFrame:
    """Adds weight (floored mean gain) and score (weight plus Gumbel noise)."""
    fields = [features.schema[c] for c in (id_col, "n_words", "n_features")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", weight long, score long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            n = rb.column(2).to_numpy()
            col, times = rb.column(3).flatten().to_numpy(), rb.column(4).flatten().to_numpy()
            sums = np.concatenate([[0], np.cumsum(gain[col] * times)]).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(rb.column(3).value_lengths().to_numpy())]).astype(np.int64)
            total = sums[ends[1:]] - sums[ends[:-1]]
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            noise = [math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) for h in rb.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), rb.column(2), pa.array(weight, pa.int64()), pa.array(weight + np.array(noise, np.int64), pa.int64())],
                [f.name for f in fields] + ["weight", "score"])

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return features.select(id_col, "n_words", "n_features", "bucket", "times", h.alias("_h")).mapInArrow(run, schema)


def lowest_drawn(scores: DataFrame, percent: int) -> tuple[int, int | None]:
    """(documents to draw, lowest score among them), from counts by score.
    Scores are whole thousandths of log ratios: some 100,000 values at most."""
    got = scores.groupBy("score").agg(F.count("*").alias("n")).orderBy(F.desc("score")).collect()
    draw, passed = percent * sum(r["n"] for r in got) // 100, 0
    for r in got:
        passed += r["n"]
        if passed >= draw > 0:
            return draw, r["score"]
    return draw, None


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``: 1, 2, 3... in the given order.  Ranges of rows are sorted
    apart and written; a range's rows count on from those before it.  Rows
    that the order leaves equal follow their place in ``df``."""
    spark = df.sparkSession
    keys = [*order, F.col("_row")]
    own = (df.withColumn("_row", F.monotonically_increasing_id())
           .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
           .sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()))
    own = staged(own.drop("_row"), "op13-ordered")
    part = F.shiftright("_at", 33)
    before, rows = 0, []
    for r in own.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("_at").alias("first")).orderBy("part").collect():
        rows.append((r["part"], r["first"] - before - 1))
        before += r["n"]
    shift = spark.createDataFrame(rows, "_part long, _shift long")
    return own.join(shift, part == F.col("_part")).withColumn(name, F.col("_at") - F.col("_shift")).drop("_at", "_part", "_shift")


def resample(docs: DataFrame, target: DataFrame, shortest: int = 1, longest: int = 1, buckets: int = BUCKETS,
             least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
             id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_features, weight, score, and rank
    among the drawn (null where not drawn).

    Of the documents with ``least_words`` words or more, ``percent`` in a
    hundred (rounded down) are drawn.  Null and empty texts have no words, no
    features and weight 0; a null id hashes as an empty one and comes first
    among equal scores.  Repeated rows each get a row and each can be drawn.
    Other columns of either table are not read, whatever their names.  An
    empty target counts no features; an empty corpus gives no rows.
    """
    how = {"shortest": shortest, "longest": longest, "buckets": buckets}
    features = staged(bucketed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", ("doc_id",), **how), "op13-buckets")
    gain = gains(histogram(features, buckets), histogram(bucketed(target, target_text_col, **how), buckets))
    scored = staged(weighed(features, gain, "doc_id", seed), "op13-scores")
    enough = F.col("n_words") >= least_words
    draw, lowest = lowest_drawn(scored.where(enough), percent)
    none = F.lit(None).cast("long")
    if lowest is None:
        return scored.withColumn("rank", none)
    near = enough & (F.col("score") >= lowest)
    order = numbered(scored.where(near), [F.desc("score"), F.asc_nulls_first("doc_id")], "rank")
    return (order.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
            .unionByName(scored.where(~near).withColumn("rank", none)))


def op13_resample(spark, sf_dir: str) -> DataFrame:
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


OP13_SQL = r"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS tab
  FROM (SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) t(i))),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
dw AS (SELECT doc_id, unnest(words) AS w FROM d),
bw AS (SELECT unnest(words) AS w FROM b),
vocabulary AS (
  SELECT w, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(w)), '..'), lambda h: CAST('0x' || h AS BIGINT)),
                            lambda c, x: xor(c >> 8, tab[xor(c, x) % 256 + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN vocabulary USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN vocabulary USING (w) GROUP BY 1),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT count(*) FROM dw) + 10000) AS DOUBLE)
                                      / CAST((s + 1) * ((SELECT count(*) FROM bw) + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT doc_id, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
      FROM dw JOIN vocabulary USING (w) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || d.doc_id)[1:8] AS BIGINT) + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (doc_id)),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_words >= 20
  QUALIFY rank <= 10 * (SELECT count(*) FROM scored WHERE n_words >= 20) // 100)
SELECT doc_id, n_words AS n_features, weight, score, CAST(rank AS BIGINT) AS rank, n_words
FROM scored LEFT JOIN drawn USING (doc_id)
"""
