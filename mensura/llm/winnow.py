"""Document fingerprints by winnowing.

Every run of ``k`` words has a hash; of every ``w`` consecutive hashes the
smallest is selected, the rightmost of equals, and kept with its position.
Two texts that share ``w + k - 1`` words in a row therefore share a selected
hash, and no hash outside a shared run of ``k`` words is ever needed to match.
A text of fewer words is one run; one of fewer runs is one window.  In scripts
without blanks every character counts as a word.

Native: DataFrame expressions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sha_hex, staged, table

K, W = 4, 4
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Scripts that are written without blanks (South-East Asian, kana, Han): each
#: of their characters is a word.
UNSPACED = r"[\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"
#: Ids in a bucket when documents are put in order: neighbours are found
#: within a bucket, and only its two ends look further.
NEAR_IDS = 1024
#: Bucket heads (two longs each) that are broadcast; more of them are shuffled.
BROADCAST_ROWS = 1_000_000
#: A selected run is packed as hash (high bits) and place counted from the
#: right (low bits), so that the smallest is the rightmost of equal hashes.
_PLACE = 2**30 - 1


def spaced(text: Column) -> Column:
    """Blanks around the characters that are words by themselves."""
    return F.when(F.rlike(text, F.lit(UNSPACED)), F.regexp_replace(text, f"({UNSPACED})", " $1 ")).otherwise(text)


def fingerprint(df: DataFrame, text: str, name: str, k: int = K, w: int = W) -> DataFrame:
    """Add ``name``: array of (at, hash), the selected runs by position (the
    number of the run's first word).  Null and empty texts have none."""
    words, grams, packed = f"_{name}_words", f"_{name}_grams", f"_{name}_packed"
    keep = df.columns
    df = df.select(*keep, F.transform(F.array_remove(F.split(spaced(F.lower(F.coalesce(F.col(text), F.lit("")))), SEPARATORS), ""), lambda x: F.xxhash64(x)).alias(words))

    def run(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + j) for j in range(k)])

    def places(n: Column) -> Column:
        return F.sequence(F.lit(0), n - 1)

    n = F.size(words)
    df = df.select(*keep, F.when(n >= k, F.transform(places(n - (k - 1)), run)).when(n > 0, F.array(F.xxhash64(words)))
                   .otherwise(F.array().cast("array<bigint>")).alias(grams))
    df = df.select("*", F.transform(grams, lambda g, i: g.bitwiseAND(F.lit(-_PLACE - 1)).bitwiseOR((F.lit(_PLACE) - i).cast("long"))).alias(packed))
    m = F.size(packed)
    chosen = (F.when(m >= w, F.array_distinct(F.transform(places(m - (w - 1)), lambda i: F.least(*[F.get(packed, i + j) for j in range(w)]))))
              .when(m > 0, F.array(F.array_min(packed))).otherwise(F.array().cast("array<bigint>")))
    df = df.select(*keep, grams, chosen.alias(packed))

    def selected(p: Column) -> Column:
        at = F.lit(_PLACE) - p.bitwiseAND(F.lit(_PLACE)).cast("int")
        return F.struct(at.alias("at"), F.get(grams, at).alias("hash"))

    return df.select(*keep, F.transform(packed, selected).alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the selected hashes; 1 if neither has any."""
    x, y = F.array_distinct(a["hash"]), F.array_distinct(b["hash"])
    both = F.size(F.array_intersect(x, y))
    every = F.size(x) + F.size(y) - both
    return F.when(every == 0, 1.0).otherwise(both / every).cast("double")


def written(f: Column) -> Column:
    return F.array_join(F.transform(f, lambda x: F.concat(x["at"].cast("string"), F.lit(":"), F.hex(x["hash"]))), " ")


def with_next(docs: DataFrame, enrich: Callable[[DataFrame], DataFrame], payload: list[str]) -> DataFrame:
    """``enrich(docs)`` with ``next``: the payload of the next row by
    descending doc_id; after the last row comes the first.

    ``docs`` has doc_id and text.  Rows that share an id follow each other in
    the order of their texts' hash; a row without an id has no next.  Rows are
    windowed by buckets of ids; a bucket's last row takes the first row of the
    next bucket down, which is found over the buckets' highest ids alone.
    """
    bucket = F.floor(F.col("doc_id") / NEAR_IDS)
    named = docs.where("doc_id IS NOT NULL")
    tops = staged(named.groupBy(bucket.alias("_bucket")).agg(F.max("doc_id").alias("_top")), "op10-buckets")
    # The next bucket down: ranges of buckets are sorted apart, and the last of
    # a range goes on to the first of the next; after the lowest the highest.
    spark = docs.sparkSession
    down = F.desc("_bucket")
    sorted_ = staged(tops.select("_bucket").repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), down)
                     .sortWithinPartitions(down).withColumn("_at", F.monotonically_increasing_id()), "op10-order")
    part = F.shiftright("_at", 33)
    first = [(r["p"], r["b"]) for r in sorted_.groupBy(part.alias("p")).agg(F.max("_bucket").alias("b")).orderBy("p").collect()]
    jumps = spark.createDataFrame([(p, first[(i + 1) % len(first)][1]) for i, (p, _) in enumerate(first)], "_p long, _jump long")
    inside = sorted_.select(F.col("_bucket").alias("_from"), part.alias("_part"), F.lead("_bucket").over(Window.partitionBy(part).orderBy("_at")).alias("_in"))
    steps = inside.join(jumps, F.col("_part") == F.col("_p")).select("_from", F.coalesce("_in", "_jump").alias("_to"))

    # First row of each bucket; its ids are broadcast while they are few.
    ids = tops.select(F.col("_bucket").alias("_b"), "_top")
    ids = F.broadcast(ids) if tops.count() <= BROADCAST_ROWS else ids
    firsts = (named.join(ids, F.col("doc_id") == F.col("_top")).groupBy("_b")
              .agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.min("doc_id").alias("doc_id")))
    pay = F.struct(*payload)
    heads = enrich(firsts).select("_b", pay.alias("_head"))
    ends = steps.join(heads, F.col("_to") == F.col("_b")).select("_from", "_head")

    within = Window.partitionBy("_bucket").orderBy(F.desc("doc_id"), F.xxhash64("text"))
    # Texts are dealt out before they are enriched, so that only they travel.
    rows = enrich(named.withColumn("_bucket", bucket).repartition("_bucket"))
    held = [c for c in rows.columns if c != "_bucket"]
    rows = rows.select("*", F.lead(pay).over(within).alias("_near"))
    out = (rows.join(ends, (F.col("_bucket") == F.col("_from")) & F.col("_near").isNull(), "left")
           .select(*held, F.coalesce("_near", "_head").alias("next")))
    nameless = enrich(docs.where("doc_id IS NULL")).select(*held, F.lit(None).cast(out.schema["next"].dataType).alias("next"))
    return out.unionByName(nameless)


def op10_fingerprints(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, lambda d: fingerprint(d, "text", "own"), ["text", "own"])
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    rows = rows.select(
        "doc_id", n.cast("long").alias("n_chars"), "own", F.coalesce("next.own", F.expr("slice(own, 1, 0)")).alias("other"),
        F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 3) as int))"),
                 F.coalesce(F.col("next.text"), F.lit("")).substr(F.lit(1), cut)).alias("edited_text"))
    rows = fingerprint(rows, "edited_text", "edited")
    return rows.select("doc_id", "n_chars", sha_hex(F.col("edited_text")).alias("edited_sha256"),
                       written(F.col("own")).alias("fingerprint"), written(F.col("edited")).alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("edited")).alias("near_edited"), likeness(F.col("own"), F.col("other")).alias("near_next"))
