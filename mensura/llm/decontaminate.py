"""Benchmark decontamination: prefix-filtered set join on word windows.

A window is ``size`` consecutive words of an item; an item of fewer words, but
not none, is one window.  Exact containment of a window asks for all of its
words, so its necessary prefix is one word: the rarest of the window by
document frequency over the whole corpus.  Documents send only occurrences of
such words, each with the words around it; the join is on the word, the
positional bounds drop windows that would reach over the text's ends, and the
whole window is then compared word for word.

Native: DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sha_hex, staged

#: Separators of words: ASCII but for digits and letters (capitals are folded
#: after the split, which leaves the word boundaries as they are).
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bits of a word filter for each word, and at most.  A plan carries half a
#: megabyte of them, whatever the number of words; up to 65,000 words one in a
#: thousand others passes, beyond it ever more do.
WORD_BITS, MOST_BITS = 64, 1 << 22


def raw_words(text: Column) -> Column:
    """Words as they stand, capitals kept."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def fold(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def item_windows(benchmark: DataFrame, size: int, item_col: str, text_col: str) -> DataFrame:
    """(item_id, words): every window of every item, words folded."""
    items = (benchmark.select(F.col(item_col).cast("string").alias("item_id"), raw_words(fold(F.col(text_col))).alias("all"))
             .where(F.size("all") > 0))
    last = F.greatest(F.lit(0), F.size("all") - size)
    return (items.select("item_id", "all", F.explode(F.sequence(F.lit(0), last)).alias("at"))
            .select("item_id", F.slice("all", F.col("at") + 1, F.lit(size)).alias("words")).distinct())


class WordFilter:
    """A test of raw words that every word of a column passes, and few others
    do: two bits a word, by the hash of its small letters.  (Words equal after
    folding A-Z are equal in small letters.)  Exact joins follow it."""

    def __init__(self, df: DataFrame, col: str):
        own = df.select(F.xxhash64(F.lower(F.col(col))).alias("h")).distinct()
        self.bits = min(MOST_BITS, max(64, 1 << (WORD_BITS * own.count()).bit_length()))
        set_ = own.select(F.explode(F.array(*self._places(F.col("h")))).alias("b")).select(
            F.shiftright("b", 6).alias("at"), F.expr("shiftleft(1L, b & 63)").alias("mark"))
        marks = [0] * (self.bits // 64)
        for r in set_.groupBy("at").agg(F.bit_or("mark").alias("marks")).collect():
            marks[r["at"]] = r["marks"]
        self.marks = F.split(F.lit(",".join(map(str, marks))), ",").cast("array<bigint>")

    def _places(self, h: Column) -> list[Column]:
        low = F.lit(self.bits - 1)
        return [h.bitwiseAND(low).cast("int"), F.shiftright(h, 32).bitwiseAND(low).cast("int")]

    def __call__(self, word: Column) -> Column:
        first, second = self._places(F.xxhash64(F.lower(word)))

        def marked(bit: Column) -> Column:
            return F.call_function("getbit", F.get(self.marks, F.shiftright(bit, 6)), bit.bitwiseAND(F.lit(63))) == 1

        return marked(first) & marked(second)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20,
                  id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items (sorted array
    of item ids as strings), contaminated (n_hit > 0 and share * n_hit >= n_words),
    and the text's two hashes (h1, h2), which tell rows of one id apart.

    Null and empty texts have no words and are never contaminated; items
    without words have no window; items with a null id are one item, a null
    among the items.  Repeated rows each get a row; rows that
    share an id are judged by their own texts.  Other columns of either table
    are not read, whatever their names.  Empty tables give no rows or no hits.
    """
    reach = size - 1
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    windows = staged(item_windows(benchmark, size, item_col, item_text_col), "op5-windows")

    # Document frequency of the benchmark's words, over the whole corpus.
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    known = WordFilter(vocabulary, "word")
    seen = base.select(F.explode(F.array_distinct(F.transform(
        F.filter(raw_words(F.col("text")), known), F.lower))).alias("low"))
    df = seen.groupBy("low").agg(F.count("*").alias("df"))

    # The necessary prefix of each window: its rarest word, and its place.
    placed = windows.select("item_id", "words", F.posexplode("words").alias("at", "word"))
    ranked = (placed.join(df, F.lower("word") == F.col("low"), "left")
              .groupBy("item_id", "words")
              .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "word", "at")).alias("p")))
    prefixes = staged(ranked.groupBy("words", F.col("p.word").alias("word"), F.col("p.at").alias("at"), F.size("words").alias("n"))
                      .agg(F.sort_array(F.collect_set(F.struct("item_id"))).alias("items")), "op5-prefixes")

    # Occurrences of prefix words, each with the words around it.
    rare = WordFilter(prefixes, "word")
    held = (base.select("doc_id", "text", raw_words(F.col("text")).alias("words"))
            .select("doc_id", "words", F.size("words").alias("n_words"),
                    F.xxhash64("text").alias("h1"), F.hash("text").alias("h2")))

    def context(at: Column) -> Column:
        lo = F.greatest(F.lit(0), at - reach)
        return F.struct(at.alias("at"), lo.alias("lo"), F.element_at("words", at + 1).alias("raw"),
                        F.slice("words", lo + 1, at + F.lit(reach + 1) - lo).alias("around"))

    everywhere = F.when(F.col("n_words") > 0, F.sequence(F.lit(0), F.col("n_words") - 1)).otherwise(F.array().cast("array<int>"))
    wanted = F.filter(everywhere, lambda i: rare(F.get("words", i)))
    found = staged(held.select("doc_id", "h1", "h2", "n_words", F.transform(wanted, context).alias("found")), "op5-found")

    occurrences = (found.select("doc_id", "h1", "h2", "n_words", F.explode("found").alias("o"))
                   .select("doc_id", "h1", "h2", "n_words", "o.at", "o.lo", fold(F.col("o.raw")).alias("word"), "o.around"))
    p = prefixes.select(F.col("word").alias("p_word"), F.col("at").alias("p_at"), "n", F.col("words").alias("p_words"), "items")
    start = F.col("at") - F.col("p_at")
    hits = (occurrences.join(p, (F.col("word") == F.col("p_word")) & (start >= 0) & (start + F.col("n") <= F.col("n_words")))
            .where(fold(F.array_join(F.slice("around", F.greatest(F.lit(1), start - F.col("lo") + 1), F.col("n")), " ")) == F.array_join("p_words", " "))
            .select("doc_id", "h1", "h2", start.alias("start"), (start + F.col("n")).alias("stop"), "items"))
    hits = staged(hits, "op5-hits")

    key = ["doc_id", "h1", "h2"]
    # Words covered: each window adds what reaches beyond all windows before it.
    spans = hits.groupBy(*key, "start").agg(F.max("stop").alias("stop"))
    before = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("stop").over(before), F.lit(0))
    covered = (spans.withColumn("new", F.greatest(F.lit(0), F.col("stop") - F.greatest("start", reached)))
               .groupBy(*key).agg(F.sum("new").alias("n_hit")))
    items = (hits.select(*key, F.explode("items").alias("item")).groupBy(*key)
             .agg(F.transform(F.sort_array(F.collect_set("item")), lambda x: x["item_id"]).alias("items")))
    totals = covered.join(items, [covered[k].eqNullSafe(items[k]) for k in key]).select(
        *[covered[k].alias(f"t_{k}") for k in key], "n_hit", "items")
    out = found.join(totals, [found[k].eqNullSafe(F.col(f"t_{k}")) for k in key], "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
                      F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"), found["h1"], found["h2"])


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      sha_hex(F.array_join("items", ",")).alias("items_sha256"), "contaminated")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
w AS (
  SELECT item_id, array_to_string(words[s:s + 12], ' ') AS win, least(len(words), 13) AS n
  FROM (SELECT item_id, words, unnest(range(1, greatest(1, len(words) - 12) + 1)) AS s FROM b WHERE len(words) > 0)),
lens AS (SELECT DISTINCT n FROM w),
dw AS (
  SELECT doc_id, s, n, array_to_string(words[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM d, lens WHERE len(words) >= n)),
hit AS (SELECT DISTINCT dw.doc_id, dw.s, dw.n, w.item_id FROM dw JOIN w ON dw.win = w.win AND dw.n = w.n),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS l
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.words) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
