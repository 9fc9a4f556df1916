"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text recognises every stretch
that occurs in it.  A text is parsed against each automaton into phrases, each
the longest match from where the one before ended; few long phrases mean that
the text is written like the training text.  The cost of a text in a language
is its number of phrases times log2 of that language's training length, per
symbol (the cross-parsing estimate of relative entropy); the cheapest wins.

Symbols are lower-case letters, with one blank for each run of anything else.
A parse is cut every ``BLOCK`` symbols, so that the blocks of a whole batch
step through the automata side by side; a phrase never crosses a cut, in any
language alike.

The training text of a language is ``EXCERPTS`` stretches of ``EXCERPT``
characters, each from another labelled text and at a place in it chosen by a
hash: a bounded sample, so that the automata fit in every task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Training text of a language: so many stretches of so many characters.
EXCERPTS, EXCERPT = 160, 256
#: Symbols parsed without a cut.
BLOCK = 256
#: Letters of one alphabet; rarer letters of the training texts share a symbol.
LETTERS = 250
FOLDS = 5
SLICE = 1 << 20
BLANK, OTHER, FIRST = 0, 1, 2
UNDECIDED = "und"


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of each state of the minimal automaton of all substrings;
    state 0 is the start.  (Blumer et al., one symbol at a time.)"""
    step: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for c in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """Letters as numbers, one blank for each run of other characters."""
    s = table[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    if not len(s):
        return s
    keep = s != BLANK
    keep[1:] |= s[:-1] != BLANK
    return s[keep]


class Model:
    """Languages with their automata as (state, symbol, target) lists, which
    travel to the tasks; ``Parser`` makes tables of them there."""

    def __init__(self, texts: dict[str, list[str]]):
        self.languages = sorted(texts)
        pools = ["\n".join(texts[x]).lower() for x in self.languages]
        seen = Counter(c for pool in pools for c in pool if c.isalpha())
        alphabet = sorted(sorted(seen), key=lambda c: -seen[c])[:LETTERS]
        number = {c: i for i, c in enumerate(alphabet, FIRST)}
        self.width = FIRST + len(alphabet)
        #: Symbol of each code point, capitals like their small letters.
        self.symbol = np.array([number.get(c.lower()[:1], OTHER) if c.isalpha() else BLANK for c in map(chr, range(0x110000))], np.uint8)
        self.edges, self.bits = [], []
        for pool in pools:
            text = symbols(pool, self.symbol)
            step = suffix_automaton(text[text != OTHER].tolist())
            # A symbol that the language lacks is a phrase by itself: it leads
            # to a state with no way on.
            step[0] = {c: len(step) for c in range(self.width)} | step[0]
            self.edges.append((len(step) + 1, np.array([(i, c, j) for i, own in enumerate(step) for c, j in own.items()], np.int32)))
            self.bits.append(np.log2(max(2, len(text))))


class Parser:
    """The automata of all languages, in one table of transitions (-1: none)."""

    def __init__(self, model: Model):
        self.languages, self.symbol, self.width = model.languages, model.symbol, model.width
        self.bits = np.array(model.bits)
        sizes = [n for n, _ in model.edges]
        self.begin = np.cumsum([0, *sizes])[:-1]
        step = np.full((sum(sizes), self.width), -1, np.int32)
        for base, (_, e) in zip(self.begin, model.edges):
            step[e[:, 0] + base, e[:, 1]] = e[:, 2] + base
        self.step = step.ravel()

    def phrases(self, blocks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """[language, block] phrases; ``blocks`` ordered by falling size."""
        count = np.zeros((len(self.begin), len(sizes)), np.int64)
        if not len(sizes):
            return count
        state = np.repeat(self.begin[:, None], len(sizes), axis=1)
        fresh = self.begin[:, None] * self.width
        for k in range(int(sizes[0])):
            m = int(np.searchsorted(-sizes, -k, side="left"))  # blocks longer than k
            c = blocks[:m, k].astype(np.int64)
            onward = self.step[state[:, :m] * self.width + c]
            stuck = onward < 0
            again = self.step[fresh + c]
            state[:, :m] = np.where(stuck, again, onward)
            count[:, :m] += stuck
        return count + (sizes > 0)  # the phrase open at the end

    def costs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(bits a symbol [language, text], symbols [text]); a text without a
        letter has no symbols."""
        rows, parts, lengths = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            s = symbols(text or "", self.symbol)
            if not len(s) or not (s != BLANK).any():
                continue
            lengths[i] = len(s)
            n = -(-len(s) // BLOCK)
            padded = np.zeros(n * BLOCK, np.uint8)
            padded[:len(s)] = s
            parts.append(padded.reshape(n, BLOCK))
            rows.append(np.full(n, i))
        total = np.zeros((len(self.begin), len(texts)))
        if parts:
            row, blocks = np.concatenate(rows), np.concatenate(parts)
            edge = np.concatenate([row[1:] != row[:-1], [True]])
            sizes = np.where(edge & (lengths[row] % BLOCK > 0), lengths[row] % BLOCK, BLOCK)
            order = np.argsort(-sizes, kind="stable")
            for lo in range(0, len(order), SLICE // BLOCK):
                part = order[lo:lo + SLICE // BLOCK]
                n = self.phrases(blocks[part], sizes[part])
                for j in range(len(self.begin)):
                    total[j] += np.bincount(row[part], weights=n[j], minlength=len(texts))
        return total * self.bits[:, None] / np.maximum(lengths, 1), lengths

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text; equal costs go to the first name."""
        if not self.languages:
            return [UNDECIDED] * len(texts), np.zeros(len(texts))
        cost, n = self.costs(texts)
        best = cost.argmin(0)
        # Posterior of the winner when each language codes the text in its bits.
        extra = np.minimum((cost - cost.min(0)) * n, 1000.0)
        score = np.where(n > 0, 1 / np.exp2(-extra).sum(0), 0.0)
        return [self.languages[b] if k else UNDECIDED for b, k in zip(best, n)], score


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Sample each language's training text.

    Of a language's distinct texts with a letter, those with the smallest
    hashes are taken.  A share by hash lets about three times as many through,
    so that no language, however large, is gathered, and only their stretches
    go to the driver: 3 * ``EXCERPTS`` * ``EXCERPT`` characters a language.
    Rows with a null text or language teach nothing.
    """
    spare = F.char_length("text") - EXCERPT
    key = F.xxhash64("text")
    at = F.when(spare > 0, F.pmod(F.xxhash64("text", F.lit(1)), spare + 1)).otherwise(F.lit(0))
    named = (docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
             .where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")))
    total = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.approx_count_distinct(key).alias("n")).collect()}
    if not total:
        return Model({})
    # A share of the rows by hash, three times what is wanted, then the
    # smallest hashes of those: the share leaves few rows to sort.
    share = F.create_map(*[F.lit(x) for lang, n in total.items() for x in (lang, min(1.0, 3 * EXCERPTS / n))])
    near = (F.pmod(key, F.lit(1 << 30)) / float(1 << 30)) < F.element_at(share, F.col("lang"))
    picked = (named.where(near).select("lang", key.alias("key"), F.substring(F.col("text"), at.cast("int") + 1, F.lit(EXCERPT)).alias("part"))
              .groupBy("lang", "key").agg(F.min("part").alias("part")))
    texts: dict[str, list] = {}
    for r in picked.collect():
        texts.setdefault(r["lang"], []).append((r["key"], r["part"]))
    return Model({x: [p for _, p in sorted(texts.get(x, []))[:EXCERPTS]] for x in total})


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = (), text_col: str = "text") -> DataFrame:
    """``keep`` columns, lang_pred and score of every row.

    The whole text is parsed.  Null texts and texts without a letter are
    ``und`` with score 0, as is every text where no language was learned.
    Letters that no training text has are phrases by themselves; equal costs
    go to the smallest name.  The score is the winner's posterior when each
    language codes the text in its own number of bits.
    """
    fields = [docs.schema[c] for c in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["lang_pred string, score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(model)
        for rb in batches:
            texts = rb.column(len(fields))
            size = np.cumsum(np.concatenate([[0], pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)]))
            lang, score, lo = [], [], 0
            while lo < len(texts):  # slices of bounded length, or one text
                hi = max(lo + 1, int(np.searchsorted(size, size[lo] + SLICE, side="right")) - 1)
                a, b = parser.predict(texts.slice(lo, hi - lo).to_pylist())
                lang += a
                score.append(b)
                lo = hi
            yield pa.RecordBatch.from_arrays(
                [rb.column(i) for i in range(len(fields))] + [pa.array(lang, pa.string()), pa.array(np.concatenate(score) if score else np.zeros(0))],
                [f.name for f in fields] + ["lang_pred", "score"])

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Rows that training never reads; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def op11_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    return predict(docs.withColumn("held_out", held_out()), model, ("doc_id", "held_out"))
