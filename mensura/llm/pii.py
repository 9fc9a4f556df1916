"""Personal data by weak supervision.

Base kinds (email, ip, card, phone) are exact patterns and always stay.
Further candidates (secret, number, name) are judged: seven labelers - two on
the span's form, one on gazetteers, three on its context, one on its length -
vote for, against or abstain on every candidate and base match of the corpus;
expectation-maximisation over the counts of vote patterns estimates each
labeler's reliability and each pattern's posterior; and a logistic span
classifier over votes, shape and what follows, trained on those posteriors,
decides.  Base matches are true by definition and anchor the classes; a
labeler is presumed better than chance until the corpus shows how much, so the
classes cannot trade places on a small corpus.

The driver sees only counts by pattern, whose number is bounded by the kinds,
votes and shape buckets, not by the corpus.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .features import sigmoid
from .words import buffers, slices

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "number", "name")

# The base patterns.  A lookbehind only skips starts inside a
# run of digits whose first digit already failed, so the matches are the same.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Candidates of the added kinds, and what the labelers look for.
TOKEN = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{10,}")
NUMBER = re.compile(r"(?<![0-9])[0-9](?:[\x20().-]{0,2}[0-9]){8,14}(?![0-9])")
GIVEN = ("James John Robert Michael William David Richard Joseph Thomas Charles Mary Patricia Jennifer Linda "
         "Elizabeth Barbara Susan Jessica Sarah Karen Daniel Matthew Anthony Paul Steven Andrew Laura Emily Anna "
         "Maria Peter Hans Klaus Jürgen Heike Sabine Monika Pierre Jean Michel Claire Sophie Nathalie José Juan "
         "Carlos Luis Carmen Ana Lucía Pilar").split()
FORMS = {"secret": re.compile(r"AKIA[A-Z0-9]{16}|[0-9a-f]{16,}|(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9]).{20,}"),
         "number": re.compile(r"(?:[0-9][\x20.-])?\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}"),
         "name": re.compile(r"[^\W\d_]+ [^\W\d_]+")}
CUES = {"secret": re.compile(r"(?:password|passwd|pwd|token|secret|api[_ -]?key|access[_ -]?key|passwort|clave|contraseña|mot de passe)\W*$", re.I),
        "number": re.compile(r"(?:phone|tel|call|mobile|fax|telefon|teléfono|téléphone|ssn|account|iban|passport)\W*$", re.I),
        "name": re.compile(r"(?:name is|mr|mrs|ms|dr|herr|frau|señora?|madame|monsieur|dear|contact|regards)\W*$", re.I)}
AGAINST = re.compile(r"(?:https?:\S*|www\.\S*|isbn|version|issue|no\.|[/#§$€])\s?$", re.I)
#: Before a person's name there is no article.
ARTICLE = re.compile(r"(?<!\w)(?:the|an?|this|der|die|das|ein|eine|el|la|los|las|un|una|le|les|une)\s$", re.I)
LABELERS = ("form", "dense", "gazetteer", "cue", "lead", "against", "long")
#: Candidates' worth of prior belief in each labeler, and in what.
PRIOR_ROWS, PRIOR_VOTES = 8.0, np.array([[0.4, 0.4, 0.2], [0.2, 0.4, 0.4]])


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of ``LOCAL+ @ DOMAIN``: the local part is the whole run
    of its characters before an @, back to the match before."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > done and text[lo - 1] in LOCAL:
            lo -= 1
        m = DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            out.append((lo, m.end()))
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start, then kind."""
    out = [(s, e, "email") for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0]) if len(m[0]) < 40 else ""
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def added_candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Candidates of the added kinds that touch no base span and not each other."""
    found = []
    for m in TOKEN.finditer(text):
        digits = sum(c.isdigit() for c in m[0])
        if digits >= 2 and len(m[0]) - digits >= 2:
            found.append((m.start(), m.end(), "secret"))
    found += [(m.start(), m.end(), "number") for m in NUMBER.finditer(text)]
    found += [(m.start(), m.end(), "name") for m in NAME.finditer(text)]
    out, taken = [], sorted((s, e) for s, e, _ in base)
    ends = np.maximum.accumulate([e for _, e in taken]) if taken else np.zeros(0, int)
    starts = [s for s, _ in taken]
    last = 0
    for s, e, kind in sorted(found, key=lambda x: (x[0], KINDS.index(x[2]))):
        k = int(np.searchsorted(starts, e)) - 1  # base spans that start before e
        if s >= last and not (k >= 0 and ends[k] > s):
            out.append((s, e, kind))
            last = e
    return out


NAME = re.compile(r"(?<!\w)(?:" + "|".join(GIVEN) + r") [A-ZÀ-Þ][^\W\d_]+")


def votes(text: str, s: int, e: int, kind: str) -> tuple[int, ...]:
    """+1 for, -1 against, 0 abstains; one entry per labeler."""
    span, before = text[s:e], text[max(0, s - 24):s]
    digits = sum(c.isdigit() for c in span)
    given, _, family = span.partition(" ")
    if kind in BASE:
        form, dense = 1, 1
    elif kind == "name":
        form, dense = 1 if family[1:].islower() and len(family) > 2 else -1, 0
    else:
        form = 1 if FORMS[kind].fullmatch(span) else -1
        dense = {"secret": 1 if digits >= 4 and len(set(span)) >= 8 else -1, "number": 1 if digits < e - s else -1}[kind]
    gazetteer = 0 if kind != "name" else -1 if family in KNOWN else 1
    cues = CUES.get(kind if kind not in ("card", "phone") else "number")
    cue = 1 if cues and cues.search(before) else 0
    if kind == "name":
        lead = -1 if before[-1:].isalnum() else 1 if before.rstrip()[-1:] in _INTRODUCES else 0
        against = -1 if ARTICLE.search(before) or AGAINST.search(before) else 0
    else:
        lead = 1 if before[-1:] and before[-1] in "=:\"'" else 0 if before.endswith(" ") else -1
        against = -1 if AGAINST.search(before) else 0
    long = {"secret": 1 if e - s >= 16 else -1, "number": 1 if 10 <= digits <= 12 else -1, "name": 0}.get(kind, 1)
    return form, dense, gazetteer, cue, lead, against, long


KNOWN = frozenset(GIVEN)
#: Marks that often stand before a name (the empty string: it opens the text).
_INTRODUCES = frozenset(["", *",:;.!?-–—\"'“”„«»‘’("])


def after(text: str, e: int) -> int:
    """Class of the character behind a span."""
    c = text[e:e + 1]
    return 0 if not c else 1 if c.isspace() else 2 if c in "\"'”’»)]}" else 3 if c in ".,;:!?" else 4


def pattern(text: str, s: int, e: int, kind: str) -> str:
    """Kind, votes and shape buckets of a span: what the classifier sees."""
    span = text[s:e]
    n = e - s
    shape = (min(n // 8, 5), 4 * sum(c.isdigit() for c in span) // n, 4 * sum(c.isupper() for c in span) // n, after(text, e))
    return ",".join(map(str, (KINDS.index(kind), *votes(text, s, e, kind), *shape)))


def rows_worth_reading(texts: pa.Array) -> np.ndarray:
    """Rows with a digit, an @, or a given name before a blank and a capital:
    every candidate and base match holds one of these."""
    raw, off = buffers(texts)
    mark = np.zeros(256, dtype=bool)
    mark[48:58] = mark[64] = True
    rows = np.searchsorted(off, np.flatnonzero(mark[raw]), side="right") - 1
    named = pc.fill_null(pc.match_substring_regex(texts, "(?:" + "|".join(GIVEN) + ") [A-ZÀ-Þ]"), False)
    return np.union1d(rows, np.flatnonzero(named.to_numpy(zero_copy_only=False)))


def pattern_counts(docs: DataFrame, text_col: str = "text") -> dict[str, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            seen: Counter[str] = Counter()
            for lo, hi in slices(rb.column(0)):
                texts = rb.column(0).slice(lo, hi - lo)
                for text in texts.take(pa.array(rows_worth_reading(texts))).to_pylist():
                    base = base_spans(text)
                    seen.update(pattern(text, *x) for x in [*base, *added_candidates(text, base)])
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["pattern", "n"])

    got = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, "pattern string, n long")
    return {r["pattern"]: r["n"] for r in got.groupBy("pattern").agg(F.sum("n").alias("n")).collect()}


def label_model(patterns: np.ndarray, n: np.ndarray, steps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of each pattern, table[labeler, class, vote]) by EM.

    Votes are independent given the class; classes have a prior per kind.
    Patterns of base kinds are true throughout.  Tables start from and keep a
    prior by which a labeler is right more often than wrong, and are held to
    it: a vote for is at least as likely in the true class, a vote against in
    the false one.
    """
    k = len(LABELERS)
    kind, vote = patterns[:, 0], patterns[:, 1:1 + k] + 1
    known = kind < len(BASE)
    post = np.where(known, 1.0, np.clip(0.5 + patterns[:, 1:1 + k].mean(1), 0.05, 0.95))
    table_ = np.zeros((k, 2, 3))
    for _ in range(steps):
        # Base matches show how the true class is voted on, but no better than
        # as many candidates: they are not what is to be decided.
        share = np.where(known, min(1.0, PRIOR_ROWS / max(1.0, n[known].sum())), 1.0) * n
        weight = np.stack([share * (1 - post), share * post])
        for j in range(k):
            for y in (0, 1):
                t = np.bincount(vote[:, j], weights=weight[y], minlength=3) + PRIOR_ROWS * PRIOR_VOTES[y]
                table_[j, y] = t / t.sum()
            for v, y in ((2, 1), (0, 0)):
                if table_[j, y, v] < table_[j, 1 - y, v]:
                    table_[j, :, v] = table_[j, :, v].mean()
            table_[j] /= table_[j].sum(1, keepdims=True)
        prior = (np.bincount(kind, weights=n * post, minlength=len(KINDS)) + 1) / (np.bincount(kind, weights=n, minlength=len(KINDS)) + 2)
        odds = np.log(prior[kind] / (1 - prior[kind]))
        for j in range(k):
            odds = odds + np.log(table_[j, 1, vote[:, j]] / table_[j, 0, vote[:, j]])
        new = np.where(known, 1.0, sigmoid(odds))
        done = np.abs(new - post).max() < 1e-6
        post = new
        if done:
            break
    return post, table_


def design(patterns: np.ndarray) -> np.ndarray:
    """One-hot votes, kinds, shape buckets and what follows."""
    k = 1 + len(LABELERS)
    cols = [np.eye(len(KINDS))[patterns[:, 0]]]
    cols += [np.eye(3)[patterns[:, j] + 1] for j in range(1, k)]
    cols += [np.eye(6)[patterns[:, k]], *[np.eye(5)[patterns[:, k + j]] for j in (1, 2, 3)]]
    return np.concatenate(cols, 1)


def train(docs: DataFrame, text_col: str = "text", steps: int = 500) -> np.ndarray:
    """Weights of the span classifier (the last is the intercept), fitted on
    the posteriors of all candidates of the corpus."""
    counts = pattern_counts(docs, text_col)
    if not counts:
        return np.zeros(design(np.zeros((1, len(LABELERS) + 5), int)).shape[1] + 1)
    patterns = np.array([list(map(int, p.split(","))) for p in sorted(counts)])
    n = np.array([counts[p] for p in sorted(counts)], dtype=float)
    post, _ = label_model(patterns, n)
    x = np.hstack([design(patterns), np.ones((len(n), 1))])
    w, scale = np.zeros(x.shape[1]), n / n.sum()
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = (x * ((sigmoid((x * w).sum(1)) - post) * scale)[:, None]).sum(0) + 1e-5 * w
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        w = w - 0.1 * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.999 ** t)) + 1e-9)
    return w


def all_spans(text: str, weights: np.ndarray) -> tuple[list, list]:
    """(base spans, all spans) of a text, by start, then kind."""
    base = base_spans(text)
    more = added_candidates(text, base)
    if more:
        seen = np.array([list(map(int, pattern(text, *x).split(","))) for x in more])
        p = sigmoid((design(seen) * weights[:-1]).sum(1) + weights[-1])
        more = [x for x, ok in zip(more, p >= 0.5) if ok]
    return base, sorted([*base, *more], key=lambda x: (x[0], KINDS.index(x[2])))


def _written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Spans replaced by their kind in brackets; overlapping ones become one."""
    out, at = [], 0
    for s, e, k in spans:
        if s >= at:
            out += (text[at:s], f"[{k.upper()}]")
        at = max(at, e)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, weights: np.ndarray, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, n_email, n_ip, n_card, n_phone, base_sha256,
    spans (``kind:start:end`` in code points, end exclusive, by start, then
    kind, comma-joined) and redacted_text (null where the text was null).

    A null or empty text has no spans; repeated rows are each searched.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = hashlib.sha256(b"").hexdigest()
        for rb in batches:
            for lo, hi in slices(rb.column(0)):
                texts = rb.column(0).slice(lo, hi - lo)
                filled = texts.fill_null("")
                n = np.zeros((hi - lo, 4), np.int64)
                sha, spans, new = [empty] * (hi - lo), [""] * (hi - lo), texts.to_pylist()
                for i in rows_worth_reading(filled).tolist():
                    base, every = all_spans(new[i] or "", weights)
                    if every:
                        for _, _, k in base:
                            n[i, KINDS.index(k)] += 1
                        sha[i] = hashlib.sha256(_written(base).encode()).hexdigest()
                        spans[i], new[i] = _written(every), redacted(new[i], every)
                yield pa.RecordBatch.from_arrays([*[c.slice(lo, hi - lo) for c in rb.columns[1:]], *[pa.array(n[:, j]) for j in range(4)],
                                                  pa.array(sha), pa.array(spans), pa.array(new, pa.string())], names)

    held = docs.select(*keep)
    added = [("n_email", "long"), ("n_ip", "long"), ("n_card", "long"), ("n_phone", "long"), ("base_sha256", "string"), ("spans", "string"), ("redacted_text", "string")]
    names = [*held.columns, *[a for a, _ in added]]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema] + [f"{a} {t}" for a, t in added])
    return docs.select(F.col(text_col).alias("_text"), *keep).mapInArrow(run, schema)


def op2_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find(docs, train(docs)).drop("redacted_text")
