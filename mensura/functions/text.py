"""Text scalars (Column -> Column), all JVM-side built-ins.

O1 clean_text, O2 normalize_match, O3 canonical_label, O10 measure/plain
text, O25 safe_filename, F4/F5 label and format predicates.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# --- fixed values ---------------------------------------------------------
# Invisible characters deleted by clean_text (zero-width space, zero-width
# non-joiner, zero-width joiner, byte-order mark, no-break space).  NBSP is
# deleted, not turned into a space.
INVISIBLE_CHARS = "[\\u200b\\u200c\\u200d\\ufeff\\u00a0]"
# Upper-cased tokens that mean "no value" (source B set; source A adds "-").
NULL_TOKENS = ("", "NULL", "NONE", "NAN", "N/A", "NA")
NULL_TOKENS_WITH_DASH = NULL_TOKENS + ("-",)
# Accented capitals folded by canonical_label (other accents survive).
LABEL_ACCENTS_FROM = "ÁÉÍÓÚÜÑ"
LABEL_ACCENTS_TO = "AEIOUUN"
# Country aliases folded by canonical_label.
COUNTRY_ALIASES = {"EEUU": "ESTADOS UNIDOS", "USA": "ESTADOS UNIDOS", "US": "ESTADOS UNIDOS"}
# Labels that are not analytic destinations (totals, rests, world).
NON_ANALYTIC_LABELS = r"^(TOTAL\b.*|SUBTOTAL\b.*|OTROS\b.*|RESTO\b.*|MUNDO|GLOBAL)$"
# Characters replaced by "_" in file names.
UNSAFE_FILENAME_CHARS = '[<>:"/\\\\|?*\\x00-\\x1f]'
# --------------------------------------------------------------------------


def bind(expr: Column, fn) -> Column:
    """Evaluate ``expr`` once per row and apply ``fn`` to it.

    A CASE whose condition and value both contain an expensive expression
    (two regex passes over a whole document) would evaluate it twice; binding
    it to a lambda variable evaluates it once, still JVM-side.
    """
    return F.element_at(F.transform(F.array(expr), fn), 1)


def clean_text(c, null_tokens=NULL_TOKENS) -> Column:
    """O1: delete invisible chars, collapse whitespace, trim, null tokens -> NULL."""
    s = F.regexp_replace(as_col(c), INVISIBLE_CHARS, "")
    s = F.trim(F.regexp_replace(s, r"\s+", " "))
    tokens = list(null_tokens)
    return bind(s, lambda x: F.when(F.upper(x).isin(tokens), F.lit(None).cast("string")).otherwise(x))


def _ranges(points: list[int]) -> str:
    """Regular-expression class of sorted code points."""
    runs: list[list[int]] = []
    for p in points:
        if runs and runs[-1][1] == p - 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs) + "]"


_SPACES = [cp for cp in range(0x3001) if chr(cp).isspace()]
#: White space as Unicode has it (what ``str.split`` splits at), and what is
#: left of it where compatibility forms have become plain blanks.
SPACE = _ranges(_SPACES) + "+"
PLAIN_SPACE = _ranges([cp for cp in _SPACES if unicodedata.normalize("NFKD", chr(cp)) == chr(cp)]) + "+"


class Mapping:
    """A text per code point, from a rule, as a column expression.

    Code points that map to one character or none are translated; those that
    map to several are looked up by number in a two-level table (pages of 256);
    only texts that hold one of them are taken apart.
    """

    def __init__(self, rule: Callable[[str], str]):
        single, gone, self.several = [], [], {}
        for cp in range(0x110000):
            ch = chr(cp)
            if 0xD800 <= cp < 0xE000:
                continue
            to = rule(ch)
            if to == "":
                gone.append(ch)
            elif len(to) > 1:
                self.several[cp] = to
            elif to != ch:
                single.append((ch, to))
        self.source = "".join([c for c, _ in single] + gone)
        self.target = "".join(t for _, t in single)

    def __call__(self, c) -> Column:
        c = as_col(c)
        if self.several:
            table = _two_level(self.several, "string")
            taken = F.array_join(F.transform(F.regexp_extract_all(c, F.lit("(?s)(.)"), 1), lambda ch: F.coalesce(_at(table, ch), ch)), "")
            # Deleting them tells whether there are any (a class of so many
            # ranges would be tried range by range).
            beyond = c.rlike(f"[^\\x00-\\x{{{min(self.several) - 1:x}}}]")
            held = F.translate(c, "".join(map(chr, sorted(self.several))), "") != c
            c = F.when(beyond & held, taken).otherwise(c)
        return F.translate(c, self.source, self.target)


@lru_cache(maxsize=1)
def _folding() -> Mapping:
    """Compatibility decomposition without the marks that combine (combining
    class not 0).  Marks are dropped wherever they stand, so a text folds
    character by character."""
    return Mapping(lambda ch: "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x)))


def strip_accents(c) -> Column:
    """Compatibility decomposition without combining marks; marks of class 0
    (vowel signs of Indic scripts among them) stay."""
    return _folding()(c)


def normalize_match(c, case: str | None = "upper") -> Column:
    """O2: decomposed text without combining marks, white space collapsed,
    trimmed, upper (or lower) case; None leaves the case."""
    s = F.trim(F.regexp_replace(strip_accents(c), PLAIN_SPACE, " "))
    if case is None:
        return s
    return F.upper(s) if case == "upper" else F.lower(s)


def _two_level(values: dict[int, object], kind: str) -> Column:
    """Table of values by code point, as pages of 256."""
    pages = {cp >> 8 for cp in values}
    rows = [[values.get(page << 8 | low) for low in range(256)] if page in pages else None for page in range(max(pages) + 1)]
    return F.from_json(F.lit(json.dumps(rows, ensure_ascii=False)), f"array<array<{kind}>>")


def _at(table: Column, ch: Column) -> Column:
    cp = F.ascii(ch)
    return F.get(F.get(table, F.shiftright(cp, 8)), cp.bitwiseAND(F.lit(255)))


#: Fixed values of the Hangul arithmetic: first syllable, leading consonant,
#: vowel, trailing consonant (one before the first), vowels and trailing forms.
HANGUL, LEAD, VOWEL, TRAIL, VOWELS, TRAILS = 0xAC00, 0x1100, 0x1161, 0x11A7, 21, 28
LEADS = 19


@lru_cache(maxsize=1)
def _composition() -> tuple[Mapping, dict[int, int], dict[str, str]]:
    """(compatibility decomposition but for Hangul syllables, combining
    classes, composites by their two parts)."""
    def decomposed(ch: str) -> str:
        return ch if HANGUL <= ord(ch) < HANGUL + LEADS * VOWELS * TRAILS else unicodedata.normalize("NFKD", ch)

    classes, pairs = {}, {}
    for cp in range(0x110000):
        if 0xD800 <= cp < 0xE000:
            continue
        ch = chr(cp)
        if unicodedata.combining(ch):
            classes[cp] = unicodedata.combining(ch)
        parts = unicodedata.decomposition(ch).split()
        if len(parts) == 2 and not parts[0].startswith("<") and unicodedata.normalize("NFC", ch) == ch:
            pairs["".join(chr(int(p, 16)) for p in parts)] = ch
    return Mapping(decomposed), classes, pairs


def nfkc(c) -> Column:
    """Compatibility composition (NFKC), as a column expression.

    Characters are decomposed by table, marks put in canonical order, and each
    composed with the starter before it unless a mark of its class or higher
    stands between; Hangul by arithmetic.  ASCII texts pass as they are.
    """
    mapping, classes, pairs = _composition()
    c = as_col(c)
    class_table = _two_level(classes, "int")
    composites = F.from_json(F.lit(json.dumps(pairs, ensure_ascii=False)), "map<string,string>")
    item = "struct<run:int,class:int,at:int,ch:string>"

    def listed(seen: Column, ch: Column) -> Column:
        own = F.coalesce(_at(class_table, ch), F.lit(0))
        run = seen["run"] + F.when(own == 0, 1).otherwise(0)
        entry = F.struct(run.alias("run"), own.alias("class"), F.size(seen["list"]).alias("at"), ch.alias("ch"))
        return F.struct(F.array_append(seen["list"], entry).alias("list"), run.alias("run"))

    def composed(first: Column, second: Column) -> Column:
        a, b = F.ascii(first), F.ascii(second)
        syllable = F.when(a.between(LEAD, LEAD + LEADS - 1) & b.between(VOWEL, VOWEL + VOWELS - 1), ((a - LEAD) * VOWELS + (b - VOWEL)) * TRAILS + HANGUL)
        whole = a.between(HANGUL, HANGUL + LEADS * VOWELS * TRAILS - 1) & ((a - HANGUL) % TRAILS == 0)
        syllable = F.coalesce(syllable, F.when(whole & b.between(TRAIL + 1, TRAIL + TRAILS - 1), a + b - TRAIL))
        # Hangul lies in three UTF-8 bytes
        byte = [F.lit(0xE0) + F.shiftright(syllable, 12), F.lit(0x80) + F.shiftright(syllable, 6).bitwiseAND(F.lit(63)), F.lit(0x80) + syllable.bitwiseAND(F.lit(63))]
        made = F.decode(F.unhex(F.concat(*[F.hex(x) for x in byte])), "UTF-8")
        return F.coalesce(made, F.element_at(composites, F.concat(first, second)))

    def step(s: Column, x: Column) -> Column:
        free = (s["starter"] != "") & ((s["rest"] == "") | (s["last"] < x["class"]))
        one = F.when(free, composed(s["starter"], x["ch"]))
        fresh = one.isNull() & (x["class"] == 0)
        return F.struct(
            F.when(fresh, F.concat(s["done"], s["starter"], s["rest"])).otherwise(s["done"]).alias("done"),
            F.when(fresh, x["ch"]).otherwise(F.coalesce(one, s["starter"])).alias("starter"),
            F.when(fresh, F.lit("")).when(one.isNull(), F.concat(s["rest"], x["ch"])).otherwise(s["rest"]).alias("rest"),
            F.when(fresh, F.lit(0)).when(one.isNull(), x["class"]).otherwise(s["last"]).alias("last"))

    start = F.struct(F.array().cast(f"array<{item}>").alias("list"), F.lit(0).alias("run"))
    none = F.struct(F.lit("").alias("done"), F.lit("").alias("starter"), F.lit("").alias("rest"), F.lit(0).alias("last"))
    chars = F.regexp_extract_all(mapping(c), F.lit("(?s)(.)"), 1)
    ordered = F.array_sort(F.aggregate(chars, start, listed, lambda s: s["list"]))
    full = F.aggregate(ordered, none, step, lambda s: F.concat(s["done"], s["starter"], s["rest"]))
    return F.when(c.rlike(r"[^\x00-\x7f]"), full).otherwise(c)


def canonical_label(c, aliases=None, null_tokens=NULL_TOKENS_WITH_DASH) -> Column:
    """O3: clean, upper, fold Spanish capitals, then alias map."""
    aliases = COUNTRY_ALIASES if aliases is None else aliases
    s = F.translate(F.upper(clean_text(c, null_tokens)), LABEL_ACCENTS_FROM, LABEL_ACCENTS_TO)
    if not aliases:
        return s
    m = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return F.coalesce(F.element_at(m, s), s) if aliases else s


def measure_text(c) -> Column:
    """Trimmed string form of a measure cell."""
    return F.trim(as_col(c).cast("string"))


def plain_text(c) -> Column:
    """Untrimmed string form."""
    return as_col(c).cast("string")


def is_non_analytic(c, pattern: str = NON_ANALYTIC_LABELS) -> Column:
    """F4 predicate: blank label or a total/rest/world label."""
    s = as_col(c)
    return s.isNull() | (F.trim(s) == "") | s.rlike(pattern)


def digits(c, n: int) -> Column:
    """exactly ``n`` ASCII digits."""
    return as_col(c).rlike(f"^[0-9]{{{n}}}$")


def contains_token(c, token: str) -> Column:
    """upper-cased text contains ``token``."""
    return F.upper(as_col(c)).contains(token.upper())


def safe_filename(c, default: str = "archivo_descargado") -> Column:
    """Safe file name of a URL.

    The query and fragment are cut off the raw URL (an encoded ``%3F`` is part
    of the name), the path is percent-decoded (a ``+`` stays a ``+``) and its
    last segment kept and composed (NFKC); ``<>:"/\\|?*`` and control
    characters become ``_``, white space is collapsed, blanks and dots are
    stripped at both ends, and an empty name gives ``default``.
    """
    s = F.regexp_replace(as_col(c), r"(?s)[?#].*$", "")
    s = F.try_url_decode(F.replace(s, F.lit("+"), F.lit("%2B")))
    s = bind(F.regexp_extract(s, r"([^/]*)$", 1), nfkc)
    s = F.regexp_replace(s, UNSAFE_FILENAME_CHARS, "_")
    s = F.regexp_replace(s, SPACE, " ")
    s = F.regexp_replace(s, r"^[ .]+|[ .]+$", "")
    return F.when(s.isNull() | (s == ""), F.lit(default)).otherwise(s)
