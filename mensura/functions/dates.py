"""Date and period scalars (ANSI-safe).

O6 parse_date, O7 infer_month, O8 infer_year, O11 parse_period,
O13 date_key, O14 calendar attributes, O19 year_from_text,
O26 shift_months, O27 cut_date.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col
from .text import normalize_match

# --- fixed values ---------------------------------------------------------
# Month names in calendar order, upper case (file-name matching) and
# title case (calendar dimension).
MONTHS_UPPER = ("ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO", "JULIO",
                "AGOSTO", "SEPTIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE")
MONTHS_TITLE = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
                "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre")
# Accepted date formats, tried in this order.
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy")
# Period text "YYYY / MM - name".
PERIOD_PATTERN = r"^(\d{4})\s*/\s*(\d{2})\s*-\s*(.+)$"
YEAR_PATTERN = r"\b(20\d{2})\b"
# --------------------------------------------------------------------------


def parse_date(c, formats=DATE_FORMATS) -> Column:
    """First format that parses; unparseable -> NULL (never raises)."""
    s = as_col(c)
    return F.coalesce(*[F.try_to_date(s, f) for f in formats])


def infer_month(text, names=MONTHS_UPPER, normalized: bool = False) -> Column:
    """Number of the first month (calendar order) named as a whole word."""
    t = as_col(text) if normalized else normalize_match(text)
    return F.coalesce(*[F.when(t.rlike(rf"\b{n}\b"), F.lit(i)) for i, n in enumerate(names, 1)])


def first_year(c, pattern: str = YEAR_PATTERN) -> Column:
    """First 20xx year in ``c`` as INT, else NULL."""
    y = F.regexp_extract(F.coalesce(as_col(c), F.lit("")), pattern, 1)
    return F.nullif(y, F.lit("")).try_cast("int")


def infer_year(*candidates) -> Column:
    """First 20xx year from the candidates in order (name, URL, anchor)."""
    return F.coalesce(*[first_year(c) for c in candidates])


def parse_period(c) -> tuple[Column, Column, Column]:
    """``YYYY / MM - name`` -> (year INT, month INT, first-of-month DATE)."""
    s = as_col(c)
    y = F.nullif(F.regexp_extract(s, PERIOD_PATTERN, 1), F.lit("")).try_cast("int")
    m = F.nullif(F.regexp_extract(s, PERIOD_PATTERN, 2), F.lit("")).try_cast("int")
    d = F.when(m.between(1, 12), F.try_to_date(
        F.concat_ws("-", y.cast("string"), F.lpad(m.cast("string"), 2, "0"), F.lit("01")),
        "yyyy-MM-dd"))
    return y, m, d


def date_key(d) -> Column:
    """yyyyMMdd as INT."""
    d = as_col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name(month, names=MONTHS_TITLE) -> Column:
    """Month name by number; out-of-range -> NULL."""
    m = as_col(month)
    return F.when(m.between(1, len(names)), F.element_at(F.array(*[F.lit(n) for n in names]), m))


def calendar_columns(d, prefix: str = "") -> dict[str, Column]:
    """Calendar attributes of a first-of-month DATE, as a withColumns map."""
    d = as_col(d)
    m = F.month(d)
    return {
        f"{prefix}date_key": date_key(d),
        f"{prefix}year": F.year(d),
        f"{prefix}month": m,
        f"{prefix}month_name": month_name(m),
        f"{prefix}year_month": F.date_format(d, "yyyy-MM"),
        f"{prefix}quarter": F.quarter(d),
        f"{prefix}semester": F.when(m <= 6, F.lit(1)).otherwise(F.lit(2)),
    }


def year_from_text(c) -> Column:
    """First 4-digit group as INT."""
    return F.nullif(F.regexp_extract(as_col(c), r"(\d{4})", 1), F.lit("")).try_cast("int")


def shift_months(d, n: int) -> Column:
    """First-of-month keys shifted by ``n`` months (no end-of-month drift)."""
    return F.add_months(as_col(d), n)


def cut_date(year, month: int = 5) -> Column:
    """Year -> first day of the cut month."""
    return F.make_date(as_col(year), F.lit(month), F.lit(1))


def month_start(ts) -> Column:
    """First day of the month of a DATE/TIMESTAMP(_NTZ)."""
    return F.trunc(F.to_date(as_col(ts)), "month")
