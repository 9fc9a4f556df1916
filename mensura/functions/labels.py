"""Label scalars: O15 code->label, O16 homologation, O17 level, O18 indicator names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# --- fixed values ---------------------------------------------------------
LEVEL_DETAIL = "DETALLADO"
LEVEL_REGIONAL = "AGREGADO_REGIONAL"
# Indicator names: "<unit>_<yyyy>_05" (month cut), "<unit>_ene_may_<yyyy>"
# (cumulative cut).
MONTH_CUT_PATTERN = r"^(dolares|libras)_(\d{4})_05$"
CUMULATIVE_CUT_PATTERN = r"^(dolares|libras)_ene_may_(\d{4})$"
# --------------------------------------------------------------------------


def literal_map(mapping: dict) -> Column:
    """A MAP literal; for small, declared lookups (a few hundred entries)."""
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def code_label(code, mapping: dict) -> Column:
    """Code -> label from a declared mapping; unmapped -> NULL (a rule flags it)."""
    return F.element_at(literal_map(mapping), as_col(code)) if mapping else F.lit(None).cast("string")


def homologate(label, mapping: dict) -> Column:
    """Mapped label if declared, otherwise the label itself."""
    if not mapping:
        return as_col(label)
    return F.coalesce(F.element_at(literal_map(mapping), as_col(label)), as_col(label))


def level(label, regional) -> Column:
    """``AGREGADO_REGIONAL`` when the label is regional, else ``DETALLADO``.

    ``regional`` is a list of labels or a boolean Column (e.g. the result of a
    left join against a region catalogue).
    """
    is_reg = as_col(label).isin(list(regional)) if isinstance(regional, (list, tuple, set)) else regional
    return F.when(is_reg, F.lit(LEVEL_REGIONAL)).otherwise(F.lit(LEVEL_DETAIL))


def parse_indicator(name, pattern: str) -> tuple[Column, Column]:
    """(unit, year) from an indicator name; no match -> (NULL, NULL)."""
    n = as_col(name)
    unit = F.nullif(F.regexp_extract(n, pattern, 1), F.lit(""))
    year = F.nullif(F.regexp_extract(n, pattern, 2), F.lit("")).try_cast("int")
    return unit, year
