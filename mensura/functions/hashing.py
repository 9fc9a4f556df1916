"""Hash scalars: O24 surrogate keys, O29 canonical JSON row, S17 version names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import as_col


def surrogate_key(c) -> Column:
    """SHA-256 hex of a label."""
    return F.sha2(as_col(c).cast("string"), 256)


def resource_id(url, length: int = 12) -> Column:
    """First ``length`` hex chars of SHA-256(url)."""
    return F.substring(F.sha2(as_col(url), 256), 1, length)


def canonical_json(df: DataFrame, cols=None) -> Column:
    """One JSON object per row, keys sorted by name, NULLs kept."""
    names = sorted(cols or df.columns)
    return F.to_json(F.struct(*[F.col(f"`{n}`") for n in names]), {"ignoreNullFields": "false"})


def exact_double(c) -> Column:
    """A double as ``<sign><52-bit mantissa>e<exponent>``: its exact value, by
    arithmetic that any IEEE engine does alike (decimal renderings differ
    between engines).  Zero of either sign and what lies below 1e-300 is
    ``0``; ``nan`` and ``inf`` stand for themselves."""
    x = as_col(c).cast("double")
    a = F.abs(x)
    guess = F.floor(F.log2(a))
    scaled = a * F.pow(F.lit(2.0), -guess)
    exponent = guess + F.when(scaled >= 2, 1).when(scaled < 1, -1).otherwise(0)
    mantissa = (a * F.pow(F.lit(2.0), -exponent) * F.lit(2.0 ** 52)).cast("bigint")
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    return (F.when(F.isnan(x), F.lit("nan")).when(a < F.lit(1e-300), F.lit("0")).when(a == F.lit(float("inf")), F.concat(sign, F.lit("inf")))
            .otherwise(F.concat(sign, mantissa.cast("string"), F.lit("e"), exponent.cast("string"))))


def canonical_text(df: DataFrame, cols=None) -> Column:
    """O29 in a form that another engine renders alike: values by column name,
    each with its kind in front, joined by ``|``.

    ``~`` null, ``S<length>:<text>`` string, ``I`` integer, ``F`` double
    (:func:`exact_double`), ``B`` boolean as 1 or 0, ``D`` date, ``T``
    timestamp in microseconds, ``N`` decimal; other types as JSON after ``J``.
    """
    def value(name: str) -> Column:
        c, kind = F.col(f"`{name}`"), df.schema[name].dataType.simpleString()
        if kind == "string":
            text = F.concat(F.lit("S"), F.char_length(c).cast("string"), F.lit(":"), c)
        elif kind in ("tinyint", "smallint", "int", "bigint"):
            text = F.concat(F.lit("I"), c.cast("string"))
        elif kind in ("double", "float"):
            text = F.concat(F.lit("F"), exact_double(c))
        elif kind == "boolean":
            text = F.concat(F.lit("B"), c.cast("int").cast("string"))
        elif kind == "date":
            text = F.concat(F.lit("D"), c.cast("string"))
        elif kind.startswith("timestamp"):
            text = F.concat(F.lit("T"), F.unix_micros(c.cast("timestamp")).cast("string"))
        elif kind.startswith("decimal"):
            text = F.concat(F.lit("N"), c.cast("string"))
        else:
            text = F.concat(F.lit("J"), F.to_json(F.struct(c)))
        return F.coalesce(text, F.lit("~"))

    return F.concat_ws("|", *[value(n) for n in sorted(cols or df.columns)])


def row_sha(df: DataFrame, cols=None) -> Column:
    """SHA-256 hex of the canonical row text."""
    return F.sha2(canonical_text(df, cols), 256)


def version_name(stem, rid, sha, ext) -> Column:
    """``<stem>__src_<id12>__sha256_<sha12><ext>``."""
    return F.concat(as_col(stem), F.lit("__src_"), F.substring(as_col(rid), 1, 12),
                    F.lit("__sha256_"), F.substring(as_col(sha), 1, 12), as_col(ext))
