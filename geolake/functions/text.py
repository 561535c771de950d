"""Text to value coercion with pandas-compatible missing-value rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Tokens pandas' CSV reader turns into a missing value even for text columns.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN",
               "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
               "None", "n/a", "nan", "null"]
# Characters folded by the indicator slug: space, e-acute, e-grave,
# e-circumflex, a-grave, u-circumflex, o-circumflex, apostrophe.
SLUG_FROM = " éèêàûô'"
SLUG_TO = "_eeeauo"
# --- end of fixed values ----------------------------------------------------

# A plain decimal number as pandas.to_numeric accepts it (no type suffix).
_NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def null_tokens(c: Column) -> Column:
    """Map pandas' missing-value tokens to NULL."""
    return F.when(c.isin(NULL_TOKENS), F.lit(None)).otherwise(c)


def to_double(c: Column) -> Column:
    """Strict numeric text -> double; anything else (``ndiff``, ``1.5d``) -> NULL."""
    s = F.trim(c.cast("string"))
    return F.when(s.rlike(_NUMERIC), s.try_cast("double"))


def decimal_comma(c: Column) -> Column:
    """Decimal-comma text (``"12,5"``) -> double, malformed -> NULL."""
    return to_double(F.regexp_replace(c.cast("string"), ",", "."))


def nan_to_null(c: Column) -> Column:
    """NaN -> NULL so NULL is the only missing marker downstream."""
    return F.nanvl(c, F.lit(None).cast("double"))


def slug(c: Column) -> Column:
    """Indicator name -> column-name slug (lower, space->_, accents folded)."""
    return F.translate(F.lower(c), SLUG_FROM, SLUG_TO)


def slug_py(name: str) -> str:
    """Driver-side twin of :func:`slug` for building column names."""
    table = {ord(a): (SLUG_TO[i] if i < len(SLUG_TO) else None)
             for i, a in enumerate(SLUG_FROM)}
    return name.lower().translate(table)


def round_half_even(c: Column, digits: int = 1) -> Column:
    """numpy-style rounding: ``rint(x * 10**d) / 10**d`` on binary doubles.

    Spark's ``round`` is HALF_UP on the decimal text and differs at ties.
    """
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def parse_date(c: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date text -> date; invalid or other format -> NULL (never raises)."""
    return F.to_date(F.try_to_timestamp(c, F.lit(fmt)))


def nonempty(c: Column) -> Column:
    """NULL for empty strings (Python's ``a or b`` skips empty text)."""
    return F.when(c != "", c)
