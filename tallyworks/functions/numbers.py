"""Number expressions: three roundings, guarded parsing, bounded penalties, fixed formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyworks.functions.strings import strip

# Fixed value: the texts a float parser takes (Spark's own cast also takes suffixes like 1d).
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITE_TEXT = r"(?i)^\s*[+-]?(inf|infinity)\s*$"


def parse_number(col: Column) -> Column:
    """Double of a number-like text, null for anything else (infinities included)."""
    return F.when(col.rlike(NUMBER_TEXT), strip(col).try_cast("double"))


def is_number(col: Column) -> Column:
    return F.coalesce(parse_number(col).isNotNull() | col.rlike(INFINITE_TEXT), F.lit(False))


def fixed_decimals(col: Column, decimals: int) -> Column:
    """Text with so many decimals, rounded half-even on the exact binary value."""
    return F.replace(F.format_number(col, decimals), F.lit(","), F.lit(""))


def round_exact(col: Column, decimals: int) -> Column:
    """Half-even rounding of the exact binary value, the rule of a scalar `round`."""
    return fixed_decimals(col, decimals).cast("double")


def round_scaled(col: Column, decimals: int) -> Column:
    """Half-even rounding of the scaled value, the rule of a columnar `round`."""
    scale = F.lit(float(10**decimals))
    return F.rint(col * scale) / scale


def half_up(col: Column, decimals: int) -> Column:
    """Half-up rounding in plain double arithmetic; used for result columns."""
    scale = F.lit(float(10**decimals))
    return F.floor(col * scale + F.lit(0.5)).cast("double") / scale


def capped_share(col: Column, full: float) -> Column:
    """Share of `full`, at most one."""
    return F.least(F.lit(1.0), col / F.lit(float(full)))


def not_below_zero(col: Column) -> Column:
    return F.greatest(F.lit(0.0), col)
