"""Numeric column expressions: Oracle-compatible null rules and money math."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEDGER = "decimal(18,6)"


def nvl0(col: Column) -> Column:
    """NVL(x, 0)."""
    return F.coalesce(col, F.lit(0))


def greatest_null_strict(*cols: Column) -> Column:
    """Oracle's GREATEST returns NULL when any argument is NULL;
    Spark's ``greatest`` skips nulls. Guard so null in gives null out."""
    any_null = None
    for c in cols:
        any_null = c.isNull() if any_null is None else (any_null | c.isNull())
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cols))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Value / turn as a double; NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def half_up_ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """Numerator / denominator rounded half away from zero to ``scale`` places, exactly.

    The quotient itself is never formed: with integers N and D for the two values, the result is
    floor((2 N 10^scale + D) / 2 D) / 10^scale, sign apart, so a half in the last place is never lost to the
    rounding of a quotient. NULL when either value is NULL or the denominator is 0. Both may have up to 6 decimal
    places and 12 digits after scaling by 10^scale stays free in decimal(38)."""
    wide = "decimal(38,6)"
    n, d = F.abs(numerator).cast("decimal(28,6)"), F.abs(denominator).cast("decimal(24,6)")
    twice = (n * F.lit(2 * 10 ** scale).cast("decimal(8,0)")).cast(wide) + d.cast(wide)
    units = F.call_function("div", twice.cast(wide), (d * F.lit(2).cast("decimal(1,0)")).cast(wide))
    negative = (numerator < 0) != (denominator < 0)
    value = (units.cast("decimal(19,0)") * F.lit(1).cast("decimal(1,0)") / F.lit(10 ** scale).cast("decimal(8,0)")).cast(f"decimal(28,{scale})")
    return F.when(denominator != 0, F.when(negative, -value).otherwise(value))


def br_number(text: Column, target: str = "decimal(18,2)") -> Column:
    """lenient pt-BR number text ``1.234,56`` -> decimal; NULL if not a number.
    Without a comma a dot is the decimal point (``1234.56``)."""
    trimmed = F.btrim(text)
    cleaned = F.when(F.contains(trimmed, F.lit(",")), F.translate(trimmed, ",.", ".")).otherwise(trimmed)
    return F.nullif(cleaned, F.lit("")).try_cast(target)


def _us_grouped(value: Column) -> Column:
    """``1,234,567.12``: Java's DecimalFormat on the double rounds half-even on
    the exact binary value, as Python's ``format(x, ',.2f')`` does."""
    return F.format_number(value.cast("double"), 2)


def br_money_text(value: Column, prefix: str = "R$ ", null_as_zero: bool = True) -> Column:
    """``R$ 1.234.567,12`` (thousands dot, decimal comma); NULL -> ``R$ 0,00``."""
    amount = value.cast("double")
    if null_as_zero:
        amount = F.coalesce(amount, F.lit(0.0))
    return F.concat(F.lit(prefix), F.translate(_us_grouped(amount), ",.", ".,"))


def br_grouped_text(value: Column) -> Column:
    """Number as pt-BR text with grouping, e.g. ``1.234,56`` (no prefix)."""
    return F.translate(_us_grouped(value), ",.", ".,")
