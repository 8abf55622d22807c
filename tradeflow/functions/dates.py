"""Date column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

BR_DATE = "dd/MM/yyyy"
ISO_DATE = "yyyy-MM-dd"


def as_date(value) -> dt.date:
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def lenient_date(text: Column) -> Column:
    """Typed date from ``dd/MM/yyyy`` or ISO text; anything else NULL.

    Each format is tried explicitly (no day-first guessing), so ``2025-01-02``
    is 2 January and ``31/02/2025`` is NULL. A slash tells which of the two can
    match: a format that cannot would fail by an exception, row by row."""
    t = F.btrim(text)
    return F.when(F.contains(t, F.lit("/")), F.try_to_date(t, BR_DATE)).otherwise(F.try_to_date(t, ISO_DATE))


def br_date_text(col: Column) -> Column:
    """date -> ``dd/MM/yyyy`` text (sinks only)."""
    return F.date_format(col, BR_DATE)


def month_start(year: int | Column, month: int | Column) -> Column:
    """first day of a month; NULL for a year or month that is NULL or 0."""
    year, month = (F.nullif(v if isinstance(v, Column) else F.lit(v), F.lit(0)) for v in (year, month))
    return F.make_date(year, month, F.lit(1))


def year_or_zero(col: Column) -> Column:
    """F8: calendar year, 0 when the date is missing."""
    return F.coalesce(F.year(col), F.lit(0))


def month_or_zero(col: Column) -> Column:
    return F.coalesce(F.month(col), F.lit(0))
