"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Document-type labels and pad widths of the customer extract.
CPF, CNPJ = "CPF", "CNPJ"
CPF_DIGITS, CNPJ_DIGITS = 11, 14
# Characters Python's ``str.strip()`` removes in practice (Spark's ``trim``
# only removes spaces).
PY_WHITESPACE = " \t\n\r\x0b\x0c"


def py_strip(col: Column) -> Column:
    """strip like Python ``str.strip()`` (spaces, tabs, newlines)."""
    return F.btrim(col, F.lit(PY_WHITESPACE))


def clean_label(col: Column, if_null: str) -> Column:
    """Dimension text cleaning: null -> placeholder, strip, upper case."""
    return F.upper(py_strip(F.coalesce(col, F.lit(if_null))))


def digits_only(col: Column) -> Column:
    """Keep digits; an empty result is NULL (Oracle treats '' as NULL)."""
    return F.nullif(F.regexp_replace(F.trim(col), r"[^0-9]", ""), F.lit(""))


def document_number(digits: Column) -> Column:
    """Up to 11 digits -> zero-padded CPF, otherwise padded/cut to 14 (CNPJ)."""
    return (F.when(F.length(digits) <= CPF_DIGITS, F.lpad(digits, CPF_DIGITS, "0"))
            .otherwise(F.lpad(digits, CNPJ_DIGITS, "0")))


def document_type(digits: Column) -> Column:
    return F.when(F.length(digits) <= CPF_DIGITS, F.lit(CPF)).otherwise(F.lit(CNPJ))


def contains_regex(col: Column, pattern: str) -> Column:
    """Case-insensitive regex search; NULL text never matches."""
    return F.coalesce(col.rlike("(?i)" + pattern), F.lit(False))
