"""``;``-separated CSV with decimal comma (pt-BR report files).

Writing: decimals keep their scale and use a decimal comma, dates are ISO
(``dd/MM/yyyy`` on request), no index column. Spark writes a folder of part
files and no byte-order mark (documented difference from the single BOM file
of the source). Reading: every column is read as text and converted with
built-in expressions, like the source's lenient coercion: numbers via the
pt-BR parser (F13), dates via the two-format parser (F7), anything else via
``try_cast``; a leading BOM in the header is dropped. Quotes inside a text are
doubled on both sides; NULL is an empty field and an empty text is ``""``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DateType, DecimalType, DoubleType, FloatType, StringType, StructType,
                               TimestampType)

from tradeflow.functions.dates import BR_DATE, ISO_DATE, lenient_date
from tradeflow.functions.numeric import br_number
from tradeflow.sources.parquet_io import has_files
from tradeflow.sources.schemas import MissingInput, empty

SEP = ";"
QUOTING = {"sep": SEP, "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
           "ignoreTrailingWhiteSpace": False}
UNUSED_NULL = "\u0000"          # read side: keeps a quoted empty text apart from an empty field
BOM = "﻿"


def to_br_text(df: DataFrame, date_format: str = ISO_DATE) -> DataFrame:
    """Render every column as the text the report file carries."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, DecimalType):
            c = F.translate(c.cast("string"), ".", ",")
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.translate(c.cast("decimal(38,10)").cast("string"), ".", ",")
        elif isinstance(f.dataType, DateType):
            c = F.date_format(c, date_format)
        elif isinstance(f.dataType, TimestampType):
            c = F.date_format(c, date_format + " HH:mm:ss")
        else:
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_br_csv(df: DataFrame, path: str, date_format: str = ISO_DATE, mode: str = "overwrite",
                 sort_within: list | None = None) -> None:
    """Replace-if-exists write of a report as pt-BR CSV (one folder)."""
    out = to_br_text(df, date_format)
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    out.write.mode(mode).options(**QUOTING, nullValue="", emptyValue='""').csv(path)


def _raw(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    raw = (spark.read.options(**QUOTING, encoding="UTF-8", inferSchema=False, multiLine=multi_line,
                              nullValue=UNUSED_NULL, emptyValue="").csv(path))
    rename = {c: c.lstrip(BOM) for c in raw.columns if c.startswith(BOM)}
    return raw.withColumnsRenamed(rename) if rename else raw


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a pt-BR CSV."""
    return _raw(spark, path, False).columns


def _parsed(text: Column, kind: DataType) -> Column:
    if isinstance(kind, DecimalType):
        return br_number(text, kind.simpleString())
    if isinstance(kind, (DoubleType, FloatType)):
        return br_number(text, "decimal(38,10)").cast(kind)
    if isinstance(kind, DateType):
        return lenient_date(text)
    return text if isinstance(kind, StringType) else text.try_cast(kind)


def read_br_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False, missing: str = "error") -> DataFrame:
    """Read a pt-BR CSV into ``schema`` leniently (bad values -> NULL).

    ``multi_line`` keeps line breaks inside quoted texts; each part file is then
    read by one task, so it is off unless the texts can hold them. ``missing``
    says what a path without files is (S10): ``"error"`` (MissingInput) or
    ``"empty"``, no rows in the declared schema; so is a folder without a file."""
    guard = _guard(spark, path, schema, missing)
    if guard is not None:
        return guard
    raw = _raw(spark, path, multi_line)
    return raw.select(*[(_parsed(F.col(f"`{f.name}`"), f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                        for f in schema.fields])                      # P19: a column that the file lacks is NULL


def _guard(spark: SparkSession, path: str, schema: StructType, missing: str) -> DataFrame | None:
    if missing not in ("error", "empty"):
        raise ValueError(f"missing must be 'error' or 'empty', not {missing!r}")
    if has_files(spark, path):
        return None
    if missing == "error":
        raise MissingInput(f"no CSV file at {path}")
    return empty(spark, schema)


class Coercions:
    """Counts of a counted read, ready once the frame has been written or otherwise run through: per column the rows, the
    fields that held something and those that became NULL."""

    def __init__(self, spark: SparkSession, observation: Observation | None, columns: list[str]):
        self.spark, self.observation, self.columns = spark, observation, columns

    def counts(self) -> list[tuple[str, int, int, int]]:
        got = self.observation.get if self.observation is not None else {}
        return [(c, got.get("n", 0), got.get(f"filled_{i}", 0), got.get(f"lost_{i}", 0)) for i, c in enumerate(self.columns)]

    def report(self) -> DataFrame:
        """One row per column: coluna, linhas, preenchidas, anuladas."""
        return self.spark.createDataFrame(self.counts(), "coluna string, linhas long, preenchidas long, anuladas long")

    def alarms(self, share: float = 1.0) -> list[str]:
        """Columns that lost ``share`` or more of their filled fields (the default: all of them)."""
        return [c for c, _, filled, lost in self.counts() if filled and lost >= share * filled]


def read_br_csv_counted(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False,
                        missing: str = "error") -> tuple[DataFrame, Coercions]:
    """``read_br_csv`` and the counts of what it coerced, observed in the pass that uses the rows (no extra scan).

    The counts belong to the first action that runs the frame to its end."""
    names = [f.name for f in schema.fields]
    guard = _guard(spark, path, schema, missing)
    if guard is not None:
        return guard, Coercions(spark, None, names)
    raw = _raw(spark, path, multi_line)
    texts = {f.name: F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None).cast("string") for f in schema.fields}
    both = raw.select(*[F.struct(texts[f.name].alias("t"), _parsed(texts[f.name], f.dataType).cast(f.dataType).alias("v")).alias(f.name)
                        for f in schema.fields])
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("n")]
    for i, n in enumerate(names):
        filled = F.col(f"`{n}`")["t"].isNotNull() & (F.col(f"`{n}`")["t"] != "")
        metrics += [F.count_if(filled).alias(f"filled_{i}"), F.count_if(filled & F.col(f"`{n}`")["v"].isNull()).alias(f"lost_{i}")]
    observed = both.observe(seen, *metrics)
    return observed.select(*[F.col(f"`{n}`")["v"].alias(n) for n in names]), Coercions(spark, seen, names)


__all__ = ["csv_header", "write_br_csv", "read_br_csv", "read_br_csv_counted", "Coercions", "to_br_text", "BR_DATE", "ISO_DATE"]
