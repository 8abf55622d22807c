"""Relational extract through Spark's JDBC source.

The reports only need DataFrames; in a deployment the ERP relations come from
here (or from a Parquet landing zone). A large relation is read in ranges of one
of its columns, so that no single task pulls it whole; a query's parameters are
bind values rendered as literals of their types. Connection settings are
arguments; nothing is read from the environment. (The reads themselves are not
exercised by the tests: no database is available in the build environment. What
is tested is the options and query texts that they are given.)
"""

from __future__ import annotations

import datetime as dt
import decimal
import re
from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tradeflow.sources.schemas import ERP_OPTIONAL, ERP_SCHEMAS, conform

FETCH_ROWS = 10_000


@dataclass(frozen=True)
class Ranges:
    """A read in ``parts`` ranges of a numeric or date column; rows beyond the bounds (and NULLs) go to the outer ranges."""
    column: str
    lower: int | dt.date
    upper: int | dt.date
    parts: int

    def options(self) -> dict[str, str]:
        if self.parts < 1 or not self.lower < self.upper:
            raise ValueError(f"no ranges: {self}")
        return {"partitionColumn": self.column, "lowerBound": str(self.lower), "upperBound": str(self.upper), "numPartitions": str(self.parts)}


def literal(value) -> str:
    """A bind value as an SQL literal: NULL, number, text with doubled quotes, DATE or TIMESTAMP."""
    if value is None:
        return "NULL"
    if isinstance(value, bool) or not isinstance(value, (int, float, decimal.Decimal, str, dt.date)):
        raise TypeError(f"no literal for {value!r}")
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if not decimal.Decimal(value).is_finite():
        raise ValueError(f"no literal for {value!r}")
    return str(value)


_PIECES = re.compile(r"'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/|(?<![:\w]):([A-Za-z_]\w*)", re.S)


def bind(query: str, values: Mapping[str, object]) -> str:
    """``query`` with its ``:name`` parameters replaced by literals; names inside quotes or comments are left alone.

    Every name must have a value and every value must be used."""
    used = set()

    def put(match: re.Match) -> str:
        name = match.group(1)
        if name is None:
            return match.group(0)
        if name not in values:
            raise KeyError(f"no value for :{name}")
        used.add(name)
        return literal(values[name])

    text = _PIECES.sub(put, query)
    if set(values) - used:
        raise KeyError(f"unused values: {sorted(set(values) - used)}")
    return text


def read_options(url: str, table_or_query: str, properties: Mapping[str, str], ranges: Ranges | None = None,
                 values: Mapping[str, object] | None = None, fetch_rows: int = FETCH_ROWS) -> dict[str, str]:
    """Options of one read. A text with a blank is a query and becomes a derived table, any other a table name."""
    is_query = " " in table_or_query.strip()
    if values and not is_query:
        raise ValueError("only a query takes values")
    text = bind(table_or_query, values or {}) if is_query else table_or_query
    options = {"fetchsize": str(fetch_rows), **{k: str(v) for k, v in properties.items()}, "url": url,
               "dbtable": f"({text}) extract_rows" if is_query else text}
    return options | (ranges.options() if ranges else {})


def read_jdbc(spark: SparkSession, url: str, table_or_query: str, properties: Mapping[str, str], ranges: Ranges | None = None,
              values: Mapping[str, object] | None = None, predicates: Sequence[str] | None = None,
              fetch_rows: int = FETCH_ROWS) -> DataFrame:
    """One table or query, in ranges of a column or in one part per predicate (which must not overlap)."""
    options = read_options(url, table_or_query, properties, ranges, values, fetch_rows)
    if predicates:
        if ranges:
            raise ValueError("either ranges or predicates")
        rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(url, options["dbtable"], predicates=list(predicates), properties=rest)
    return spark.read.format("jdbc").options(**options).load()


def erp_tables_from_jdbc(spark: SparkSession, url: str, properties: Mapping[str, str], names: Sequence[str], schema: str | None = None,
                         ranges: Mapping[str, Ranges] | None = None) -> dict[str, DataFrame]:
    """Lazy ERP relations (same keys as the test fixture) in their declared schemas; ``ranges`` splits the large ones."""
    prefix = f"{schema}." if schema else ""
    return {n: conform(read_jdbc(spark, url, prefix + n, properties, (ranges or {}).get(n)), ERP_SCHEMAS[n], n, ERP_OPTIONAL.get(n))
            for n in names}
