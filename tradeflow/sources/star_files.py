"""The star schema as files: written by the export job, read by the customer analyses.

Facts are partitioned by the year and month of their date, so an analysis of
some months opens the folders of those months only: a literal range prunes when
the query is planned, a join with the calendar prunes when it runs (dynamic
partition pruning). Dates that are missing lie in year 0, month 0.
"""

from __future__ import annotations

import datetime as dt
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tradeflow.functions.dates import month_or_zero, month_start, year_or_zero
from tradeflow.sources.parquet_io import path_exists, write_parquet
from tradeflow.sources.schemas import STAR_OPTIONAL, STAR_SCHEMAS, MissingInput, conform, empty

YEAR, MONTH = "ano", "mes"
FACT_DATES = {"fato_venda": "data_movimentacao", "fato_pedido_venda": "data_pedido", "fato_receber": "dt_emissao"}
CALENDAR = "dim_calendario"


def partition_index(year: Column, month: Column) -> Column:
    """Months counted from year 0."""
    return year * 12 + month - 1


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def write_star(tables: Mapping[str, DataFrame], root: str, calendar_of: str = "fato_venda") -> dict[str, str]:
    """Write every table of the star, the facts by month, and the calendar of the months that ``calendar_of`` holds.

    The rebalance hint gives each month a few files of Spark's advisory size and
    splits a month that is larger than the others, instead of one file per task
    and month."""
    out = {}
    for name, df in tables.items():
        out[name] = _path(root, name)
        if name in FACT_DATES:
            day = F.col(FACT_DATES[name])
            dated = df.withColumns({YEAR: year_or_zero(day), MONTH: month_or_zero(day)})
            write_parquet(dated.hint("rebalance", F.col(YEAR), F.col(MONTH)), out[name], partition_by=(YEAR, MONTH))
        else:
            write_parquet(df, out[name])
    if calendar_of in out:
        spark = next(iter(tables.values())).sparkSession
        months = _partitioned(spark, out[calendar_of]).select(YEAR, MONTH).distinct()
        out[CALENDAR] = _path(root, CALENDAR)
        write_parquet(months.select(
            YEAR, MONTH, partition_index(F.col(YEAR), F.col(MONTH)).alias("indice"),
            month_start(F.col(YEAR), F.col(MONTH)).alias("primeiro_dia")), out[CALENDAR])
    return out


def _partitioned(spark: SparkSession, path: str) -> DataFrame:
    """A fact with its partition columns as integers."""
    return spark.read.parquet(path).withColumns({c: F.col(c).cast("int") for c in (YEAR, MONTH)})


class StarFiles:
    """Tables of an exported star, pruned to the columns asked for and conformed to their declarations.

    ``missing`` as in ``ErpParquetTables``: a table without files raises
    MissingInput or is empty (S10)."""

    def __init__(self, spark: SparkSession, root: str, missing: str = "error"):
        self.spark, self.root, self.missing = spark, root, missing

    def table(self, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        """Columns of one table (upper or lower case); the partition columns of a fact come last."""
        wanted = STAR_SCHEMAS[name]
        if columns is not None:
            lower = [c.lower() for c in columns]
            wanted = StructType([wanted[c] for c in lower])
        parts = [StructField(c, IntegerType()) for c in (YEAR, MONTH)] if name in FACT_DATES else []
        full = StructType(wanted.fields + parts)
        path = _path(self.root, name)
        if not path_exists(self.spark, path):
            if self.missing == "error":
                raise MissingInput(f"table {name}: nothing at {path}")
            return empty(self.spark, full)
        df = _partitioned(self.spark, path) if parts else self.spark.read.parquet(path)
        return conform(df, full, name, STAR_OPTIONAL.get(name))

    def fact_since(self, name: str, since: dt.date, columns: Sequence[str]) -> DataFrame:
        """Rows dated ``since`` or later: whole months by their folders, the first month by its dates as well."""
        day = FACT_DATES[name]
        month = partition_index(F.col(YEAR), F.col(MONTH))
        rows = self.table(name, list(dict.fromkeys([*(c.lower() for c in columns), day])))
        return rows.where((F.col(YEAR) >= since.year) & (month >= since.year * 12 + since.month - 1) & (F.col(day) >= F.lit(since)))

    def fact_of_months(self, name: str, months: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Rows of the months of a filtered calendar: the join prunes the fact's folders while the query runs."""
        rows = self.table(name, columns)
        return rows.join(months.select(YEAR, MONTH), [YEAR, MONTH])

    def last_months(self, n: int) -> DataFrame:
        """The calendar's last ``n`` months up to the latest one that has rows."""
        calendar = self.table(CALENDAR).where(F.col(YEAR) > 0)
        last = calendar.select(F.max("indice")).scalar()
        return calendar.where(F.col("indice") > last - n)
