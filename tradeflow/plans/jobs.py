"""Extract jobs: each report written as the file the analysis layer reads.

One function call replaces the source's extract scripts (query -> delete the
old file -> write CSV/Parquet): every report is written with replace-if-exists
semantics (S7), in its defined row order where the source had one (O1), as a
pt-BR CSV (S3) or as snappy Parquet for the star schema (S5, S8).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.functions.dates import BR_DATE
from tradeflow.operators.aggregate import sorted_report
from tradeflow.plans import funds, sales, star, stock
from tradeflow.plans.common import Tables
from tradeflow.sources.csv_br import write_br_csv
from tradeflow.sources.parquet_io import drop_partition, replace_partitions
from tradeflow.sources.star_files import write_star
from tradeflow.sources.stored import release, store


@dataclass
class ExtractParams:
    as_of: dt.date
    revenue_window: tuple[dt.date, dt.date]
    order_day: dt.date
    expiry_window: tuple[dt.date, dt.date]
    stock_year: int
    returns_min_year: int
    sales_since: dt.date
    orders_since: dt.date
    receivables_since: dt.date
    extra: dict = field(default_factory=dict)


def extract_reports(tables: Tables, p: ExtractParams) -> dict[str, tuple[DataFrame, list]]:
    """File name -> (report, row order). Order lists are (column, direction)."""
    return {
        "last_entry_cost": (stock.last_entry_cost(tables), []),
        "fund_ledger": (funds.fund_ledger(tables), []),
        "returns_receivable": (
            funds.returns_receivable(tables, p.returns_min_year, include_paid=True), [("DATA_VENCIMENTO", "asc")]),
        "customer_documents": (sales.customer_documents(tables), []),
        "excess_stock": (stock.excess_stock(tables, p.as_of), [("codfilial", "asc"), ("codprod", "asc")]),
        "excess_stock_monthly": (stock.excess_stock_monthly(tables, p.stock_year),
                                     [("mes", "asc"), ("codfilial", "asc"), ("valor_excedente", "desc")]),
        "near_expiry": (stock.near_expiry(tables, *p.expiry_window), []),
        "near_expiry_product": (stock.near_expiry_product(tables, *p.expiry_window), []),
        "near_expiry_lot": (stock.near_expiry_product(tables, *p.expiry_window, with_lot=True), []),
        "rep_revenue": (sales.rep_revenue(tables, *p.revenue_window), []),
        "telesales_revenue": (sales.telesales_revenue(tables, *p.revenue_window), []),
        "day_orders_rep": (sales.day_orders_rep(tables, p.order_day), []),
        "day_orders_telesales": (sales.day_orders_telesales(tables, p.order_day), []),
    }


def run_extracts(tables: Tables, out_root: str, p: ExtractParams, date_format: str = BR_DATE,
                 names: list[str] | None = None) -> dict[str, str]:
    """Write the selected extracts (default: all) under ``out_root``; returns the paths."""
    out = {}
    for name, (df, order) in extract_reports(tables, p).items():
        if names and name not in names:
            continue
        path = f"{out_root.rstrip('/')}/{name}.csv"
        write_br_csv(sorted_report(df, order) if order else df, path, date_format=date_format)
        out[name] = path
    return out


def export_item_matrix(base: DataFrame, years, path: str, customers=()) -> str:
    """The customer x product x month quantity matrix as a pt-BR CSV,
    largest total first within each customer. ``years=None`` writes a column for every
    month that occurs; otherwise the months of ``years`` and one column for the rest."""
    from tradeflow.plans.customers import item_month_columns, item_month_matrix

    matrix = item_month_columns(base, customers) if years is None else item_month_matrix(base, years, customers)
    write_br_csv(sorted_report(matrix, [("nm_cliente", "asc"), ("TOTAL", "desc"), ("nm_produto", "asc")]), path)
    return path


def run_star_schema(tables: Tables, out_root: str, p: ExtractParams) -> dict[str, str]:
    """The seven dimensions, the three facts by month, and the calendar, as Parquet tables."""
    return write_star(star.star_schema(tables, p.sales_since, p.orders_since, p.receivables_since), out_root)


EXCESS_PARTITIONS = ("ano", "mes")


def run_monthly_excess(tables: Tables, path: str, year: int, months: Sequence[int] = stock.ALL_MONTHS) -> None:
    """Compute the excess stock of some months of a year and replace exactly these months in the output.

    The other months' files are not read or rewritten. A month that has no rows any more loses its old folder. A run
    that fails leaves the output as it was; a second run gives the same rows. The result is stored before it is
    written, so the months that it holds are known without computing it twice."""
    report = store(stock.excess_stock_monthly(tables, year, months).withColumn("ano", F.lit(year)), "excess_months")
    spark = report.sparkSession
    held = {r["mes"] for r in report.select("mes").distinct().collect()}           # twelve at most
    if held:
        replace_partitions(report, path, EXCESS_PARTITIONS)
    for month in set(months) - held:
        drop_partition(spark, path, ano=year, mes=month)
    release(report)


def read_monthly_excess(spark: SparkSession, path: str, year: int) -> DataFrame:
    """The stored months of one year (only their folders are opened)."""
    return spark.read.parquet(path).where(F.col("ano") == year).drop("ano")
