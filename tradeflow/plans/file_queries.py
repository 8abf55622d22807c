"""Queries whose input is a file that the library wrote before: exported star schema, landed ERP relations, a year of
monthly files, the bucketed sales base. Each writes its files to the shared folder and reads them as a later job would."""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from tradeflow.plans import customers, jobs, sales, star
from tradeflow.plans.common import Tables
from tradeflow.sources.csv_br import csv_header, read_br_csv
from tradeflow.sources.erp_tables import ErpParquetTables, land
from tradeflow.sources.star_files import StarFiles, write_star
from tradeflow.sources.stored import scratch_path, store_bucketed


def _spark(tables: Tables) -> SparkSession:
    return getattr(tables, "spark", None) or SparkSession.getActiveSession()


def exported_star(tables: Tables, since: dt.date) -> StarFiles:
    """The files of the sales analyses: the sales fact and its three dimensions, with the calendar."""
    spark = _spark(tables)
    root = scratch_path(spark, "star")
    write_star({"fato_venda": star.fato_venda(tables, since), "dim_produto": star.dim_produto(tables),
                "dim_cliente": star.dim_cliente(tables), "dim_vendedor": star.dim_vendedor(tables)}, root)
    return StarFiles(spark, root)


def customer_summary_star(tables: Tables, exported_since: dt.date, since: dt.date) -> DataFrame:
    """R17 over exported files (S4): the customer summary of the sales since a date; older months stay unopened."""
    files = exported_star(tables, exported_since)
    return customers.customer_summary(customers.sales_base_of_files(files, since), files.table("dim_vendedor"))


def sales_last_months_star(tables: Tables, exported_since: dt.date, n: int = 12) -> DataFrame:
    """Revenue and orders per month and origin of the last ``n`` months in the files, found by the calendar while the
    query runs (dynamic partition pruning of the fact)."""
    files = exported_star(tables, exported_since)
    base = customers.sales_base_of_files(files, months=files.last_months(n))
    orders = base.groupBy("ANO", "MES", "ORIGEM_PEDIDO", "NUM_PEDIDO").agg(F.sum("VALOR_LIQUIDO").alias("VALOR_LIQUIDO"))
    return orders.groupBy("ANO", "MES", "ORIGEM_PEDIDO").agg(F.sum("VALOR_LIQUIDO").alias("VALOR_LIQUIDO"), F.count(F.lit(1)).alias("PEDIDOS"))


def excess_stock_incremental(tables: Tables, year: int, again: Sequence[int]) -> DataFrame:
    """A year of excess stock written month by month to one output, some months of which are then run a second
    time; each run replaces its months and leaves the others (equal to one run of the whole year)."""
    spark = _spark(tables)
    path = scratch_path(spark, "excess_by_month")
    jobs.run_monthly_excess(tables, path, year)
    for month in again:
        jobs.run_monthly_excess(tables, path, year, [month])
    return jobs.read_monthly_excess(spark, path, year)


def rep_revenue_landed(tables: Tables, start, end) -> DataFrame:
    """R10 over landed relations: written in their declared schemas, checked against them when they are read."""
    spark = _spark(tables)
    root = scratch_path(spark, "landing")
    land(tables, root, ["pcmov", "pcpedc", "pcusuari", "pcsuperv"])
    return sales.rep_revenue(ErpParquetTables(spark, root), start, end)


def customer_summary_bucketed(tables: Tables, since: dt.date) -> DataFrame:
    """R17's summary over a base stored in buckets of customers: neither of its two groupings by customer shuffles."""
    base = store_bucketed(customers.sales_base(tables, since), "sales_base", "nm_cliente")
    return customers.customer_summary(base, customers.sellers_of(tables))


def item_months_text(tables: Tables, since: dt.date) -> DataFrame:
    """A10 over an open domain: the item matrix with every month that occurs, its map shown as ``MM/YYYY=quantity;...``."""
    rows = customers.item_months(customers.sales_base(tables, since))
    text = F.transform(F.map_entries("MESES"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("decimal(38,2)").cast("string")))
    return rows.select("nm_cliente", "nm_produto", F.array_join(text, ";").alias("MESES"), "TOTAL")


def star_calendar(tables: Tables, since: dt.date) -> DataFrame:
    """The exported calendar (F10): every month that has sales, its number and its first day."""
    return exported_star(tables, since).table("dim_calendario")


def sales_of_old_star(tables: Tables, since: dt.date) -> DataFrame:
    """A star whose sales fact was written without supervisor and order origin, read with their defaults, per origin."""
    spark = _spark(tables)
    root = scratch_path(spark, "old_star")
    write_star({"fato_venda": star.fato_venda(tables, since).drop("cod_supervisor", "origem_pedido"), "dim_produto": star.dim_produto(tables),
                "dim_cliente": star.dim_cliente(tables), "dim_vendedor": star.dim_vendedor(tables)}, root)
    base = customers.sales_base_of_files(StarFiles(spark, root))
    return base.groupBy("ORIGEM_PEDIDO", "COD_SUPERVISOR", "ANO").agg(F.sum("VALOR_LIQUIDO").alias("VALOR_LIQUIDO"), F.count(F.lit(1)).alias("LINHAS"))


def item_matrix_file(tables: Tables, since: dt.date) -> DataFrame:
    """The item matrix written as a pt-BR CSV with a column per month that occurs, read back and turned into rows
    again (the cells that are not zero)."""
    spark = _spark(tables)
    path = jobs.export_item_matrix(customers.sales_base(tables, since), None, scratch_path(spark, "item_matrix.csv"))
    header = csv_header(spark, path)
    months = [c for c in header if c not in ("nm_cliente", "nm_produto", "TOTAL")]
    schema = StructType([StructField(c, StringType() if c.startswith("nm_") else DecimalType(28, 2)) for c in header])
    cells = read_br_csv(spark, path, schema).unpivot(["nm_cliente", "nm_produto"], months, "MES", "QT_VENDIDA")
    return cells.where(F.col("QT_VENDIDA") != 0)
