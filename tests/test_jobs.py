import os
import tempfile

from tradeflow.plans import jobs
from tradeflow.plans.catalog import (EXPIRY_WINDOW, ORDER_DAY, ORDERS_SINCE, RECEIVABLES_SINCE, RETURNS_MIN_YEAR,
                                     REVENUE_WINDOW, SALES_SINCE, STOCK_AS_OF, STOCK_YEAR)
from tradeflow.sources.erp_fixture import ErpTables
from tests.conftest import SMALL_SF

PARAMS = jobs.ExtractParams(as_of=STOCK_AS_OF, revenue_window=REVENUE_WINDOW, order_day=ORDER_DAY,
                            expiry_window=EXPIRY_WINDOW, stock_year=STOCK_YEAR, returns_min_year=RETURNS_MIN_YEAR,
                            sales_since=SALES_SINCE, orders_since=ORDERS_SINCE, receivables_since=RECEIVABLES_SINCE)


def test_extract_files_are_written_in_order(spark):
    root = tempfile.mkdtemp(prefix="tf-jobs-")
    paths = jobs.run_extracts(ErpTables(spark, SMALL_SF), root, PARAMS, names=["excess_stock", "last_entry_cost"])
    assert set(paths) == {"excess_stock", "last_entry_cost"}
    back = spark.read.option("sep", ";").option("header", True).csv(paths["excess_stock"])
    keys = [(int(r.codfilial), int(r.codprod)) for r in back.collect()]
    assert keys and keys == sorted(keys)


def test_star_schema_export(spark):
    root = tempfile.mkdtemp(prefix="tf-star-")
    paths = jobs.run_star_schema(ErpTables(spark, SMALL_SF), root, PARAMS)
    assert len(paths) == 11 and all(os.path.isdir(p) for p in paths.values())       # ten tables and the calendar
    assert spark.read.parquet(paths["dim_filial"]).count() == 10


def test_reports_run_unchanged_on_parquet_landing_zone(spark):
    """Production input path: ERP relations as Parquet folders give the same report."""
    from tradeflow.plans import stock
    from tradeflow.sources.erp_tables import ErpParquetTables
    from tradeflow.sources.parquet_io import write_parquet
    from tests.harness import canonical_rows

    fixture = ErpTables(spark, SMALL_SF)
    root = tempfile.mkdtemp(prefix="tf-erp-")
    needed = ["pchistest", "pcmov", "pcest", "pcprodut", "pcfornec", "pcdepto", "pcsecao", "pccategoria", "pcempr"]
    for name in needed:
        write_parquet(fixture[name], f"{root}/{name}")
    landed = ErpParquetTables(spark, root)
    a = stock.excess_stock_monthly(fixture, STOCK_YEAR)
    b = stock.excess_stock_monthly(landed, STOCK_YEAR)
    assert canonical_rows(a.columns, [tuple(r) for r in a.collect()]) == \
        canonical_rows(b.columns, [tuple(r) for r in b.collect()])


def test_item_matrix_export(spark):
    from tradeflow.plans import customers
    from tradeflow.plans.catalog import LIFECYCLE_SINCE, MATRIX_YEARS

    base = customers.sales_base(ErpTables(spark, SMALL_SF), LIFECYCLE_SINCE)
    path = jobs.export_item_matrix(base, MATRIX_YEARS, os.path.join(tempfile.mkdtemp(prefix="tf-mx-"), "m.csv"))
    back = spark.read.option("sep", ";").option("header", True).csv(path)
    assert "01/1999" in back.columns and back.count() > 0
