"""Registered report queries with their calibrated parameters.

Each entry maps a query key to a function of the ERP tables. The parameters
fit the driver data (order dates 1995-01-01 .. 2001-08-01); ``today`` is never
used, every report takes its reference date explicitly.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame

from tradeflow.operators import aggregate as agg
from tradeflow.plans import customers, file_queries as files, funds, sales, star, stock
from tradeflow.plans import operator_queries as ops

D = dt.date

# Calibrated parameters (see SURVEY section 7).
REVENUE_WINDOW = (D(2000, 11, 1), D(2000, 11, 30))
ORDER_DAY = D(2000, 12, 9)
EXPIRY_WINDOW = (D(2000, 1, 1), D(2000, 8, 31))
STOCK_AS_OF = D(2000, 7, 1)
STOCK_YEAR = 2000
RERUN_MONTHS = (5, 12)
FUND_AS_OF = D(2000, 12, 31)
FUND_FROM_YEAR = 1997
RETURNS_MIN_YEAR = 1998
R15_BRANCH, R15_CLASS, R15_YEAR, R15_SEARCH = "1 a 7", "FARMA", 1999, "supplier#0*1"
LIFECYCLE_SINCE, PREV_YEAR, CUR_YEAR = D(1999, 1, 1), 1999, 2000
STAR_SINCE = D(1997, 1, 1)          # the exported star reaches further back than the analyses
GAP_CUSTOMERS = 10
MATRIX_YEARS = (1999, 2000, 2001)
CUSTOMER_PATTERN = "CUSTOMER#0*12"
SALES_SINCE, ORDERS_SINCE, RECEIVABLES_SINCE = D(2000, 1, 1), D(2001, 1, 1), D(2000, 1, 1)


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    """Money/quantity measures leave the plan as doubles (decimals inside)."""
    return df.withColumns({n: df[n].cast("double") for n in names})

def _status(t):
    return funds.fund_status(funds.fund_ledger(t), FUND_AS_OF)


def _r15(t):
    return funds.fund_aggregation_inputs(funds.fund_ledger(t), funds.returns_receivable(t, RETURNS_MIN_YEAR),
                                         R15_BRANCH, R15_CLASS, R15_YEAR)


def _aged(t):
    return funds.returns_status(funds.returns_receivable(t, RETURNS_MIN_YEAR, include_paid=True), FUND_AS_OF)


def _base(t):
    return customers.sales_base(t, LIFECYCLE_SINCE)


def _cells(t):
    return customers.sales_cells(_base(t))


QUERIES: dict[str, Callable[..., DataFrame]] = {
    "rep_revenue": lambda t: sales.rep_revenue(t, *REVENUE_WINDOW),
    "telesales_revenue": lambda t: sales.telesales_revenue(t, *REVENUE_WINDOW),
    "day_orders_rep": lambda t: sales.day_orders_rep(t, ORDER_DAY),
    "day_orders_telesales": lambda t: sales.day_orders_telesales(t, ORDER_DAY),
    "customer_documents": lambda t: sales.customer_documents(t),
    # R13 star schema
    "dim_produto": star.dim_produto,
    "dim_filial": star.dim_filial,
    "dim_fornecedor": star.dim_fornecedor,
    "dim_cliente": star.dim_cliente,
    "dim_vendedor": star.dim_vendedor,
    "dim_supervisor": star.dim_supervisor,
    "dim_televendas": star.dim_televendas,
    "fato_venda": lambda t: _doubles(star.fato_venda(t, SALES_SINCE), "qt_vendida", "valor_bruto", "valor_liquido"),
    "fato_pedido_venda": lambda t: star.fato_pedido_venda(t, ORDERS_SINCE),
    "fato_receber": lambda t: star.fato_receber(t, RECEIVABLES_SINCE),
    # stock
    "last_entry_cost": stock.last_entry_cost,
    "excess_stock": lambda t: stock.excess_stock(t, STOCK_AS_OF),
    "excess_stock_monthly": lambda t: stock.excess_stock_monthly(t, STOCK_YEAR),
    "near_expiry": lambda t: stock.near_expiry(t, *EXPIRY_WINDOW),
    "near_expiry_product": lambda t: stock.near_expiry_product(t, *EXPIRY_WINDOW),
    "near_expiry_lot": lambda t: stock.near_expiry_product(t, *EXPIRY_WINDOW, with_lot=True),
    # R1 / R14 funds
    "fund_ledger": funds.fund_ledger,
    "fund_status": _status,
    "fund_kpis": lambda t: funds.fund_kpis(_status(t)),
    "fund_top_buyers": lambda t: funds.fund_top_buyers(_status(t)),
    "fund_overdue_share": lambda t: funds.fund_overdue_share(_status(t)),
    "fund_by_year_status": lambda t: funds.fund_by_year_status(_status(t)),
    "fund_year_class_pivot": lambda t: funds.fund_year_class_pivot(_status(t), FUND_FROM_YEAR),
    "fund_detail": lambda t: funds.fund_detail(_status(t), due_statuses=["VENCIDA"]),
    # R15 fund aggregation
    "fund_totals": lambda t: funds.fund_totals(*_r15(t)),
    "fund_by_supplier_year": lambda t: funds.fund_by_supplier_year(_r15(t)[0]),
    "fund_supplier_search": lambda t: funds.fund_by_supplier_year(_r15(t)[0], R15_SEARCH),
    "fund_receivable_detail": lambda t: funds.fund_receivable_detail(_r15(t)[0]),
    "fund_by_branch_buyer": lambda t: agg.group_sum(_r15(t)[0], ["CODIGOFILIAL", "COMPRADOR"], "VALOR_VERBA"),
    "fund_by_class": lambda t: agg.group_sum(_r15(t)[0], "CLASSIFICACAO", "VLR_RECEBER"),
    "fund_by_year": lambda t: funds.fund_by_year(_r15(t)[0]),
    "fund_returns_by_supplier": lambda t: agg.group_sum(_r15(t)[1], "FORNECEDOR", "VALOR_VERBA_DEVOLUCAO"),
    "returns_by_class": lambda t: agg.group_sum(_r15(t)[1], "CLASSIFICACAO", "VALOR_VERBA_DEVOLUCAO"),
    # R2 / R16 returns
    "returns_receivable": lambda t: funds.returns_receivable(t, RETURNS_MIN_YEAR),
    "returns_status": _aged,
    "returns_pending_kpi": lambda t: funds.returns_pending_kpi(_aged(t)),
    "returns_by_supplier": lambda t: funds.returns_by_supplier(_aged(t)),
    "funds_unified": lambda t: funds.funds_unified(_status(t), _aged(t)),
    "funds_unified_summary": lambda t: funds.funds_unified_summary(funds.funds_unified(_status(t), _aged(t))),
    # R17 customer lifecycle
    "sales_macro_kpis": lambda t: customers.sales_macro_kpis(_base(t), PREV_YEAR, CUR_YEAR),
    "sales_yoy": lambda t: customers.sales_yoy(_base(t)),
    "sales_month_year": lambda t: customers.sales_month_year(_base(t)),
    "top_categories": lambda t: customers.top_categories(_base(t)),
    "sales_by_origin": lambda t: customers.sales_by_origin(_base(t)),
    "customer_summary": lambda t: customers.customer_summary(_base(t), customers.sellers_of(t)),
    "customer_items": lambda t: customers.customer_items(_base(t), CUR_YEAR),
    "category_section_share": lambda t: customers.category_section_share(_base(t)),
    "category_gap": lambda t: customers.category_gap(_base(t)),
    "bait_products": lambda t: customers.bait_products(_base(t)),
    "mix_erosion": lambda t: customers.mix_erosion(_base(t), PREV_YEAR, CUR_YEAR),
    "item_month_matrix": lambda t: customers.item_month_matrix(_base(t), MATRIX_YEARS),
    "category_gap_rows": lambda t: customers.category_gap_of(_cells(t), customers.top_customers(_cells(t), GAP_CUSTOMERS)),
    "item_months": lambda t: files.item_months_text(t, LIFECYCLE_SINCE),
    # reports over files that the library wrote
    "customer_summary_star": lambda t: files.customer_summary_star(t, STAR_SINCE, LIFECYCLE_SINCE),
    "sales_last_months_star": lambda t: files.sales_last_months_star(t, STAR_SINCE),
    "excess_stock_incremental": lambda t: files.excess_stock_incremental(t, STOCK_YEAR, RERUN_MONTHS),
    "rep_revenue_landed": lambda t: files.rep_revenue_landed(t, *REVENUE_WINDOW),
    "customer_summary_bucketed": lambda t: files.customer_summary_bucketed(t, LIFECYCLE_SINCE),
    "star_calendar": lambda t: files.star_calendar(t, LIFECYCLE_SINCE),
    "sales_of_old_star": lambda t: files.sales_of_old_star(t, LIFECYCLE_SINCE),
    "item_matrix_file": lambda t: files.item_matrix_file(t, LIFECYCLE_SINCE),
    "returns_positions": lambda t: ops.returns_positions(_aged(t)),
    "csv_coercion_report": ops.csv_coercion_report,
    "customers_by_branch_sketch": lambda t: ops.customers_by_branch_sketch(t, LIFECYCLE_SINCE),
    "sales_by_customer_salted": ops.sales_by_customer_salted,
    # single operators over whole relations
    "null_safe_ne": ops.null_safe_ne,
    "group_sum_keep_nulls": ops.group_sum_keep_nulls,
    "group_sum_drop_nulls": ops.group_sum_drop_nulls,
    "filter_group_sum": ops.filter_group_sum,
    "pivot_branch_month": lambda t: ops.pivot_branch_month(t, STOCK_YEAR),
    "unpivot_branch_measures": ops.unpivot_branch_measures,
    "rollup_category_section": ops.rollup_category_section,
    "share_by_branch": ops.share_by_branch,
    "anti_join_orders_without_items": ops.anti_join_orders_without_items,
    "semi_join_released_titles": ops.semi_join_released_titles,
    "expression_key_join": ops.expression_key_join,
    "scalar_subquery_lot_one": ops.scalar_subquery_lot_one,
    "union_by_name": ops.union_by_name,
    "distinct_on_key": ops.distinct_on_key,
    "distinct_rows": ops.distinct_rows,
    "sorted_domain": ops.sorted_domain,
    "regex_search_customers": lambda t: ops.regex_search_customers(t, CUSTOMER_PATTERN),
    "br_number_roundtrip": ops.br_number_roundtrip,
    "br_currency": ops.br_currency,
    "lenient_dates": ops.lenient_dates,
    "range_join_trailing_sales": lambda t: ops.range_join_trailing_sales(t, STOCK_YEAR),
    "csv_roundtrip": ops.csv_roundtrip,
    "parquet_roundtrip": lambda t: ops.parquet_roundtrip(t, LIFECYCLE_SINCE),
}

FLAGSHIP = "excess_stock_monthly"   # SURVEY section 7: R6 is the flagship (one job for twelve months)
