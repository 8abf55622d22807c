"""Plan checks of the reports: no Python in the plans, semi/anti joins, top-k as
TakeOrderedAndProject, pushed filters, no cartesian products."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL_SF
from tradeflow.plans.catalog import QUERIES as CATALOG

QUERIES = {name: query for name, query in entry.queries().items() if name in CATALOG}


def plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.optimizedPlan().toString() + "\n" + qe.executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan(f(spark, SMALL_SF)) for n, f in QUERIES.items()}


def test_no_python_udf_and_no_cartesian(plans):
    for name, text in plans.items():
        for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct"):
            assert node not in text, (name, node)


def test_exists_and_not_exists_are_semi_and_anti_joins(plans):
    assert "LeftSemi" in plans["dim_televendas"]
    assert "LeftAnti" in plans["anti_join_orders_without_items"]
    # EXISTS with OR / wildcard: equi-join + scalar flags, never a nested loop
    for name in ("returns_receivable", "semi_join_released_titles", "funds_unified"):
        assert "BroadcastNestedLoopJoin" not in plans[name], name


def test_masters_are_broadcast(plans):
    assert "BroadcastHashJoin" in plans["rep_revenue"]
    assert "BroadcastHashJoin" in plans["excess_stock"]


def test_top_k_is_take_ordered(plans):
    for name in ("top_categories", "fund_top_buyers", "mix_erosion"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_monthly_excess_is_one_plan_without_range_join(plans):
    text = plans["excess_stock_monthly"]
    assert "BroadcastNestedLoopJoin" not in text
    assert "Generate explode" in text
    # the date window reaches the order scan as a pushed filter
    assert "PushedFilters" in text and "o_orderdate" in text


def test_pruned_scans(spark):
    df = QUERIES["rep_revenue"](spark, SMALL_SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    # the lineitem scan reads only the columns the report needs
    assert "l_comment" not in text and "ReadSchema" in text


def test_aggregations_combine_map_side_before_the_shuffle(plans):
    """Sums and counts are partial-aggregated before their exchange, so a hot
    key is reduced to one row per key and task before it moves."""
    for name in ("rep_revenue", "fato_venda", "excess_stock_monthly", "customer_summary", "fund_ledger",
                 "returns_receivable", "item_month_matrix"):
        assert "partial_sum" in plans[name] or "partial_count" in plans[name], name


def test_no_job_runs_while_a_report_is_built(spark):
    from tradeflow.plans.catalog import QUERIES
    from tradeflow.sources.erp_fixture import DRIVER_TABLES, ErpTables

    tables = ErpTables(spark, "/root/testdata/sf0.001")
    for name in DRIVER_TABLES:                      # reading a Parquet schema is a job of its own
        tables.driver[name]
    spark.sparkContext.setJobGroup("build", "reports")
    try:
        for name in ("customer_summary", "excess_stock", "near_expiry", "returns_receivable", "fund_ledger", "rep_revenue"):
            QUERIES[name](tables)
        assert not list(spark.sparkContext.statusTracker().getJobIdsForGroup("build"))
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()


def below(text: str, *marks: str) -> str:
    """Lines of an optimized plan under the first node that holds all of ``marks``, by indentation."""
    lines = text.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(lines) if all(m in line for m in marks))
    end = next((i for i in range(at + 1, len(lines)) if depth(lines[i]) <= depth(lines[at])), len(lines))
    return "\n".join(lines[at + 1:end])


def optimized(spark, name) -> str:
    return QUERIES[name](spark, SMALL_SF)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["near_expiry", "near_expiry_product", "near_expiry_lot"])
def test_expiry_is_filtered_before_the_masters(spark, name):
    text = optimized(spark, name)
    under = below(text, "Join", "LeftOuter", "lot_expiry") if "Filter (coalesce(lot_expiry" not in text else below(text, "Filter", "coalesce(lot_expiry")
    assert "p_name" not in under and "s_name" not in under and "l_quantity" in under
    # the flags of a product are distinct before they are joined: no row is repeated per branch
    assert "Aggregate [p_partkey" in text or "Aggregate [codprod" in text


def test_fund_fan_out_is_an_explode(spark):
    text = optimized(spark, "fund_ledger")
    assert text.count("Generate inline") == 2 and text.count("Union") == 1
    under = below(text, "Union")
    assert "Join" not in under and "o_custkey" not in under                 # movements alone, reduced before the fund is joined


def test_returns_are_summed_before_the_names(spark):
    text = optimized(spark, "returns_receivable")
    sums = [line for line in text.splitlines() if "Aggregate [" in line and "codcli" in line]
    assert sums, text


def test_missing_ids_are_spread_in_the_sales_base(spark):
    for name, joins in (("customer_summary", 1), ("customer_items", 2)):    # dimensions that a view does not need are pruned
        assert optimized(spark, name).count("pmod(xxhash64(") >= joins, name


def test_monthly_rerun_reads_its_own_months(spark):
    from tradeflow.plans import stock
    from tradeflow.sources.erp_fixture import ErpTables
    text = plan(stock.excess_stock_monthly(ErpTables(spark, SMALL_SF), 2000, [5]))
    assert "2000-02-01" in text or "2000-02" in text                        # sales from 90 days before the first of May on


def test_ledger_arrays_are_built_after_the_shuffle_by_fund(spark):
    """No array of a fund is begun before its reduced movements lie together."""
    from tradeflow.plans.funds import fund_movements
    from tradeflow.sources.erp_fixture import ErpTables
    lines = fund_movements(ErpTables(spark, SMALL_SF))._jdf.queryExecution().executedPlan().toString().splitlines()
    last_array = max(i for i, line in enumerate(lines) if "collect_list" in line)
    first_move = min(i for i, line in enumerate(lines) if "Exchange hashpartitioning(numverba" in line)
    assert last_array < first_move
