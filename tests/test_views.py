"""Multi-view entry points over a stored base give the same rows as the
independent queries."""

import __spark_entry__ as entry
from tests.conftest import SMALL_SF
from tests.harness import canonical_rows
from tradeflow.plans import customers, funds
from tradeflow.plans.catalog import (CUR_YEAR, FUND_AS_OF, FUND_FROM_YEAR, LIFECYCLE_SINCE, MATRIX_YEARS,
                                     PREV_YEAR)
from tradeflow.plans.common import decimals_to_double
from tradeflow.sources.erp_fixture import ErpTables


def _rows(df):
    df = decimals_to_double(df)
    return canonical_rows(df.columns, [tuple(r) for r in df.collect()])


def test_lifecycle_views_match_queries(spark):
    views = customers.lifecycle_views(ErpTables(spark, SMALL_SF), LIFECYCLE_SINCE, PREV_YEAR, CUR_YEAR, MATRIX_YEARS)
    q = entry.queries()
    for name, df in views.items():
        if name == "item_months":                       # a map here, a text in the query
            assert df.count() == q[name](spark, SMALL_SF).count()
        else:
            assert _rows(df) == _rows(q[name](spark, SMALL_SF)), name


def test_fund_dashboard_matches_queries(spark):
    views = funds.fund_dashboard(ErpTables(spark, SMALL_SF), FUND_AS_OF, FUND_FROM_YEAR)
    q = entry.queries()
    for name, df in views.items():
        assert _rows(df) == _rows(q[name](spark, SMALL_SF)), name
