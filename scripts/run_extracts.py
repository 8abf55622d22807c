"""Write the extract files (CSV reports) and the star schema (Parquet) in one run.

usage:
  python scripts/run_extracts.py --out OUT_DIR (--erp-root ERP_PARQUET_ROOT | --driver-dir SF_DIR)
         [--as-of 2000-07-01] [--revenue-from 2000-11-01 --revenue-to 2000-11-30] [--order-day 2000-12-09]
         [--expiry-from 2000-01-01 --expiry-to 2000-08-31] [--stock-year 2000] [--returns-min-year 1998]
         [--sales-since 2000-01-01] [--orders-since 2001-01-01] [--receivables-since 2000-01-01]
         [--only name ...] [--no-star]

``--erp-root`` reads the ERP relations from a Parquet landing zone (one folder
per relation); ``--driver-dir`` derives them from the driver tables (tests).
On a cluster, submit with spark-submit; the session settings come from there.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tradeflow.plans import catalog, jobs  # noqa: E402
from tradeflow.session import build_session  # noqa: E402
from tradeflow.sources.erp_fixture import ErpTables  # noqa: E402
from tradeflow.sources.erp_tables import ErpParquetTables  # noqa: E402


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def main(argv: list[str]) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--erp-root")
    src.add_argument("--driver-dir")
    ap.add_argument("--out", required=True)
    ap.add_argument("--master", default=None)
    ap.add_argument("--as-of", type=_date, default=catalog.STOCK_AS_OF)
    ap.add_argument("--revenue-from", type=_date, default=catalog.REVENUE_WINDOW[0])
    ap.add_argument("--revenue-to", type=_date, default=catalog.REVENUE_WINDOW[1])
    ap.add_argument("--order-day", type=_date, default=catalog.ORDER_DAY)
    ap.add_argument("--expiry-from", type=_date, default=catalog.EXPIRY_WINDOW[0])
    ap.add_argument("--expiry-to", type=_date, default=catalog.EXPIRY_WINDOW[1])
    ap.add_argument("--stock-year", type=int, default=catalog.STOCK_YEAR)
    ap.add_argument("--returns-min-year", type=int, default=catalog.RETURNS_MIN_YEAR)
    ap.add_argument("--sales-since", type=_date, default=catalog.SALES_SINCE)
    ap.add_argument("--orders-since", type=_date, default=catalog.ORDERS_SINCE)
    ap.add_argument("--receivables-since", type=_date, default=catalog.RECEIVABLES_SINCE)
    ap.add_argument("--only", nargs="*", default=None, help="extract names to write (default: all)")
    ap.add_argument("--no-star", action="store_true", help="skip the star-schema export")
    a = ap.parse_args(argv[1:])

    spark = build_session(a.master)
    tables = ErpParquetTables(spark, a.erp_root) if a.erp_root else ErpTables(spark, a.driver_dir)
    params = jobs.ExtractParams(as_of=a.as_of, revenue_window=(a.revenue_from, a.revenue_to), order_day=a.order_day,
                                expiry_window=(a.expiry_from, a.expiry_to), stock_year=a.stock_year,
                                returns_min_year=a.returns_min_year, sales_since=a.sales_since,
                                orders_since=a.orders_since, receivables_since=a.receivables_since)
    written = jobs.run_extracts(tables, f"{a.out.rstrip('/')}/extracts", params, names=a.only)
    if not a.no_star:
        written.update({f"star/{k}": v for k, v in
                        jobs.run_star_schema(tables, f"{a.out.rstrip('/')}/star", params).items()})
    print(json.dumps(written, indent=1))


if __name__ == "__main__":
    main(sys.argv)
