"""Queries that lay out all orders: statuses and years far apart."""

import datetime
from types import SimpleNamespace

from millrace.plans import catalog_versions as cv


def tables(spark):
    when = [datetime.datetime(y, m, 5) for y in (1988, 1994, 1997, 2012) for m in (1, 12)]
    orders = [(i, i % 2 + 1, status, d, "1-URGENT", 10.5) for i, (status, d) in enumerate((s, d) for s in "FOP" for d in when)]
    return SimpleNamespace(
        orders=spark.createDataFrame(orders, "o_orderkey int, o_custkey int, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string, o_totalprice double"),
        customer=spark.createDataFrame([(1, 7), (2, 8)], "c_custkey int, c_nationkey int"),
    )


def test_sheet_blocks_hold_every_status_and_year(spark):
    t = tables(spark)
    got = sorted(tuple(r) for r in cv.sheet_blocks_of_all_statuses(t).collect())
    nation = {1: 7, 2: 8}
    assert got == sorted((nation[r["o_custkey"]], f"Status {r['o_orderstatus']}", str(r["o_orderdate"].year), f"M{r['o_orderdate'].month}", "1") for r in t.orders.collect())


def test_wide_months_hold_every_year(spark):
    got = sorted(tuple(r) for r in cv.wide_months_of_all_years(tables(spark)).collect())
    assert got == [("1-URGENT", datetime.date(y, m, 1), 31.5) for y in (1988, 1994, 1997, 2012) for m in (1, 12)]
