"""Orders of any year are on the calendar and in every total."""

from datetime import date
from types import SimpleNamespace

import duckdb
import pytest

from compare import TABLES
from starloom.operators.dimensions import build_dim_date
from starloom.plans import pareto, trends, validation
from starloom.plans.warehouse import Warehouse

FOLDER = "/root/testdata/sf0.001"
LATER = "replace(if(r % 10 = 3, o_orderdate + interval 3 year, o_orderdate) as o_orderdate)"


@pytest.fixture(scope="module")
def later(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("later")
    con = duckdb.connect()
    for t in TABLES:
        rows = f"(select *, row_number() over () as r from '{FOLDER}/{t}.parquet')"
        damage = LATER if t == "orders" else ""
        con.sql(f"copy (select * exclude (r) {damage} from {rows}) to '{folder}/{t}.parquet' (format parquet)")
    return Warehouse(spark, str(folder))


def test_calendar_reaches_the_last_order(later):
    assert [d.year for d in later.calendar] == [1995, 2004]
    assert validation.check_dim_date(later, later.source(), *later.calendar).where("expected != actual").count() == 0


def test_totals_agree(later):
    total = lambda df, column: df.agg({column: "sum"}).first()[0]
    revenue = total(trends.category_monthly(later), "category_revenue")
    assert total(trends.monthly_trend(later), "net_revenue") == revenue
    assert total(pareto.product_abc(later, "revenue"), "revenue") == revenue
    assert total(pareto.daily_pareto(later), "revenue") == revenue
    assert total(pareto.monthly_pareto(later), "revenue") == revenue


def test_one_year_is_a_calendar(spark, later):
    start, end = date(1999, 1, 1), date(1999, 12, 31)
    star = SimpleNamespace(dim_date=build_dim_date(spark, start, end))
    source = {"orders": later.orders.where("year(order_date) = 1999")}
    assert validation.check_dim_date(star, source, start, end).where("expected != actual").count() == 0
