"""Every registered query against DuckDB, and the promised order of its rows."""

import pytest

import __spark_entry__ as entry
from compare import differences, duck
from starloom.plans import catalog, customers, trends
from starloom.plans.star import StoredStar
from starloom.plans.warehouse import open_warehouse
from starloom.sources.snapshot import SnapshotStore

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in entry.queries().items() if name in catalog.QUERIES}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLE[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 80 and df.columns[0] == "month_start"


@pytest.mark.parametrize(
    "name, keys",
    [
        ("monthly_trend", ["month_start"]),
        ("product_rank", ["revenue_rank", "product_id"]),
        ("rank_movement", ["month_start", "rank_this_month", "product_id"]),
        ("abc_revenue", ["-revenue", "product_id"]),
        ("customer_pareto", ["-total_revenue", "customer_id"]),
        ("rfm", ["-r_score", "-f_score", "-m_score", "customer_id"]),
        ("basket_category", ["-lift", "item_a", "item_b"]),
        ("basket_sizes", ["items_in_basket"]),
        ("category_margin", ["-rank_gap", "-net_revenue", "category"]),
        ("validate_report", ["ord"]),
    ],
)
def test_rows_come_in_order(spark, name, keys):
    def place(row):
        return tuple(-row[k[1:]] if k.startswith("-") else row[k] for k in keys)

    places = [place(r) for r in QUERIES[name](spark, FOLDER).collect()]
    assert places == sorted(places)


def test_rollup_puts_subtotals_first_and_the_total_last(spark):
    rows = QUERIES["category_rollup"](spark, FOLDER).collect()
    assert (rows[-1].parent_category, rows[-1].category) == ("ALL_CATEGORIES", "subtotal")
    assert rows[0].category == "subtotal" and rows[0].is_grand_total == 0
    assert sum(r.net_revenue for r in rows[:-1] if r.is_subtotal) == pytest.approx(rows[-1].net_revenue)


def test_published_star_gives_the_same_results(spark, tmp_path):
    w = open_warehouse(spark, FOLDER)
    store = SnapshotStore(spark, str(tmp_path / "store"))
    w.publish(store)
    assert store.tables() == sorted(w.star())
    stored = StoredStar(store)
    assert trends.monthly_trend(stored).collect() == trends.monthly_trend(w).collect()
    assert customers.cohort_triangle(stored).collect() == customers.cohort_triangle(w).collect()
