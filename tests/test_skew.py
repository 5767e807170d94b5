"""The same queries on data with a hot product, a hot customer and a hot order."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, differences, duck

FOLDER = "/root/testdata/sf0.001"
HOT = {
    # A third of the lines are one product, a tenth belong to one order.
    "lineitem": "replace(if(r % 3 = 0, 7, l_partkey) as l_partkey, "
    "if(r % 10 = 1, 11, l_orderkey) as l_orderkey)",
    "orders": "replace(if(r % 3 = 0, 5, o_custkey) as o_custkey)",
}
NAMES = [
    "fact_sales", "product_rank", "rank_movement", "sales_gaps", "abc_revenue", "abc_movement",
    "customer_pareto", "rfm", "cohort_long", "category_rollup", "basket_category",
    "basket_sizes", "validate_fact",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for t in TABLES:
        rows = f"(select *, row_number() over () as r from '{FOLDER}/{t}.parquet')"
        con.sql(
            f"copy (select * exclude (r) {HOT.get(t, '')} from {rows}) "
            f"to '{folder}/{t}.parquet' (format parquet)"
        )
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(spark, skewed, name):
    query, sql = entry.queries()[name], entry.oracle_sql()[name]
    assert differences(query(spark, skewed), duck(skewed), sql) == []
