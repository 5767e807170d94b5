"""Every registered query that has a statement, against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from plain import FOLDER, duck, fetched
from starloom.llm.queries import QUERIES
from starloom.llm.statements import STATEMENTS


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_statement(spark, name):
    columns, want = fetched(duck(), STATEMENTS[name])
    rows = entry.queries()[name](spark, FOLDER)
    assert sorted(rows.columns) == sorted(columns)
    got = [tuple(r[c] for c in columns) for r in rows.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(STATEMENTS) <= set(entry.oracle_sql())
