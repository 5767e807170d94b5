"""What the constraint check makes of each row, and of each value that breaks nothing."""

import re

from starloom.operators.checks import constraint_report, violating_values
from starloom.sources.contracts import Column, ForeignKey, TableContract

CONTRACTS = {
    "parent": TableContract("parent", (Column("id", "bigint", required=True), Column("name", "string", length=3)), "id"),
    "child": TableContract(
        "child",
        (Column("child_id", "bigint", required=True), Column("id", "bigint"), Column("n", "int")),
        "child_id",
        unique=(("id", "n"),),
        foreign=(ForeignKey("id", "parent", "id"),),
        checks=("n > 0",),
    ),
}


def tables(spark):
    parent = [(1, "a"), (2, "long name"), (2, None), (None, "too long"), (3, "c")]
    child = [(1, 1, 1), (2, 9, 0), (2, 9, -1), (None, None, 1), (3, 1, 1), (4, 3, None), (5, 8, 2)]
    return {
        "parent": spark.createDataFrame(parent, "id bigint, name string"),
        "child": spark.createDataFrame(child, "child_id bigint, id bigint, n int"),
    }


def test_sound_and_broken_rows(spark):
    found = {(r.table_name, r.rule): r.violations for r in constraint_report(tables(spark), CONTRACTS).collect()}
    assert found == {
        ("parent", "not null id"): 1,
        ("parent", "length name <= 3"): 2,
        ("parent", "unique id"): 1,
        ("child", "not null child_id"): 1,
        ("child", "check n > 0"): 2,
        ("child", "unique child_id"): 1,
        ("child", "unique id, n"): 1,
        ("child", "id in parent"): 3,
    }


def test_no_row_passes_an_interpreted_filter(spark, capsys):
    bad, _ = violating_values(tables(spark), CONTRACTS)
    bad.explain()
    lines = capsys.readouterr().out.splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(domain" in line)
    assert not any("lambda" in line for line in lines[exchange:])
    # Sound values go by a compiled condition, before the list of what they break is made.
    above = [line for line in lines[:exchange] if "Filter" in line]
    assert above and re.search(r"n0#\d+L > 1\) OR", above[-1].split("size(")[0])
