import pytest

from starloom.functions.labels import ABC_LABELS
from starloom.operators.ordering import rank_few_rows, rank_rows
from starloom.operators.pareto import abc_class


@pytest.mark.parametrize(
    "values, classes",
    [
        ([80, 12, 8], "ABC"),
        ([90, 10], "BC"),  # the item that crosses 80 % is B already
        ([80, 10, 10], "ACC"),  # equal values share the total of 100
        ([100], "C"),
    ],
)
@pytest.mark.parametrize("distributed", [True, False])
def test_crossing_and_ties(spark, scratch, values, classes, distributed):
    df = spark.createDataFrame(list(enumerate(values)), "id long, v long")
    ranked = (
        rank_rows(df, "v", ties=["id"], scratch=scratch)
        if distributed
        else rank_few_rows(df, "v", ties=["id"])
    )
    got = ranked.select(
        "row_number", abc_class("running_total", "group_total", ABC_LABELS).alias("c")
    ).orderBy("row_number")
    assert "".join(r.c for r in got.collect()) == classes
