"""Exact selection by histograms against sorted lists."""

from decimal import Decimal
from statistics import median as middle

import pytest
from pyspark.sql import functions as F

from starloom.operators.selection import median, select_ranks, sum_of_largest


def values_of(df):
    return sorted(r.v for r in df.filter("v IS NOT NULL").collect())


# Half of the rows share one value; the others lie far apart, on both sides of zero, with NULL among them.
def wide(spark):
    noise = (F.col("id") * 7_919_000_003) % 10_000_000_019 - 5_000_000_000
    v = F.when(F.col("id") % 2 == 0, 12).when(F.col("id") % 31 == 0, None).otherwise(noise)
    return spark.range(0, 801, 1, 7).select(v.cast("decimal(28,2)").alias("v"))


def test_every_rank_equals_the_sorted_list(spark):
    df = wide(spark)
    want = values_of(df)
    ranks = [0, 1, 100, len(want) // 2, len(want) - 2, len(want) - 1]
    got = select_ranks(df, "v", lambda n: ranks)
    assert [g.rank for g in got] == ranks
    for g in got:
        larger = [v for v in want if v > want[g.rank]]
        assert (g.value, g.larger_rows, g.larger_sum, g.rows) == (want[g.rank], len(larger), sum(larger), len(want))


@pytest.mark.parametrize("kind", ["int", "bigint", "decimal(20,3)"])
def test_small_and_equal_values(spark, kind):
    for values in ([5], [3, 3, 3], [1, 2], [-4, 0, 4, 4, 9], list(range(-700, 900))):
        df = spark.createDataFrame([(v,) for v in values], "v int").select(F.col("v").cast(kind).alias("v"))
        assert [int(s.value) for s in select_ranks(df, "v", lambda n: range(min(n, 5)))] == sorted(values)[:5]
        assert median(df, "v") == middle(values)
        assert sum_of_largest(df, "v", lambda n: n // 2) == (sum(sorted(values)[-(len(values) // 2) :]) if values[1:] else None)


def test_the_widest_range(spark):
    low, high = -(2**62), 2**62 - 1
    df = spark.createDataFrame([(low,), (0,), (high,)], "v bigint")
    assert [s.value for s in select_ranks(df, "v", range)] == [low, 0, high]
    with pytest.raises(ValueError):
        select_ranks(spark.createDataFrame([(-(2**63),), (2**63 - 1,)], "v bigint"), "v", range)


def test_nulls_come_last_and_empty_tables_have_no_value(spark):
    df = spark.createDataFrame([(None,), (2,), (None,), (7,), (None,)], "v bigint")
    assert sum_of_largest(df, "v", lambda n: n - 1) == 9
    assert sum_of_largest(df, "v", lambda n: 1) == 7
    for empty in (df.filter("false"), df.filter("v IS NULL")):
        assert sum_of_largest(empty, "v", lambda n: n) is None
        assert median(empty, "v") is None
        assert select_ranks(empty, "v", lambda n: []) == []


def test_refusals(spark):
    df = spark.createDataFrame([(1,)], "v bigint")
    with pytest.raises(TypeError):
        select_ranks(df.select(F.col("v").cast("double").alias("v")), "v", lambda n: [0])
    with pytest.raises(ValueError):
        select_ranks(df, "v", lambda n: [1])


def test_large_decimals_keep_every_digit(spark):
    text = "123456789012345678901234567890.12"
    df = spark.sql(f"SELECT explode(array({text}BD, {text}BD - 1, {text}BD - 3)) AS v")
    assert sum_of_largest(df, "v", lambda n: 2) == Decimal("246913578024691357802469135779.24")
