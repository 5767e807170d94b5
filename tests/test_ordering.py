"""Distributed order operators against the plain Spark windows."""

from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from starloom.operators.ordering import ntile, number_rows, rank_measures, rank_rows


def plain(df, value, by, ties, descending):
    order = F.desc(value) if descending else F.asc(value)
    group = Window.partitionBy(*by)
    return df.select(
        *df.columns,
        F.row_number().over(group.orderBy(order, *ties)).alias("row_number"),
        F.rank().over(group.orderBy(order)).alias("rank"),
        F.sum(value).over(group.orderBy(order)).alias("running_total"),
        F.sum(value).over(group).alias("group_total"),
        F.count("*").over(group).alias("group_rows"),
    )


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# A third of the rows share one value, so this value spans several splits.
def skewed(spark, n=900):
    return spark.range(n).select(
        F.col("id"),
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 10 < 4, 7)
        .otherwise((F.col("id") * 7919) % 41 - 5)
        .cast("decimal(12,2)")
        .alias("v"),
    )


@pytest.mark.parametrize("by", [(), ("g",)])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_rows_equals_plain_window(spark, scratch, by, descending):
    df = skewed(spark)
    got = rank_rows(df, "v", by=by, ties=["id"], descending=descending, scratch=scratch)
    want = plain(df, "v", by, ["id"], descending)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


@pytest.mark.parametrize("by", [(), ("g",)])
@pytest.mark.parametrize("descending", [True, False])
def test_null_groups_and_null_values(spark, scratch, by, descending):
    df = spark.range(400).select(
        F.col("id"),
        F.when(F.col("id") % 4 < 3, F.col("id") % 4).alias("g"),
        F.when((F.col("id") % 2 == 0) & (F.col("id") % 4 != 2), (F.col("id") * 31) % 17).alias("v"),
    )
    got = rank_rows(df, "v", by=by, ties=["id"], descending=descending, scratch=scratch)
    key = lambda r: r[0]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(
        map(tuple, plain(df, "v", by, ["id"], descending).collect()), key=key
    )


def test_measures_finer_than_cents_keep_their_order(spark, scratch):
    df = spark.createDataFrame([(1, Decimal("1.001"), 5), (2, Decimal("1.004"), 2**40)], "id long, a decimal(9,3), b long")
    got = rank_measures(df, ["id"], {"a": ("a", True), "b": ("b", False)}, scratch=scratch, keep=["rank", "value"])
    assert sorted(map(tuple, got.select("id", "a_rank", "a_value", "b_rank", "b_value").collect())) == [
        (1, 2, Decimal("1.001"), 1, 5), (2, 1, Decimal("1.004"), 2, 2**40)
    ]
    with pytest.raises(TypeError):
        rank_measures(df.withColumn("a", F.col("a").cast("double")), ["id"], {"a": ("a", True)}, scratch=scratch, keep=["rank"])


def test_one_value_everywhere(spark, scratch):
    df = spark.range(200).withColumn("v", F.lit(Decimal("1.50")))
    got = rank_rows(df, "v", ties=["id"], scratch=scratch)
    assert rows(got) == rows(plain(df, "v", (), ["id"], True))
    assert {r.rank for r in got.collect()} == {1}


def test_ties_share_the_running_total(spark, scratch):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 1)], "id long, v long")
    got = rank_rows(df, "v", ties=["id"], scratch=scratch).orderBy("row_number").collect()
    assert [r.running_total for r in got] == [10, 10, 11]
    assert [r.rank for r in got] == [1, 1, 3]


@pytest.mark.parametrize("n", [1, 3, 5, 7, 23, 1000])
def test_ntile_formula(spark, n):
    w = Window.orderBy("id")
    df = spark.range(n).select(
        F.ntile(5).over(w).alias("want"),
        ntile(F.row_number().over(w), F.lit(n), 5).alias("got"),
    )
    assert df.filter("want <> got").count() == 0


def test_rank_measures_orders_every_measure(spark, scratch):
    df = skewed(spark).select("id", F.col("v").alias("a"), (F.col("id") % 17).alias("b"))
    got = rank_measures(
        df,
        ["id"],
        {"hi": ("a", True), "lo": ("b", False)},
        scratch=scratch,
        keep=["row_number", "rank", "running_total", "group_rows"],
    )
    want = df.select(
        "id",
        F.row_number().over(Window.orderBy(F.desc("a"), "id")),
        F.rank().over(Window.orderBy(F.desc("a"))),
        F.sum("a").over(Window.orderBy(F.desc("a"))),
        F.row_number().over(Window.orderBy("b", "id")),
        F.rank().over(Window.orderBy("b")),
        F.sum("b").over(Window.orderBy("b")),
    )
    assert rows(
        got.select(
            "id", "hi_row_number", "hi_rank", "hi_running_total",
            "lo_row_number", "lo_rank", "lo_running_total",
        )
    ) == rows(want)
    assert got.filter("hi_group_rows <> 900 or lo_group_rows <> 900").count() == 0


def test_number_rows_is_dense_and_ordered(spark, scratch):
    df = spark.range(1000).select((F.lit(5000) - F.col("id")).alias("k"), F.lit("x").alias("t"))
    got = number_rows(df, "key", ["k"], scratch=scratch, start=10).orderBy("k").collect()
    assert [r.key for r in got] == list(range(11, 1011))
