from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from starloom.functions import calendar, exprs
from starloom.operators.dimensions import build_dim_date


def test_rounded_ratio_is_exact(spark):
    # The quotient of the third row is below a tie by less than any fixed scale shows.
    cases = [
        ("1", "3", 2, "0.33"),
        ("201", "200", 2, "1.01"),
        ("499999999999999999", "1000000000000000000", 0, "0"),
        ("-5", "1000", 2, "-0.01"),
        ("-1", "1000", 2, "0.00"),
        ("7", "-2", 0, "-4"),
    ]
    for num, den, digits, want in cases:
        got = spark.range(1).select(
            exprs.rounded_ratio(f"{num}BD", f"{den}BD", digits)
        ).first()[0]
        assert got == Decimal(want), (num, den, got)


def test_zero_divisor_is_null(spark):
    row = spark.range(1).select(
        exprs.pct("1", "0"), exprs.growth_pct("5", "CAST(NULL AS int)")
    ).first()
    assert tuple(row) == (None, None)


def test_change_test_treats_null_as_a_value(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "p", None), (3, None, None)], "k int, a string, b string")
    b = spark.createDataFrame([(1, "q", "x"), (2, "p", None), (3, None, "y")], "k int, a string, b string")
    df = a.alias("l").join(b.alias("r"), F.col("l.k") == F.col("r.k"))
    got = df.select("l.k", exprs.any_changed("l", "r", ["a", "b"]).alias("c")).orderBy("k").collect()
    assert [r.c for r in got] == [True, False, True]


def test_fiscal_boundaries(spark):
    days = [(2025, 7, 16), (2025, 7, 17), (2025, 10, 16), (2025, 10, 17), (2026, 1, 16),
            (2026, 1, 17), (2026, 4, 16), (2026, 4, 17), (2026, 7, 16)]
    df = spark.createDataFrame([(date(*d),) for d in days], "d date")
    got = df.select(calendar.fiscal_year(F.col("d")), calendar.fiscal_quarter(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [
        (2024, 4), (2025, 1), (2025, 1), (2025, 2), (2025, 2), (2025, 3), (2025, 3), (2025, 4),
        (2025, 4),
    ]


def test_leap_years(spark):
    df = spark.createDataFrame([(1900,), (2000,), (2023,), (2024,), (2100,)], "y int")
    got = [r[0] for r in df.select(calendar.leap_year(F.col("y"))).collect()]
    assert got == [False, True, False, True, False]


def test_dim_date_row(spark):
    df = build_dim_date(spark, date(2023, 12, 31), date(2024, 3, 1))
    assert df.count() == 62
    row = df.filter("date_key = 20240229").first().asDict()
    assert row == {
        "date_key": 20240229, "full_date": date(2024, 2, 29), "year": 2024, "quarter": 1,
        "month": 2, "day": 29, "month_name": "February", "day_name": "Thursday",
        "day_of_week": 4, "day_of_year": 60, "week_of_year": 9, "is_weekend": False,
        "is_leap_year": True, "fiscal_year": 2023, "fiscal_quarter": 3,
    }


def test_whole_months(spark):
    df = spark.createDataFrame([(date(2024, 2, 1), date(2022, 11, 1))], "a date, b date")
    assert df.select(exprs.whole_months(F.col("a"), F.col("b"))).first()[0] == 15
