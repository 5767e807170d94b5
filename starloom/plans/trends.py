"""Revenue over time."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from starloom.functions.exprs import growth_pct, month_of, pct, rounded_ratio
from starloom.operators.facts import MONTH
from starloom.plans.star import Star, day_of_key, month_of_key, month_of_month_key, sales

# Windows over all months or years are bounded by the calendar.


def monthly_trend(star: Star) -> DataFrame:
    """Measures per month with year-to-date totals, growth and a moving average."""
    months = star.dim_date.select(month_of(F.col("full_date")).alias("month_start"), "month_name", "year").distinct()
    monthly = (
        star.month_partials.groupBy(month_of_month_key(F.col(MONTH)).alias("month_start"))
        .agg(
            F.sum("net").alias("net_revenue"),
            F.sum("gross").alias("gross_revenue"),
            F.sum("orders").alias("orders"),
            F.sum("quantity").alias("quantity"),
            F.sum("profit").alias("profit"),
        )
        .join(months, "month_start")
    )
    to_date = Window.partitionBy("year").orderBy("month_start")
    before, year_ago = (f"lag(net_revenue, {n}) OVER (ORDER BY month_start)" for n in (1, 12))
    last_three = "OVER (ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    return monthly.select(
        "month_start",
        "month_name",
        "year",
        "net_revenue",
        "gross_revenue",
        "orders",
        "quantity",
        rounded_ratio("net_revenue", "orders", 2).alias("avg_order_value"),
        "profit",
        pct("profit", "net_revenue").alias("profit_margin_pct"),
        pct("gross_revenue - net_revenue", "gross_revenue").alias("discount_pct"),
        F.sum("net_revenue").over(to_date).alias("ytd_revenue"),
        F.sum("profit").over(to_date).alias("ytd_profit"),
        F.sum("orders").over(to_date).alias("ytd_orders"),
        growth_pct("net_revenue", before).alias("mom_pct"),
        growth_pct("net_revenue", year_ago).alias("yoy_pct"),
        rounded_ratio(
            f"sum(net_revenue) {last_three}", f"count(net_revenue) {last_three}", 2
        ).alias("moving_avg_3mo"),
    ).orderBy("month_start")


def same_store_sales(star: Star, as_of: date) -> DataFrame:
    """Monthly revenue of stores that had been open for 12 months at ``as_of``."""
    settled = star.dim_store.filter(F.col("opened_date") <= F.add_months(F.lit(as_of), -12))
    per_store = (
        sales(star)
        .groupBy("date_key", "store_key")
        .agg(F.sum("net_amount").alias("net"))
        .join(settled.select("store_key"), "store_key", "left_semi")
    )
    monthly = per_store.groupBy(month_of_key(F.col("date_key")).alias("month_start")).agg(
        F.sum("net").alias("comp_revenue"),
        F.countDistinct("store_key").alias("comp_store_count"),
    )
    year_ago = "lag(comp_revenue, 12) OVER (ORDER BY month_start)"
    return monthly.select(
        "*",
        F.expr(year_ago).alias("comp_revenue_ly"),
        growth_pct("comp_revenue", year_ago).alias("sss_growth_pct"),
    ).orderBy("month_start")


def category_monthly(star: Star) -> DataFrame:
    path = ["category_name", "parent_category_name", "category_path"]
    return (
        star.month_partials.groupBy(month_of_month_key(F.col(MONTH)).alias("month_start"), *path)
        .agg(
            F.sum("net").alias("category_revenue"),
            F.sum("profit").alias("category_profit"),
            F.sum("quantity").alias("category_units"),
            F.sum("path_orders").alias("category_orders"),
        )
        .orderBy("month_start", F.desc("category_revenue"), "category_path")
    )


def _annual_growth(end, start, years):
    ratio = end.cast("double") / F.nullif(start.cast("double"), F.lit(0.0))
    exponent = F.lit(1.0) / F.nullif(years, F.lit(0))
    return F.round((F.pow(ratio, exponent) - 1) * 100, 2)


def cagr(star: Star) -> DataFrame:
    """Growth per year between the first and the last calendar year."""
    annual = (
        sales(star)
        .groupBy(F.year(day_of_key(F.col("date_key"))).alias("year"))
        .agg(F.sum("net_amount").alias("revenue"))
    )
    bounds = annual.agg(
        F.min("year").alias("start_year"),
        F.max("year").alias("end_year"),
        F.min_by("revenue", "year").alias("start_revenue"),
        F.max_by("revenue", "year").alias("end_revenue"),
    ).withColumn("num_years", F.col("end_year") - F.col("start_year"))
    return bounds.withColumn(
        "cagr_pct",
        _annual_growth(F.col("end_revenue"), F.col("start_revenue"), F.col("num_years")),
    )


def cagr_ttm(star: Star) -> DataFrame:
    """Growth per year between two full twelve-month windows.

    The later window ends with the last complete month, the earlier one lies whole
    years before it, as far back as complete months reach.
    """
    daily = (
        sales(star)
        .groupBy("date_key")
        .agg(F.sum("net_amount").alias("net"))
        .select(day_of_key(F.col("date_key")).alias("day"), "net")
    )
    first, last = F.min("day"), F.max("day")
    span = daily.agg(
        F.when(F.dayofmonth(first) == 1, first)
        .otherwise(F.add_months(F.trunc(first, "month"), 1))
        .alias("first_month"),
        F.trunc(F.date_add(last, 1), "month").alias("end_to"),
    ).select(
        "end_to",
        F.floor(
            F.months_between("end_to", "first_month") / 12 - 1
        ).cast("int").alias("num_years"),
    )
    windows = span.select(
        F.add_months("end_to", F.col("num_years") * -12 - 12).alias("start_from"),
        F.add_months("end_to", F.col("num_years") * -12).alias("start_to"),
        F.add_months("end_to", -12).alias("end_from"),
        "end_to",
        "num_years",
    )

    # The bounds are one row, and one scalar subquery holds all of them.
    packed = windows.select(F.struct("*").alias("x")).scalar()
    daily = daily.withColumn("b", packed)
    bound = {c: F.col(f"b.{c}") for c in windows.columns}
    within = lambda a, b: F.when((F.col("day") >= a) & (F.col("day") < b), F.col("net"))
    df = daily.groupBy(*[bound[c].alias(c) for c in windows.columns]).agg(
        F.sum(within(bound["start_from"], bound["start_to"])).alias("start_revenue"),
        F.sum(within(bound["end_from"], bound["end_to"])).alias("end_revenue"),
    )
    return df.withColumn(
        "cagr_pct",
        _annual_growth(F.col("end_revenue"), F.col("start_revenue"), F.col("num_years")),
    )
