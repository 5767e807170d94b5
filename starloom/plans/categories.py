"""Category tree reports, cancellations and key attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from starloom.functions import labels
from starloom.functions.exprs import pct
from starloom.plans.star import Star, sales

LEVELS = ("parent_category_name", "category_name")


def category_rollup(star: Star) -> DataFrame:
    """Leaf categories, subtotals per parent, and the grand total.

    Added up from monthly partials; each level has a count of orders of its own there.
    """
    level = F.grouping_id()
    rolled = star.month_partials.rollup(*LEVELS).agg(
        F.grouping(LEVELS[0]).cast("int").alias("is_grand_total"),
        F.grouping(LEVELS[1]).cast("int").alias("is_subtotal"),
        F.sum("net").alias("net_revenue"),
        F.sum("profit").alias("profit"),
        F.sum("quantity").alias("units"),
        F.when(level == 0, F.sum("category_orders"))
        .when(level == 1, F.sum("parent_orders"))
        .otherwise(F.sum("orders"))
        .alias("orders"),
    )
    return (
        rolled.orderBy(
            "is_grand_total", LEVELS[0], F.desc("is_subtotal"), F.desc("net_revenue"), LEVELS[1]
        )
        .select(
            F.coalesce(LEVELS[0], F.lit(labels.ROLLUP_ALL)).alias("parent_category"),
            F.coalesce(LEVELS[1], F.lit(labels.ROLLUP_SUBTOTAL)).alias("category"),
            "is_grand_total",
            "is_subtotal",
            "net_revenue",
            "profit",
            "units",
            "orders",
        )
    )


def category_margin(star: Star) -> DataFrame:
    """Margin and discount per leaf category, and how far its two ranks are apart."""
    per_product = sales(star).groupBy("product_key").agg(
        F.sum("net_amount").alias("net"),
        F.sum("profit_amount").alias("profit"),
        F.sum("gross_amount").alias("gross"),
    )
    totals = (
        per_product.join(star.dim_product.select("product_key", *LEVELS), "product_key")
        .groupBy(*[F.col(c).alias(n) for c, n in zip(LEVELS, ("parent_category", "category"))])
        .agg(
            F.sum("net").alias("net_revenue"),
            F.sum("profit").alias("profit"),
            F.sum("gross").alias("_gross"),
        )
    )
    # One row per leaf of the category tree.
    by_revenue = F.rank().over(Window.orderBy(F.desc("net_revenue")))
    by_profit = F.rank().over(Window.orderBy(F.desc("profit")))
    return (
        totals.withColumns({"revenue_rank": by_revenue, "profit_rank": by_profit})
        .select(
            "parent_category",
            "category",
            "net_revenue",
            "profit",
            pct("profit", "net_revenue").alias("margin_pct"),
            pct("_gross - net_revenue", "_gross").alias("discount_pct"),
            "revenue_rank",
            "profit_rank",
            (F.col("profit_rank") - F.col("revenue_rank")).alias("rank_gap"),
        )
        .orderBy(F.desc("rank_gap"), F.desc("net_revenue"), "category")
    )


def cancellation(star: Star) -> DataFrame:
    """Cancelled orders, and by how much revenue is overstated if they are kept."""
    # One row per order first: both order counts are then plain counts.
    per_order = star.fact_sales.groupBy("order_id", "order_status").agg(
        F.count("*").alias("n"), F.sum("net_amount").alias("net")
    )
    gone = F.col("order_status") == labels.CANCELLED
    totals = per_order.agg(
        F.sum("n").alias("lines"),
        F.sum(F.when(gone, F.col("n")).otherwise(0)).alias("cancelled_lines"),
        F.count("*").alias("orders"),
        F.count(F.when(gone, 1)).alias("cancelled_orders"),
        F.sum("net").alias("revenue_with_cancelled"),
        F.sum(F.when(gone, F.col("net"))).alias("overstatement"),
    )
    return totals.select(
        "*",
        pct("cancelled_orders", "orders", 2).alias("cancelled_order_pct"),
        pct("overstatement", "revenue_with_cancelled", 2).alias("overstatement_pct"),
    )


def key_attribution(star: Star) -> DataFrame:
    """Fact rows on the unknown employee, and rows on superseded customer versions."""
    unknown = F.col("employee_key") == labels.UNKNOWN_EMPLOYEE_KEY
    per_version = star.fact_sales.groupBy("customer_key").agg(
        F.count("*").alias("n"),
        F.count(F.when(unknown, 1)).alias("unknown"),
        F.count(F.when(unknown & (F.col("channel") == labels.ONLINE), 1)).alias("unknown_online"),
    )
    versions = star.dim_customer.select("customer_key", "is_current")
    old = ~F.col("is_current")
    return per_version.join(versions, "customer_key").agg(
        F.sum("n").alias("fact_rows"),
        F.sum("unknown").alias("unknown_employee_rows"),
        F.sum("unknown_online").alias("unknown_employee_online_rows"),
        F.sum(F.when(old, F.col("n")).otherwise(0)).alias("superseded_version_rows"),
        F.count(F.when(old, 1)).alias("superseded_versions_in_use"),
    )
