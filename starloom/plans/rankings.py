"""Product and brand rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from starloom.functions.exprs import rounded_ratio
from starloom.functions.labels import RANK_NEW
from starloom.operators.ordering import rank_measures, rank_rows
from starloom.plans.star import Star, day_of_key, month_of_key, sales


def _with_products(per_key: DataFrame, star: Star, *columns: str) -> DataFrame:
    """Attach product attributes to rows that are already aggregated per product."""
    return per_key.join(star.dim_product.select("product_key", *columns), "product_key")


def product_rank(star: Star) -> DataFrame:
    """Every product with its rank by revenue, profit and quantity."""
    totals = sales(star).groupBy("product_key").agg(
        F.sum("net_amount").alias("revenue"),
        F.sum("profit_amount").alias("profit"),
        F.sum("quantity").alias("quantity"),
    )
    ranked = rank_measures(
        totals,
        ["product_key"],
        {m: (m, True) for m in ("revenue", "profit", "quantity")},
        scratch=star.scratch,
        keep=["value", "rank"],
    )
    return (
        _with_products(ranked, star, "product_id", "name", "category_name")
        .select(
            "product_id",
            "name",
            "category_name",
            F.col("revenue_value").alias("total_revenue"),
            F.col("profit_value").alias("total_profit"),
            F.col("quantity_value").cast("long").alias("total_quantity_sold"),
            "revenue_rank",
            "profit_rank",
            "quantity_rank",
        )
        .orderBy("revenue_rank", "product_id")
    )


def _top_products(star: Star, products: DataFrame, k: int) -> DataFrame:
    revenue = sales(star).join(
        products.select("product_key"), "product_key", "left_semi"
    ).groupBy("product_key").agg(F.sum("net_amount").alias("revenue"))
    best = Window.partitionBy("brand").orderBy(F.desc("revenue"), "product_id")
    named = revenue.join(
        products.select("product_key", "brand", "category_name", "product_id", "name"),
        "product_key",
    )
    # The filter on the row number lets Spark drop all but k rows per brand before
    # the shuffle, so a brand with very many products does not fill one task.
    return (
        named.withColumn("rank_in_brand", F.row_number().over(best))
        .filter(F.col("rank_in_brand") <= k)
        .select("brand", "category_name", "product_id", "name", "revenue", "rank_in_brand")
    )


def brand_top(star: Star, brand: str, k: int = 5) -> DataFrame:
    """The k best products of one brand."""
    own = star.dim_product.filter(F.col("brand") == brand)
    return _top_products(star, own, k).orderBy("category_name", "rank_in_brand")


def top_per_brand(star: Star, k: int = 5) -> DataFrame:
    """The k best products of every brand."""
    return _top_products(star, star.dim_product, k).orderBy("brand", "rank_in_brand")


def top_brands_per_category(star: Star, k: int = 5) -> DataFrame:
    """Brands of rank k or better per category; ties can give more than k."""
    per_product = sales(star).groupBy("product_key").agg(
        F.sum("net_amount").alias("net"),
        F.sum("profit_amount").alias("profit"),
        F.sum("quantity").alias("quantity"),
    )
    # One product is one row here, so counting products needs no DISTINCT.
    per_brand = (
        _with_products(per_product, star, "category_name", "brand")
        .groupBy("category_name", "brand")
        .agg(
            F.sum("net").alias("brand_revenue"),
            F.sum("profit").alias("brand_profit"),
            F.sum("quantity").alias("brand_units"),
            F.count("*").alias("product_count"),
        )
    )
    best = Window.partitionBy("category_name").orderBy(F.desc("brand_revenue"))
    return (
        per_brand.withColumn("rank_in_category", F.rank().over(best))
        .filter(F.col("rank_in_category") <= k)
        .orderBy("category_name", "rank_in_category", "brand")
    )


def rank_movement(star: Star) -> DataFrame:
    """Rank of each product per month, beside its rank in the month before.

    The month before is the product's previous row if that row is one calendar month
    older, so one window over at most one row per month replaces a self join.
    """
    monthly = sales(star).groupBy(
        month_of_key(F.col("date_key")).alias("month_start"), "product_key"
    ).agg(F.sum("net_amount").alias("revenue"))
    ranked = rank_rows(
        monthly, "revenue", by=["month_start"], ties=["product_key"], scratch=star.scratch
    )
    history = Window.partitionBy("product_key").orderBy("month_start")
    adjacent = F.lag("month_start").over(history) == F.add_months("month_start", -1)
    moved = ranked.select(
        "product_key",
        "month_start",
        F.col("rank").alias("rank_this_month"),
        F.when(adjacent, F.lag("rank").over(history)).alias("rank_last_month"),
    )
    gained = F.col("rank_last_month") - F.col("rank_this_month")
    return (
        _with_products(moved, star, "product_id", "name")
        .select(
            "month_start",
            "product_id",
            "name",
            "rank_this_month",
            "rank_last_month",
            F.coalesce(gained.cast("string"), F.lit(RANK_NEW)).alias("rank_improvement"),
        )
        .orderBy("month_start", "rank_this_month", "product_id")
    )


def sales_gaps(star: Star) -> DataFrame:
    """Days between consecutive sale days of each product, ranked both ways.

    The first sale day has no gap and is not counted in ``sale_days``.
    """
    # After DISTINCT a product has at most one row per calendar day.
    days = sales(star).select("product_key", "date_key").distinct().select(
        "product_key", day_of_key(F.col("date_key")).alias("day")
    )
    previous = F.lag("day").over(Window.partitionBy("product_key").orderBy("day"))
    stats = (
        days.withColumn("gap", F.datediff("day", previous))
        .filter("gap IS NOT NULL")
        .groupBy("product_key")
        .agg(
            F.count("*").alias("days"),
            F.max("gap").alias("longest"),
            F.min("gap").alias("shortest"),
            F.sum("gap").alias("total"),
        )
    )
    ranked = rank_measures(
        stats,
        ["product_key"],
        {"longest": ("longest", True), "shortest": ("shortest", False)},
        scratch=star.scratch,
        keep=["value", "rank"],
        carry=["days", "total"],
    )
    return (
        _with_products(ranked, star, "product_id", "name", "category_name")
        .select(
            "product_id",
            "name",
            "category_name",
            F.col("days").alias("sale_days"),
            F.col("longest_value").cast("long").alias("longest_gap_days"),
            F.col("shortest_value").cast("long").alias("shortest_gap_days"),
            rounded_ratio("total", "days", 1).alias("avg_gap_days"),
            F.col("longest_rank").alias("longest_gap_rank"),
            F.col("shortest_rank").alias("shortest_gap_rank"),
        )
        .orderBy("longest_gap_rank", "product_id")
    )
