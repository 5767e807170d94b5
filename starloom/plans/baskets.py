"""What is bought together."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.functions.exprs import pct
from starloom.operators.baskets import PAIR_BUCKETS, association_rules
from starloom.plans.star import Star, sales

CATEGORY_MIN_PAIR = 50
PRODUCT_MIN_PAIR = 30


def _category_baskets(star: Star) -> DataFrame:
    return sales(star).join(
        star.dim_product.select("product_key", "category_name"), "product_key"
    ).select(F.col("order_id").alias("basket"), F.col("category_name").alias("item"))


def category_rules(star: Star, min_pair: int = CATEGORY_MIN_PAIR) -> DataFrame:
    rules = association_rules(_category_baskets(star), min_pair, scratch=star.scratch)
    return rules.orderBy(F.desc("lift"), "item_a", "item_b")


def substitutes(star: Star, min_pair: int = CATEGORY_MIN_PAIR, k: int = 15) -> DataFrame:
    """The k category pairs that share the fewest baskets for their popularity."""
    rules = association_rules(_category_baskets(star), min_pair, scratch=star.scratch)
    return (
        rules.select("item_a", "item_b", "pair_baskets", "lift")
        .orderBy("lift", "item_a", "item_b")
        .limit(k)
    )


def product_rules(star: Star, min_pair: int = PRODUCT_MIN_PAIR, k: int = 20) -> DataFrame:
    """The k product pairs of highest lift, with names and categories."""
    baskets = sales(star).select(
        F.col("order_id").alias("basket"), F.col("product_key").alias("item")
    )
    best = (
        association_rules(
            baskets, min_pair, scratch=star.scratch, support_digits=4, buckets=PAIR_BUCKETS
        )
        .orderBy(F.desc("lift"), "item_a", "item_b")
        .limit(k)
    )

    def named(side: str) -> DataFrame:
        return star.dim_product.select(
            F.col("product_key").alias(f"item_{side}"),
            F.col("name").alias(f"product_{side}"),
            F.col("category_name").alias(f"category_{side}"),
        )

    return (
        best.join(named("a"), "item_a")
        .join(named("b"), "item_b")
        .orderBy(F.desc("lift"), "item_a", "item_b")
        .select(
            "item_a",
            "item_b",
            "product_a",
            "product_b",
            "category_a",
            "category_b",
            "pair_baskets",
            "support_pct",
            "lift",
        )
    )


def basket_sizes(star: Star) -> DataFrame:
    """Baskets per number of distinct products, and the pairs they stand for."""
    # The fact has one row per order and product, so counting rows counts products.
    sizes = sales(star).groupBy("order_id").agg(F.count("*").alias("items_in_basket"))
    n = F.col("items_in_basket")
    counted = sizes.groupBy("items_in_basket").agg(F.count("*").alias("baskets"))
    # The window runs over one row per basket size.
    return counted.select(
        "items_in_basket",
        "baskets",
        pct("baskets", "sum(baskets) OVER ()", 2).alias("pct_of_baskets"),
        (F.col("baskets") * F.call_function("div", n * (n - 1), F.lit(2))).alias("pair_instances"),
    ).orderBy("items_in_basket")
