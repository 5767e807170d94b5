"""Pareto and ABC analysis of products, customers, days, months and quarters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from starloom.functions import labels
from starloom.functions.exprs import month_of, pct
from starloom.operators.ordering import rank_few_rows, rank_measures, rank_rows
from starloom.operators.pareto import abc_class
from starloom.plans.star import Star, sales

PRODUCT_MEASURES = {
    "revenue": "net_amount",
    "gross": "gross_amount",
    "profit": "profit_amount",
    "quantity": "quantity",
    "discount": "discount_amount",
}


def product_abc(star: Star, measure: str = "revenue") -> DataFrame:
    """Products with rank, cumulative share and class by one measure."""
    totals = sales(star).groupBy("product_key").agg(
        F.sum(PRODUCT_MEASURES[measure]).alias(measure)
    )
    named = totals.join(
        star.dim_product.select("product_key", "product_id", "name", "category_name"), "product_key"
    ).drop("product_key")
    ranked = rank_rows(named, measure, ties=["product_id"], scratch=star.scratch)
    return ranked.select(
        "product_id",
        "name",
        "category_name",
        measure,
        F.col("row_number").alias("rank_position"),
        pct("running_total", "group_total").alias("cumulative_pct"),
        pct("row_number", "group_rows").alias("pct_of_products"),
        abc_class("running_total", "group_total", labels.ABC_PRODUCT_LABELS).alias("abc_class"),
    ).orderBy(F.desc(measure), "product_id")


def abc_summary(star: Star) -> DataFrame:
    """Products and revenue per class, with their shares."""
    classes = product_abc(star).groupBy("abc_class").agg(
        F.count("*").alias("products"), F.sum("revenue").alias("revenue")
    )
    # Windows over three rows.
    return classes.select(
        "abc_class",
        "products",
        pct("products", "sum(products) OVER ()").alias("pct_of_catalogue"),
        "revenue",
        pct("revenue", "sum(revenue) OVER ()").alias("pct_of_revenue"),
    ).orderBy(F.upper("abc_class"))


def customer_pareto(star: Star) -> DataFrame:
    """Customers ordered by five measures at once, with their current attributes.

    Sales of all versions of a customer count, and are summed per version before the
    version is looked up. Every customer has one current row, so attaching it last
    drops no one.
    """
    measures = {f"total_{m}": c for m, c in PRODUCT_MEASURES.items()}
    per_version = sales(star).groupBy("customer_key").agg(
        *[F.sum(c).alias(m) for m, c in measures.items()]
    )
    per_customer = (
        per_version.join(star.dim_customer.select("customer_key", "customer_id"), "customer_key")
        .groupBy("customer_id")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    names = list(PRODUCT_MEASURES)
    ranked = rank_measures(
        per_customer,
        ["customer_id"],
        {m: (f"total_{m}", True) for m in names},
        scratch=star.scratch,
        keep=["value", "row_number", "running_total", "group_total"],
    )
    current = star.dim_customer.filter("is_current").select(
        "customer_id", "full_name", "address", "age", "sex"
    )

    def running(m: str):
        return f"{m}_running_total", f"{m}_group_total"

    return (
        ranked.join(current, "customer_id")
        .select(
            "customer_id",
            "full_name",
            "address",
            "age",
            "sex",
            *[
                F.col(f"{m}_value").cast("long" if m == "quantity" else "decimal(28,2)").alias(f"total_{m}")
                for m in names
            ],
            *[F.col(f"{m}_row_number").alias(f"{m}_rank") for m in names],
            *[pct(*running(m)).alias(f"cum_pct_{m}") for m in names],
            *[
                abc_class(*running(m), labels.ABC_LABELS).alias(f"abc_class_{m}")
                for m in ("revenue", "profit", "quantity")
            ],
        )
        .orderBy(F.desc("total_revenue"), "customer_id")
    )


def _calendar_pareto(
    star: Star, period: dict[str, object], kept: list[str], unit: str
) -> DataFrame:
    """Classes of calendar periods; their number is bounded by the calendar."""
    daily = sales(star).groupBy("date_key").agg(F.sum("net_amount").alias("net"))
    totals = (
        daily.join(star.dim_date, "date_key")
        .groupBy(*[c.alias(n) for n, c in period.items()])
        .agg(F.sum("net").alias("revenue"))
    )
    return (
        rank_few_rows(totals, "revenue", ties=list(period))
        .select(
            *kept,
            "revenue",
            F.col("row_number").alias("rank_position"),
            pct("running_total", "group_total").alias("cum_pct_revenue"),
            pct("row_number", "group_rows").alias(f"pct_of_{unit}s"),
            abc_class("running_total", "group_total", labels.ABC_LABELS).alias(
                f"{unit}_class"
            ),
        )
        .orderBy(F.desc("revenue"), *kept)
    )


def daily_pareto(star: Star) -> DataFrame:
    columns = ["full_date", "day_name", "is_weekend"]
    return _calendar_pareto(star, {c: F.col(c) for c in columns}, columns, "day")


def monthly_pareto(star: Star) -> DataFrame:
    """Months within fiscal quarters: a month that a quarter boundary cuts gives two rows."""
    period = {
        "month_start": month_of(F.col("full_date")),
        "fiscal_year": F.col("fiscal_year"),
        "fiscal_quarter": F.col("fiscal_quarter"),
    }
    return _calendar_pareto(star, period, list(period), "month")


def abc_movement(star: Star) -> DataFrame:
    """Class of each product per fiscal quarter, against the quarter before.

    Quarters are numbered through, so the quarter before is the product's previous
    row if that row's number is one less.
    """
    quarters = star.dim_date.select("date_key", "fiscal_year", "fiscal_quarter")
    quarterly = (
        sales(star)
        .join(quarters, "date_key")
        .groupBy("fiscal_year", "fiscal_quarter", "product_key")
        .agg(F.sum("net_amount").alias("revenue"))
    )
    ranked = rank_rows(
        quarterly,
        "revenue",
        by=["fiscal_year", "fiscal_quarter"],
        ties=["product_key"],
        scratch=star.scratch,
    ).select(
        "fiscal_year",
        "fiscal_quarter",
        "product_key",
        "revenue",
        (F.col("fiscal_year") * 4 + F.col("fiscal_quarter")).alias("_quarter"),
        abc_class("running_total", "group_total", labels.ABC_LABELS).alias("now"),
    )
    history = Window.partitionBy("product_key").orderBy("_quarter")
    adjacent = F.lag("_quarter").over(history) == F.col("_quarter") - 1
    moved = ranked.withColumn("before", F.when(adjacent, F.lag("now").over(history)))
    # The class letters are in order of value, so a later letter before is a rise.
    movement = (
        F.when(F.col("before").isNull(), labels.MOVEMENT_NEW)
        .when(F.col("before") == F.col("now"), labels.MOVEMENT_STABLE)
        .when(F.col("before") > F.col("now"), labels.MOVEMENT_UP)
        .otherwise(labels.MOVEMENT_DOWN)
    )
    return (
        moved.join(star.dim_product.select("product_key", "name"), "product_key")
        .select(
            "fiscal_year",
            "fiscal_quarter",
            "product_key",
            "name",
            "revenue",
            F.col("now").alias("class_this_quarter"),
            F.col("before").alias("class_prev_quarter"),
            movement.alias("movement"),
        )
        .orderBy("fiscal_year", "fiscal_quarter", F.desc("revenue"), "product_key")
    )
