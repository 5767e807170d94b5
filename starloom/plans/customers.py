"""Customer value segments and cohort retention."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from starloom.functions import labels
from starloom.functions.exprs import pct, whole_months
from starloom.operators.ordering import ntile, rank_measures
from starloom.plans.star import Star, day_of_key, month_key, month_of_month_key, sales


def rfm(star: Star, as_of: date) -> DataFrame:
    """Recency, frequency and monetary fifths per customer, with a segment label.

    An order belongs to one customer version, so orders are counted per version and
    added up; ties are broken by customer id.
    """
    per_order = sales(star).groupBy("customer_key", "order_id").agg(
        F.max("date_key").alias("last_key"), F.sum("net_amount").alias("spent")
    )
    per_version = per_order.groupBy("customer_key").agg(
        F.max("last_key").alias("last_key"),
        F.count("*").alias("orders"),
        F.sum("spent").cast("decimal(22,2)").alias("spent"),
    )
    per_customer = (
        per_version.join(star.dim_customer.select("customer_key", "customer_id"), "customer_key")
        .groupBy("customer_id")
        .agg(
            day_of_key(F.max("last_key")).alias("last_order_date"),
            F.sum("orders").alias("frequency"),
            F.sum("spent").alias("monetary"),
        )
        .withColumn("recency_days", F.datediff(F.lit(as_of), "last_order_date"))
    )
    ranked = rank_measures(
        per_customer,
        ["customer_id"],
        {"r": ("recency_days", True), "f": ("frequency", False), "m": ("monetary", False)},
        scratch=star.scratch,
        keep=["row_number", "group_rows"],
        carry=["last_order_date", "recency_days", "frequency", "monetary"],
    )
    scored = ranked.select(
        "customer_id",
        "last_order_date",
        "recency_days",
        "frequency",
        "monetary",
        *[
            ntile(F.col(f"{x}_row_number"), F.col(f"{x}_group_rows"), 5).alias(f"{x}_score")
            for x in "rfm"
        ],
    )
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    recent, valuable = r >= 4, (f >= 4) & (m >= 4)
    segment = (
        F.when(recent & valuable, labels.RFM_CHAMPIONS)
        .when(recent & (f >= 3), labels.RFM_LOYAL)
        .when(recent, labels.RFM_NEW)
        .when((r >= 2) & (f >= 3), labels.RFM_AT_RISK)
        .when((r <= 2) & valuable, labels.RFM_CANT_LOSE)
        .when((r <= 2) & (f <= 2), labels.RFM_HIBERNATING)
        .otherwise(labels.RFM_OTHER)
    )
    return scored.select(
        "*",
        F.concat(*[c.cast("string") for c in (r, f, m)]).alias("rfm_segment_code"),
        segment.alias("rfm_segment_label"),
    ).orderBy(F.desc("r_score"), F.desc("f_score"), F.desc("m_score"), "customer_id")


def rfm_summary(star: Star, as_of: date) -> DataFrame:
    return (
        rfm(star, as_of)
        .groupBy("rfm_segment_label")
        .agg(F.count("*").alias("customers"), F.sum("monetary").alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


def cohort_retention(star: Star) -> DataFrame:
    """Active customers per first-order month and months since, in long form.

    The active months of a customer are gathered as a set, which the calendar bounds,
    so the first month and all later ones come out of one shuffle. A customer is
    active in its first month, so period 0 is the size of the cohort.
    """
    versions = sales(star).groupBy("customer_key").agg(
        F.collect_set(month_key(F.col("date_key"))).alias("months")
    )
    months = (
        versions.join(star.dim_customer.select("customer_key", "customer_id"), "customer_key")
        .groupBy("customer_id")
        .agg(F.array_distinct(F.flatten(F.collect_list("months"))).alias("months"))
    )
    active = months.select(F.array_min("months").alias("first"), F.explode("months").alias("month"))
    active = active.groupBy("first", "month").agg(F.count("*").alias("active_customers")).select(
        month_of_month_key(F.col("first")).alias("cohort_month"),
        month_of_month_key(F.col("month")).alias("month"),
        "active_customers",
    )
    counts = active.withColumn(
        "period_number", whole_months(F.col("month"), F.col("cohort_month"))
    )
    # At most one row per pair of months.
    cohort = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col("period_number") == 0, F.col("active_customers"))).over(cohort)
    return (
        counts.withColumn("cohort_size", size)
        .select(
            "cohort_month",
            "cohort_size",
            "period_number",
            "active_customers",
            pct("active_customers", "cohort_size").alias("retention_pct"),
        )
        .orderBy("cohort_month", "period_number")
    )


def cohort_triangle(star: Star, periods: int = 6) -> DataFrame:
    """Retention with one column per period."""
    long = cohort_retention(star)
    wide = long.groupBy("cohort_month", "cohort_size").pivot(
        "period_number", list(range(periods))
    )
    renamed = wide.agg(F.max("retention_pct")).withColumnsRenamed(
        {str(n): f"m{n}" for n in range(periods)}
    )
    return renamed.orderBy("cohort_month")
