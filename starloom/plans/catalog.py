"""Named queries over a folder of order data, as (warehouse) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from starloom.operators import dimensions as dims, facts, history, late
from starloom.operators.checks import constraint_samples, stack_rows
from starloom.plans import (
    baskets,
    categories,
    customers,
    pareto,
    rankings,
    reload,
    trends,
    validation,
)
from starloom.plans.warehouse import StoredSourceWarehouse, Warehouse
from starloom.sources import csv_io, orderdata
from starloom.sources.contracts import SOURCE_TABLES, WAREHOUSE_TABLES
from starloom.sources.snapshot import SnapshotStore

# The product pairs of the order data are far rarer than those of a shop.
PRODUCT_MIN_PAIR = 2
BRAND, NEW_BRAND = "Brand#1", "Brand#2"
PROBED_CUSTOMERS = (10, 25, 50, 77)
FIRST_LOAD_BEFORE, CORRECTED_FROM = date(2001, 1, 1), date(2000, 12, 1)


def geo_tree(w: Warehouse) -> DataFrame:
    """A three-level tree over all customers: region, nation, customer."""
    node = lambda prefix, key: F.concat(F.lit(prefix), F.col(key).cast("string"))
    nodes = stack_rows(
        [
            w.raw("region").select(
                node("r", "r_regionkey").alias("node"),
                F.lit(None).cast("string").alias("parent"),
                F.col("r_name").alias("name"),
            ),
            w.raw("nation").select(
                node("n", "n_nationkey").alias("node"),
                node("r", "n_regionkey").alias("parent"),
                F.col("n_name").alias("name"),
            ),
            w.raw("customer").select(
                node("c", "c_custkey").alias("node"),
                node("n", "c_nationkey").alias("parent"),
                F.col("c_name").alias("name"),
            ),
        ]
    )
    return dims.flatten_hierarchy(
        nodes, node="node", parent="parent", name="name", scratch=w.scratch
    )


def upsert_type1(w: Warehouse) -> DataFrame:
    """A second product load: one brand has new prices, another one is new."""
    offered = w.dim_product.drop("product_key")
    first = dims.upsert_type1(
        dims.empty_table(w.spark, "dim_product"),
        offered.filter(F.col("brand") != NEW_BRAND),
        natural="product_id",
        surrogate="product_key",
        scratch=w.scratch,
    ).drop("change")
    raised = F.round(F.col("unit_price") * F.lit(Decimal("1.01")), 2).cast("decimal(10,2)")
    changed = offered.withColumn(
        "unit_price", F.when(F.col("brand") == BRAND, raised).otherwise(F.col("unit_price"))
    )
    second = dims.upsert_type1(
        w.scratch.save(first, "first-load"),
        changed,
        natural="product_id",
        surrogate="product_key",
        scratch=w.scratch,
    )
    return second.select("product_key", "product_id", "name", "brand", "unit_price", "change")


def scd2_idempotent(w: Warehouse) -> DataFrame:
    """Rows closed and inserted by the first load, by the changes, and by a re-run."""
    again = w.merge_customers(w.dim_customer, w.customers)
    loads = [w.customer_first_load, w.customer_second_load, again]
    return stack_rows(
        [
            history.change_counts(m).select(F.lit(n).alias("load"), "closed", "inserted")
            for n, m in enumerate(loads, start=1)
        ]
    )


def late_notices(customers: DataFrame) -> DataFrame:
    """Moves that became known late: of every fifteenth customer one, of every thirtieth two."""
    days = F.lit(100) + (F.col("customer_id") % 1000).cast("int")
    told = history.customer_attributes(customers).filter(F.col("customer_id") % 15 == 0)
    first = told.withColumn("changed_on", F.date_add("signup_date", days)).withColumn(
        "city", F.concat(F.lit("Late "), "city")
    )
    second = told.filter(F.col("customer_id") % 30 == 0).withColumn(
        "changed_on", F.date_add("signup_date", days + 50)
    ).withColumn("city", F.concat(F.lit("Later "), "city"))
    return first.unionByName(second).select("customer_id", "changed_on", *history.TRACKED)


def late_changes(w: Warehouse) -> late.LateChanges:
    return late.apply_late_changes(
        w.dim_customer,
        late_notices(w.customers),
        natural="customer_id",
        surrogate="customer_key",
        changed_on="changed_on",
        tracked=history.TRACKED,
        scratch=w.scratch,
    )


def fact_late_change(w: Warehouse) -> DataFrame:
    """Customer keys of the stored fact after late moves; only months with rows that move are rewritten."""
    store = SnapshotStore(w.spark, f"{w.scratch.root}/late-{uuid.uuid4().hex[:8]}")
    store.write_full("fact_sales", w.fact_sales)
    moves = late_changes(w).moves
    moved = late.moved_facts(store.read("fact_sales"), moves, surrogate="customer_key", scratch=w.scratch)
    store.upsert_fact(w.scratch.save(moved, "moved-facts"))
    return store.read("fact_sales").select("sales_key", "date_key", "customer_key")


def damaged_source(source: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The source with customers that share an e-mail or lack a sex, and orders of unknown customers."""
    c, o = F.col("customer_id"), F.col("order_id")
    shared = F.concat(F.lit("shared"), (c % 7).cast("string"))
    customers = source["customers"].withColumns(
        {
            "email": F.when(c % 20 == 1, shared).otherwise(F.col("email")),
            "sex": F.when(c % 25 != 3, F.col("sex")),
        }
    )
    orders = source["orders"].withColumn("customer_id", F.when(o % 40 == 7, -c).otherwise(c))
    return {**source, "customers": customers, "orders": orders}


def fact_upsert(w: Warehouse) -> DataFrame:
    """The fact after two loads: a first one, and one with later and corrected orders.

    The second load repeats a month of the first one, whose pending orders have been
    completed meanwhile, and adds all later orders. Only the months that it touches
    are rewritten.
    """
    before = F.col("order_date") < F.lit(FIRST_LOAD_BEFORE)
    late = w.orders.filter(F.col("order_date") >= F.lit(CORRECTED_FROM))
    corrected = late.withColumn(
        "status", F.when(F.col("status") == "pending", "completed").otherwise(F.col("status"))
    )
    store = SnapshotStore(w.spark, f"{w.scratch.root}/upsert-{uuid.uuid4().hex[:8]}")
    store.write_full("fact_sales", w.facts_of(w.keyed_items, w.orders.filter(before)))
    incoming = w.scratch.save(w.facts_of(w.keyed_items, corrected), "late-facts")
    store.upsert_fact(incoming.drop(facts.MONTH))
    return store.read("fact_sales")


def load_summary(w: Warehouse) -> DataFrame:
    """Counts to look at after a load."""

    def counts(df: DataFrame, items: dict[str, object]) -> DataFrame:
        probe = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(items.values())])
        rows = [
            F.struct(F.lit(name).alias("item"), F.col(f"c{i}").alias("n"))
            for i, name in enumerate(items)
        ]
        return probe.select(F.explode(F.array(*rows)).alias("r")).select("r.*")

    null = lambda c: F.count(F.when(F.col(c).isNull(), 1))
    every = F.count("*")
    return stack_rows(
        [
            counts(w.dim_date, {"dim_date rows": every}),
            counts(w.dim_store, {"dim_store rows": every}),
            counts(
                w.dim_employee,
                {
                    "dim_employee rows": every,
                    "dim_employee without manager": null("manager_name"),
                    "dim_employee unknown member": null("employee_id"),
                },
            ),
            counts(
                w.dim_product,
                {
                    "dim_product rows": every,
                    "dim_product without category": null("category_name"),
                    "dim_product without parent category": null("parent_category_name"),
                    "dim_product category paths": F.countDistinct("category_path"),
                },
            ),
            counts(w.dim_customer, {"dim_customer rows": every}),
            counts(w.fact_sales, {"fact_sales rows": every}),
        ]
    )


def csv_roundtrip(w: Warehouse) -> DataFrame:
    """Write the nine source tables as CSV, load them into a store, and count them there."""
    folder = f"{w.scratch.root}/csv"
    for table, df in w.source().items():
        csv_io.write_csv(df, folder, table)
    return csv_io.ingest_all(
        w.spark, folder, SnapshotStore(w.spark, f"{w.scratch.root}/store"), truncate=True
    )


def star_from_csv(w: Warehouse) -> DataFrame:
    """The fact of a star that was loaded from nine CSV files and passed all checks."""
    run = f"{w.scratch.root}/from-csv-{uuid.uuid4().hex[:8]}"
    for table, df in w.source().items():
        # Plain, these files would be a third of all that lies on disk at the end.
        csv_io.write_csv(df, f"{run}/csv", table, compression="gzip")
    sources, star = SnapshotStore(w.spark, f"{run}/source"), SnapshotStore(w.spark, f"{run}/star")
    csv_io.ingest_all(w.spark, f"{run}/csv", sources, truncate=True)
    reload.refresh(StoredSourceWarehouse(sources, scratch=w.scratch), star, w.dates.relocation)
    return star.read("fact_sales")


def warehouse_reload(w: Warehouse) -> DataFrame:
    """Changes of three loads of one star: customers at signup, after they changed, and again."""
    run = f"{w.scratch.root}/reload-{uuid.uuid4().hex[:8]}"
    sources, star = SnapshotStore(w.spark, f"{run}/source"), SnapshotStore(w.spark, f"{run}/star")
    loads = []
    for n, customers_now in enumerate([w.customers_at_signup, w.customers, w.customers], start=1):
        tables = w.source() if n == 1 else {}
        changed = {**tables, "customers": customers_now}
        sources.publish({t: sources.stage(t, df) for t, df in changed.items()}, replace=True)
        made = reload.refresh(StoredSourceWarehouse(sources, scratch=w.scratch), star, w.dates.relocation)
        loads.append(w.scratch.save(made.withColumn("load", F.lit(n).cast("bigint")), "reload"))
    return stack_rows(loads)


def fact_columns(w: Warehouse) -> DataFrame:
    return w.fact_sales.select(*[f.name for f in WAREHOUSE_TABLES["fact_sales"].schema])


QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {
    # Warehouse build
    "dim_date": lambda w: w.dim_date,
    "dim_store": lambda w: w.dim_store,
    "dim_employee": lambda w: w.dim_employee,
    "dim_product": lambda w: w.dim_product,
    "category_tree": lambda w: w.category_tree,
    "geo_tree": geo_tree,
    "upsert_type1": upsert_type1,
    "scd2_history": lambda w: w.dim_customer,
    "scd2_current": lambda w: w.dim_customer.filter("is_current"),
    "scd2_probe": lambda w: history.versions_of(w.dim_customer, "customer_id", PROBED_CUSTOMERS),
    "scd2_idempotent": scd2_idempotent,
    "scd2_late_change": lambda w: late_changes(w).dimension,
    "fact_late_change": fact_late_change,
    "surrogate_keys": lambda w: w.order_items.select("order_item_id", "order_id", "product_id"),
    "fact_sales": fact_columns,
    "fact_upsert": fact_upsert,
    "load_summary": load_summary,
    "csv_roundtrip": csv_roundtrip,
    "star_from_csv": star_from_csv,
    "warehouse_reload": warehouse_reload,
    # Revenue trends
    "monthly_trend": trends.monthly_trend,
    "same_store_sales": lambda w: trends.same_store_sales(w, w.as_of),
    "category_monthly": trends.category_monthly,
    "cagr": trends.cagr,
    "cagr_ttm": trends.cagr_ttm,
    # Rankings
    "product_rank": rankings.product_rank,
    "brand_top5": lambda w: rankings.brand_top(w, BRAND),
    "top5_per_brand": rankings.top_per_brand,
    "top_brands_per_category": rankings.top_brands_per_category,
    "rank_movement": rankings.rank_movement,
    "sales_gaps": rankings.sales_gaps,
    # Pareto and ABC
    "abc_revenue": lambda w: pareto.product_abc(w, "revenue"),
    "abc_gross": lambda w: pareto.product_abc(w, "gross"),
    "abc_profit": lambda w: pareto.product_abc(w, "profit"),
    "abc_quantity": lambda w: pareto.product_abc(w, "quantity"),
    "abc_discount": lambda w: pareto.product_abc(w, "discount"),
    "abc_summary": pareto.abc_summary,
    "customer_pareto": pareto.customer_pareto,
    "daily_pareto": pareto.daily_pareto,
    "monthly_pareto": pareto.monthly_pareto,
    "abc_movement": pareto.abc_movement,
    # Customers
    "rfm": lambda w: customers.rfm(w, w.as_of),
    "rfm_summary": lambda w: customers.rfm_summary(w, w.as_of),
    "cohort_long": customers.cohort_retention,
    "cohort_triangle": customers.cohort_triangle,
    # Categories, cancellations, attribution
    "category_rollup": categories.category_rollup,
    "category_margin": categories.category_margin,
    "cancellation": categories.cancellation,
    "scd2_attribution": categories.key_attribution,
    # Baskets
    "basket_category": baskets.category_rules,
    "basket_substitutes": baskets.substitutes,
    "basket_product": lambda w: baskets.product_rules(w, PRODUCT_MIN_PAIR),
    "basket_sizes": baskets.basket_sizes,
    # Data quality
    "validate_dim_date": lambda w: validation.check_dim_date(w, w.source(), *w.calendar),
    "validate_dims": lambda w: validation.check_dims(w, w.source()),
    "validate_scd2": lambda w: validation.check_history(w, w.source()),
    "validate_fact": lambda w: validation.check_fact(w, w.source()),
    "validate_report": lambda w: validation.validate(w, w.source(), *w.calendar),
    "reconcile_store": lambda w: validation.reconcile_store(w, w.source()),
    "reconcile_month": lambda w: validation.reconcile_month(w, w.source()),
    "constraint_report": lambda w: validation.source_constraints(w.source()),
    "constraint_samples": lambda w: constraint_samples(damaged_source(w.source()), SOURCE_TABLES),
    "business_rules": lambda w: validation.business_rules(w.source(), orderdata.unmapped(w.raw)),
    "distribution_sanity": lambda w: validation.distribution_sanity(w, w.source()),
}
