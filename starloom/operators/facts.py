"""Fact build and fact upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.functions.exprs import date_key, money
from starloom.functions.labels import UNKNOWN_EMPLOYEE_KEY
from starloom.operators.asof import carry_versions
from starloom.sources.contracts import WAREHOUSE_TABLES
from starloom.workspace import Workspace

GRAIN = ("order_id", "product_key")
MONTH = "order_month"


def resolve_order_keys(
    orders: DataFrame, customer: DataFrame, store: DataFrame, employee: DataFrame, scratch: Workspace
) -> DataFrame:
    """Dimension keys at order level, before the far more numerous lines are joined.

    The customer key is that of the version valid on the order date.
    """
    placed = carry_versions(
        customer.select("customer_key", "customer_id", "valid_from", "valid_to"),
        orders.select("order_id", "customer_id", "store_id", "employee_id", "order_date", "channel", "status"),
        key="customer_id",
        valid_from="valid_from",
        valid_to="valid_to",
        at="order_date",
        ties=["order_id"],
        scratch=scratch,
    )
    # Online orders have no employee. A key of their own for each spreads them over the
    # tasks; equal NULL keys would all meet in one.
    staff = employee.select(
        F.struct("employee_id", F.lit(None).cast("bigint").alias("order_id")).alias("_staff"),
        "employee_key",
    ).filter("_staff.employee_id IS NOT NULL")
    alone = F.when(F.col("employee_id").isNull(), F.col("order_id"))
    return (
        placed.withColumn("customer_key", F.col("version.customer_key"))
        .join(store.select("store_id", "store_key"), "store_id")
        .withColumn("_staff", F.struct("employee_id", alone.alias("order_id")))
        .join(staff, "_staff", "left")
        .select(
            "order_id",
            date_key(F.col("order_date")).alias("date_key"),
            "customer_key",
            "store_key",
            F.coalesce("employee_key", F.lit(UNKNOWN_EMPLOYEE_KEY)).alias("employee_key"),
            F.col("status").alias("order_status"),
            "channel",
        )
    )


def build_fact_sales(
    items: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    product: DataFrame,
    store: DataFrame,
    employee: DataFrame,
    *,
    scratch: Workspace | None = None,
) -> DataFrame:
    """One row per product line of an order, with five keys and five measures.

    The sales key is the identity of the line, so it is the same in every load and
    costs no numbering of the fact. Lines that come with product_key and cost meet no products again. Rows lie
    as the join by order leaves them; where they are stored by month, ``by_month`` gathers them.
    """
    gross = F.col("quantity") * F.col("unit_price")
    cost = F.col("quantity") * F.col("cost")
    keyed = resolve_order_keys(orders, customer, store, employee, scratch or Workspace(orders.sparkSession))
    # Orders first: an upsert names few of them, and then few lines meet the products.
    lines = items.join(keyed, "order_id")
    if not {"product_key", "cost"} <= set(items.columns):
        lines = lines.join(product.select("product_id", "product_key", "cost"), "product_id")
    df = lines.select(
        F.col("order_item_id").alias("sales_key"),
        "date_key",
        "customer_key",
        "product_key",
        "store_key",
        "employee_key",
        "order_id",
        "order_status",
        "channel",
        "quantity",
        money(gross).alias("gross_amount"),
        money(F.col("discount")).alias("discount_amount"),
        money(gross - F.col("discount")).alias("net_amount"),
        money(cost).alias("cost_amount"),
        money(gross - F.col("discount") - cost).alias("profit_amount"),
    )
    return with_month(WAREHOUSE_TABLES["fact_sales"].conform(df))


def with_month(fact: DataFrame) -> DataFrame:
    """Add the partition column, YYYYMM."""
    return fact.withColumn(MONTH, F.call_function("div", F.col("date_key"), F.lit(100)).cast("int"))


def by_month(fact: DataFrame) -> DataFrame:
    """Add the partition column and gather each month into well-sized files, in order of the order id.

    The hint lets adaptive execution split a month that holds much of the data. The order lets a range
    of order ids skip row groups.
    """
    return with_month(fact).hint("rebalance", MONTH).sortWithinPartitions(MONTH, "order_id")


def refuse_repeats(incoming: DataFrame) -> None:
    """An upsert that names one (order_id, product_key) twice has no one result."""
    twice = incoming.groupBy(*GRAIN).count().filter("count > 1").limit(3).collect()
    if twice:
        named = ", ".join(f"order {r.order_id} product {r.product_key}" for r in twice)
        raise ValueError(f"rows to merge repeat their grain: {named}")


def touched_months(current: DataFrame, incoming: DataFrame) -> list[int]:
    """Months that an upsert changes: those of the new rows and of the rows they replace.

    The list is bounded by the calendar. Of the present fact only three columns are read, and
    of these only the files whose statistics reach into the range of the new order ids.
    """
    bounds = incoming.agg(F.min("order_id").alias("low"), F.max("order_id").alias("high")).first()
    if bounds.low is None:
        return []
    near = current.filter(F.col("order_id").between(bounds.low, bounds.high))
    replaced = near.join(incoming.select(*GRAIN), list(GRAIN), "left_semi").select(MONTH)
    months = replaced.unionByName(incoming.select(MONTH)).distinct()
    return sorted(r[0] for r in months.collect())


def merge_months(affected: DataFrame, incoming: DataFrame) -> DataFrame:
    """New content of the touched months, from their present content and the new rows.

    A row with a known (order_id, product_key) is replaced, keeping its sales key, and a
    new one is added. The join works on the touched months and not on the whole fact.
    """
    known = affected.select(*GRAIN, F.col("sales_key").alias("_known_key"))
    keyed = incoming.join(known, list(GRAIN), "left").withColumn(
        "sales_key", F.coalesce("_known_key", "sales_key")
    )
    untouched = affected.join(incoming.select(*GRAIN), list(GRAIN), "left_anti")
    return untouched.unionByName(keyed.select(*affected.columns))


def upsert_fact(current: DataFrame, incoming: DataFrame) -> tuple[DataFrame, list[int]]:
    """The new content of the touched months, and the list of these months."""
    refuse_repeats(incoming)
    months = touched_months(current, incoming)
    return merge_months(current.filter(F.col(MONTH).isin(*months)), incoming), months
