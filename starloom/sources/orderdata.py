"""Maps the order data tables to the retail source tables.

Every function returns one source table as a DataFrame. Money is decimal and is
rounded once per column.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.functions.exprs import money
from starloom.functions.labels import CANCELLED, ONLINE, PAID_STATUSES
from starloom.operators.checks import stack_rows
from starloom.operators.ordering import number_rows
from starloom.sources.contracts import SOURCE_TABLES
from starloom.workspace import Workspace, splits

PRICE = "decimal(10,2)"
RETAIL_CHANNEL = "in-store"
ONLINE_PRIORITIES = ("4-NOT SPECIFIED", "5-LOW")
STATUS_OF_FLAG = {"F": "delivered", "O": "shipped"}
CANCEL_EVERY = 13
FIRST_OPENING, OPENING_STEP_DAYS = date(1993, 1, 1), 130
SIGNUP_WITHOUT_ORDERS = date(1995, 1, 1)
HIRE_DATE = date(1994, 1, 1)
PAYMENT_METHODS = ("cash", "card", "wallet", "bank_transfer")


def read_raw(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _conform(df: DataFrame, table: str) -> DataFrame:
    return SOURCE_TABLES[table].conform(df)


def _phone(key: Column, width: int) -> Column:
    # lpad would cut a key that is wider than the field.
    text = key.cast("string")
    return F.concat(F.lit("555-"), F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text))


# The grain of an order line, in the order of its ids.
LINE_ORDER = ("order_id", "product_id")
# Ids for the leaves of a top level: more than a whole number has size bands.
LEAF_IDS = 1_000_000_000


def _band(size: Column) -> Column:
    return F.floor((size - 1) / 10).cast("int")


def categories(part: DataFrame, scratch: Workspace) -> DataFrame:
    """One top level per part type, one leaf per type and size band."""
    leaves = part.select("p_type", _band(F.col("p_size")).alias("band")).distinct()
    tops = number_rows(leaves.select("p_type").distinct(), "top_id", ["p_type"], scratch=scratch)
    named_tops = tops.select(
        F.col("top_id").alias("category_id"),
        F.col("p_type").alias("name"),
        F.lit(None).cast("bigint").alias("parent_category_id"),
    )
    named_leaves = leaves.join(tops, "p_type").select(
        (F.col("top_id") * LEAF_IDS + F.col("band") + 1).alias("category_id"),
        _leaf_name(F.col("p_type"), F.col("band")).alias("name"),
        F.col("top_id").alias("parent_category_id"),
    )
    return _conform(named_tops.unionByName(named_leaves), "categories")


def _leaf_name(kind: Column, band: Column) -> Column:
    return F.concat(kind, F.lit(" B"), band.cast("string"))


def products(part: DataFrame, category: DataFrame) -> DataFrame:
    leaf = category.filter("parent_category_id IS NOT NULL").select(
        "category_id", F.col("name").alias("leaf")
    )
    tenth = F.lit(Decimal("0.1"))
    price = F.round(F.col("p_retailprice").cast(PRICE) * F.col("p_size") * tenth, 2).cast(PRICE)
    df = (
        part.withColumn("leaf", _leaf_name(F.col("p_type"), _band(F.col("p_size"))))
        .join(leaf, "leaf")
        .select(
            F.col("p_partkey").alias("product_id"),
            "category_id",
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"),
            price.alias("unit_price"),
        )
        .withColumn("cost", F.round(F.col("unit_price") * F.lit(Decimal("0.6")), 2))
    )
    return _conform(df, "products")


def stores(nation: DataFrame, region: DataFrame) -> DataFrame:
    df = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("store_id"),
        F.col("n_name").alias("name"),
        _phone(F.col("n_nationkey"), 4).alias("phone"),
        F.col("r_name").alias("city"),
        F.date_add(F.lit(FIRST_OPENING), F.col("n_nationkey") * OPENING_STEP_DAYS).alias(
            "opened_date"
        ),
        F.concat(F.lit("Manager "), F.col("n_name")).alias("manager"),
    )
    return _conform(df, "stores")


def employees(supplier: DataFrame) -> DataFrame:
    boss = supplier.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("boss"))
    key = F.col("s_suppkey")
    df = supplier.join(boss, "s_nationkey").select(
        key.alias("employee_id"),
        F.lit("Employee").alias("first_name"),
        key.cast("string").alias("last_name"),
        F.concat(F.lit("e"), key.cast("string"), F.lit("@example.com")).alias("email"),
        _phone(key, 6).alias("phone"),
        F.lit(HIRE_DATE).alias("hire_date"),
        F.when(F.col("boss") != key, F.col("boss")).alias("manager_id"),
        F.col("s_nationkey").alias("store_id"),
    )
    return _conform(df, "employees")


def customers(
    customer: DataFrame, orders: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """Customers with a signup date derived from their first order."""
    first = orders.groupBy("customer_id").agg(F.min("order_date").alias("first_order"))
    place = nation.join(region, nation.n_regionkey == region.r_regionkey)
    key = F.col("c_custkey")
    signup = F.date_sub(F.col("first_order"), (key % 60).cast("int"))
    df = (
        customer.join(place, customer.c_nationkey == place.n_nationkey)
        .join(first, key == F.col("customer_id"), "left")
        .select(
            key.alias("customer_id"),
            F.lit("Customer").alias("first_name"),
            key.cast("string").alias("last_name"),
            F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")).alias("email"),
            _phone(key, 7).alias("phone"),
            F.concat(key.cast("string"), F.lit(" Main Street")).alias("address"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.coalesce(signup, F.lit(SIGNUP_WITHOUT_ORDERS)).alias("signup_date"),
            (18 + key % 63).alias("age"),
            F.when(key % 2 == 0, "M").otherwise("F").alias("sex"),
        )
    )
    return _conform(df, "customers")


def order_lines(lineitem: DataFrame, product: DataFrame) -> DataFrame:
    """Lines at the grain (order, product), with the lowest supplier of each, and the product's key and cost.

    They lie in splits by range of ``LINE_ORDER``, so that they can be numbered where they are. Raw lines, few of which share
    their grain, meet their product and then move once; the sampling that cuts the splits groups nothing. Each product has a
    key of its own, so that grouping by it too is the same as meeting it afterwards.
    """
    raw = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
        F.col("l_discount").cast("decimal(4,2)").alias("rate"),
        F.col("l_suppkey").alias("supplier"),
    )
    kept = product.select("product_id", "product_key", "cost", F.col("unit_price").alias("list_price"))
    ranged = raw.join(kept, "product_id").repartitionByRange(splits(lineitem.sparkSession), *[F.asc(c) for c in LINE_ORDER])
    grouped = ranged.groupBy(*LINE_ORDER, "product_key", "cost", "list_price").agg(
        F.sum("quantity").cast("int").alias("quantity"),
        F.max("rate").alias("rate"),
        F.min("supplier").alias("supplier"),
    )
    markup = (100 + F.col("order_id") % 41).cast("int") * F.lit(Decimal("0.01"))
    priced = grouped.withColumn("unit_price", F.round(F.col("list_price") * markup, 2).cast(PRICE))
    return priced.select(
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        F.round(F.col("unit_price") * F.col("rate"), 2).cast(PRICE).alias("discount"),
        "supplier",
        "product_key",
        "cost",
    )


def order_items(lines: DataFrame) -> DataFrame:
    return _conform(lines, "order_items")


def orders(raw: DataFrame, customer: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders that have lines, with the total and the salesperson taken from them."""
    per_order = lines.groupBy("order_id").agg(
        F.sum(money(F.col("quantity") * F.col("unit_price") - F.col("discount"))).alias(
            "total_amount"
        ),
        F.min("supplier").alias("salesperson"),
    )
    online = F.col("o_orderpriority").isin(*ONLINE_PRIORITIES)
    status = F.when(F.col("o_orderkey") % CANCEL_EVERY == 0, CANCELLED)
    for flag, name in STATUS_OF_FLAG.items():
        status = status.when(F.col("o_orderstatus") == flag, name)
    df = (
        raw.join(per_order, F.col("o_orderkey") == F.col("order_id"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "order_id",
            F.col("o_custkey").alias("customer_id"),
            F.col("c_nationkey").alias("store_id"),
            F.when(~online, F.col("salesperson")).alias("employee_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.when(online, ONLINE).otherwise(RETAIL_CHANNEL).alias("channel"),
            status.otherwise("pending").alias("status"),
            "total_amount",
        )
    )
    return _conform(df, "orders")


def payments(orders: DataFrame, scratch: Workspace) -> DataFrame:
    paid = orders.filter(F.col("status").isin(*PAID_STATUSES))
    method = F.element_at(
        F.array(*[F.lit(m) for m in PAYMENT_METHODS]), (F.col("order_id") % 4).cast("int") + 1
    )
    noon = F.date_add("order_date", (F.col("order_id") % 3).cast("int")).cast("timestamp_ntz")
    df = paid.select(
        "order_id",
        method.alias("method"),
        F.col("total_amount").alias("amount"),
        (noon + F.expr("INTERVAL 12 HOURS")).alias("paid_at"),
    )
    return _conform(number_rows(df, "payment_id", ["order_id"], scratch=scratch), "payments")


def unmapped(raw: Callable[[str], DataFrame]) -> DataFrame:
    """Rows of the order data that the mapping leaves out, as (rule, violations): joins drop what has no partner."""
    orders, lines = raw("orders"), raw("lineitem")
    places = raw("nation").join(raw("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")

    def without(rows: DataFrame, key: str, others: DataFrame, target: str, rule: str) -> DataFrame:
        lost = rows.select(F.col(key)).join(others.select(F.col(target)), F.col(key) == F.col(target), "left_anti")
        return lost.agg(F.lit(rule).alias("rule"), F.count("*").alias("violations"))

    return stack_rows(
        [
            without(orders, "o_orderkey", lines, "l_orderkey", "raw order without lines"),
            without(orders, "o_custkey", raw("customer"), "c_custkey", "raw order without customer"),
            without(lines, "l_orderkey", orders, "o_orderkey", "raw line without order"),
            without(lines, "l_partkey", raw("part"), "p_partkey", "raw line without product"),
            without(raw("customer"), "c_nationkey", places, "n_nationkey", "raw customer without nation"),
        ]
    )
