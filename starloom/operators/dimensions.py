"""Dimension builds: calendar, Type 1 upsert, unknown member, flattened hierarchy."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.functions import calendar, labels
from starloom.functions.exprs import any_changed, date_key
from starloom.operators.ordering import number_rows
from starloom.sources.contracts import WAREHOUSE_TABLES
from starloom.workspace import Workspace


def date_series(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from start to end, both included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("full_date")
    )


def build_dim_date(
    spark: SparkSession, start: date, end: date, fiscal_shift_days: int = calendar.FISCAL_SHIFT_DAYS
) -> DataFrame:
    day = F.col("full_date")
    iso_day = F.weekday(day) + 1
    df = date_series(spark, start, end).select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.trim(F.date_format(day, "MMMM")).alias("month_name"),
        F.trim(F.date_format(day, "EEEE")).alias("day_name"),
        iso_day.alias("day_of_week"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        (iso_day > 5).alias("is_weekend"),
        calendar.leap_year(F.year(day)).alias("is_leap_year"),
        calendar.fiscal_year(day, fiscal_shift_days).alias("fiscal_year"),
        calendar.fiscal_quarter(day, fiscal_shift_days).alias("fiscal_quarter"),
    )
    return WAREHOUSE_TABLES["dim_date"].conform(df)


def constant_rows(spark: SparkSession, schema: T.StructType, rows: Sequence[dict]) -> DataFrame:
    """A few literal rows, planned as constants; missing columns are NULL."""
    made = [
        F.struct(*[F.lit(r.get(f.name)).cast(f.dataType).alias(f.name) for f in schema])
        for r in rows or [{}]
    ]
    df = spark.range(1).select(F.explode(F.array(*made)).alias("r")).select("r.*")
    return df if rows else df.filter(F.lit(False))


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return constant_rows(spark, WAREHOUSE_TABLES[table].schema, [])


def assign_keys(
    new_rows: DataFrame, key: str, natural: Sequence[str], *, after: int, scratch: Workspace
) -> DataFrame:
    """Surrogate keys for new rows, counted on from the highest key in use."""
    return number_rows(new_rows, key, natural, scratch=scratch, start=after)


def highest_key(df: DataFrame, key: str) -> int:
    """One value; the unknown member at -1 does not count as used."""
    return max(df.agg(F.max(key)).first()[0] or 0, 0)


def upsert_type1(
    current: DataFrame,
    incoming: DataFrame,
    *,
    natural: str,
    surrogate: str,
    scratch: Workspace,
) -> DataFrame:
    """New snapshot of a Type 1 dimension, with a ``change`` column.

    ``change`` is 'inserted', 'updated' or 'kept'. Known rows keep their surrogate
    key, a row counts as updated only if an attribute differs (NULL equals NULL),
    and rows that are missing from ``incoming`` stay.
    """
    attributes = [c for c in incoming.columns if c != natural]
    old = current.alias("old")
    new = incoming.withColumn("_given", F.lit(True)).alias("new")
    changed = F.col("new._given").isNotNull() & any_changed("old", "new", attributes)
    merged = old.join(new, F.col(f"old.{natural}") == F.col(f"new.{natural}"), "left").select(
        f"old.{surrogate}",
        f"old.{natural}",
        *[F.when(changed, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in attributes],
        F.when(changed, "updated").otherwise("kept").alias("change"),
    )
    unseen = incoming.join(current.select(natural), natural, "left_anti")
    added = assign_keys(
        unseen, surrogate, [natural], after=highest_key(current, surrogate), scratch=scratch
    )
    return merged.unionByName(added.withColumn("change", F.lit("inserted"))).select(
        *current.columns, "change"
    )


def with_unknown_member(dim: DataFrame, key: str, member: dict[str, object]) -> DataFrame:
    """Add one constant row unless a row with its key is present."""
    row = constant_rows(dim.sparkSession, dim.schema, [member])
    return dim.unionByName(row.join(dim.select(key), key, "left_anti").select(*dim.columns))


UNKNOWN_EMPLOYEE = {
    "employee_key": labels.UNKNOWN_EMPLOYEE_KEY,
    "full_name": labels.UNKNOWN_EMPLOYEE_NAME,
    "store_name": labels.UNKNOWN_EMPLOYEE_STORE,
}


def employee_attributes(employees: DataFrame, stores: DataFrame) -> DataFrame:
    """Employees with the names of their manager and store in place of the ids."""
    full_name = F.concat("first_name", F.lit(" "), "last_name")
    managers = employees.select(
        F.col("employee_id").alias("manager_id"), full_name.alias("manager_name")
    )
    places = stores.select("store_id", F.col("name").alias("store_name"))
    return (
        employees.join(managers, "manager_id", "left")
        .join(places, "store_id", "left")
        .select(
            "employee_id",
            full_name.alias("full_name"),
            "email",
            "hire_date",
            "manager_name",
            "store_name",
        )
    )


PLACED, ORPHAN, CYCLE = "placed", "orphan", "cycle"


def walk_hierarchy(
    nodes: DataFrame,
    *,
    node: str,
    parent: str,
    name: str,
    scratch: Workspace,
    separator: str = " > ",
) -> DataFrame:
    """An adjacency list, walked from every node up: name, parent name, path, depth and state of each node.

    Every node points to an ancestor, at first its parent, and has the path from below it. In each round a
    node that has not arrived takes over the pointer of the node it points to, and puts that one's path before its own, so
    that pointers double their reach: the number of joins is the logarithm of the depth. A node has arrived
    when it points to nothing. One that comes to an unknown parent is an orphan. A round in which none arrives leaves only
    nodes on a cycle or below one; path, depth and parent name are null for these and for orphans.

    A null parent makes a root. Ids are unique; a null id is nobody's parent.
    """
    start = nodes.select(
        F.col(node).alias("id"),
        F.col(name).alias("label"),
        F.col(parent).alias("above"),
        F.col(name).alias("path"),
        F.lit(1).alias("depth"),
        F.lit(None).cast("string").alias("parent_name"),
        F.when(F.col(parent).isNull(), PLACED).alias("state"),
    )
    state = scratch.save(start, "walk")
    arrived = [state.filter("state IS NOT NULL")]
    moving = state.filter("state IS NULL")
    first = True
    while not moving.isEmpty():
        known = moving
        for done in arrived:
            known = known.unionByName(done)
        ahead = known.select(
            F.col("id").alias("_id"),
            F.col("label").alias("_label"),
            F.col("above").alias("_above"),
            F.col("path").alias("_path"),
            F.col("depth").alias("_depth"),
            F.col("state").alias("_state"),
        )
        tried = scratch.save(
            moving.join(ahead, F.col("above") == F.col("_id"), "left").select(
                "id",
                "label",
                F.col("_above").alias("above"),
                F.concat("_path", F.lit(separator), "path").alias("path"),
                (F.col("_depth") + F.col("depth")).alias("depth"),
                # The first step leads to the parent.
                F.col("_label" if first else "parent_name").alias("parent_name"),
                F.when(F.col("_id").isNull(), ORPHAN).otherwise(F.col("_state")).alias("state"),
            ),
            "walk",
        )
        moved = tried.filter("state IS NOT NULL")
        if moved.isEmpty():
            arrived.append(tried.withColumn("state", F.lit(CYCLE)))
            break
        arrived.append(moved)
        moving, first = tried.filter("state IS NULL"), False
    walked = arrived[0]
    for done in arrived[1:]:
        walked = walked.unionByName(done)
    known_only = lambda c: F.when(F.col("state") == PLACED, F.col(c)).alias(c)
    return walked.select(
        F.col("id").alias(node),
        F.col("label").alias(name),
        *map(known_only, ("parent_name", "path", "depth")),
        "state",
    )


def flatten_hierarchy(
    nodes: DataFrame,
    *,
    node: str,
    parent: str,
    name: str,
    scratch: Workspace,
    separator: str = " > ",
) -> DataFrame:
    """The nodes that a root reaches, with name, parent name, path and depth.

    ``walk_hierarchy`` also tells of those that none reaches: a cycle, or the children of an unknown parent.
    """
    walked = walk_hierarchy(nodes, node=node, parent=parent, name=name, scratch=scratch, separator=separator)
    return walked.filter(F.col("state") == PLACED).drop("state")


def unreached(nodes: DataFrame, tree: DataFrame, node: str) -> DataFrame:
    """The nodes that ``flatten_hierarchy`` found no way to."""
    return nodes.join(tree.select(node), node, "left_anti")


def product_attributes(products: DataFrame, tree: DataFrame) -> DataFrame:
    """Products with their category, its parent and its path."""
    category = tree.select(
        "category_id",
        F.col("name").alias("category_name"),
        F.col("parent_name").alias("parent_category_name"),
        F.col("path").alias("category_path"),
    )
    return products.join(category, "category_id", "left").select(
        "product_id",
        "name",
        "brand",
        "category_name",
        "parent_category_name",
        "category_path",
        "unit_price",
        "cost",
    )
