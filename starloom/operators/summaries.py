"""Monthly partials of the fact that add up exactly, distinct orders included.

One row for each month and category path: sums of the measures, and four counts of orders. An order counts once in each
path it has lines in; once in each category, at one of its paths there; once in each parent category; and once at
all. So each count is a plain sum over any rows of its level: distinct orders of a month, a category or of everything
come from adding partials, and never from looking at orders again. An order has one date, so months add up too.

Partials of different months, and of parts of the fact that share no order, are stacked. They are small: months by
category paths, whatever the number of orders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from starloom.functions.labels import CANCELLED
from starloom.operators.facts import MONTH

PATH = ("parent_category_name", "category_name", "category_path")
#: Counts of orders, from the finest level to all.
ORDER_COUNTS = ("path_orders", "category_orders", "parent_orders", "orders")
SUMS = {"net": "net_amount", "gross": "gross_amount", "profit": "profit_amount", "quantity": "quantity"}


def month_partials(fact: DataFrame, product: DataFrame) -> DataFrame:
    """order_month, the category path, net, gross, profit, quantity, and the four counts of orders; sales only.

    Sums need no orders and combine on the map side. For the counts, lines are reduced to one row per order and path first, and
    these meet by order: a product, a category or an order with most of the lines is reduced before anything is shuffled. These rows
    hold numbers, in order of the paths, and neither texts nor measures.
    """
    sales = fact.filter(F.col("order_status") != CANCELLED)
    sums = (
        sales.join(product.select("product_key", *PATH), "product_key")
        .groupBy(MONTH, *PATH)
        .agg(*[F.sum(c).alias(n) for n, c in SUMS.items()])
    )

    # One row for each path.
    order = [F.asc_nulls_first(c) for c in PATH]
    levels = [F.dense_rank().over(Window.orderBy(*order[:n])).alias(f"_level{n}") for n in (1, 2, 3)]
    paths = product.select(*PATH).distinct().select(*PATH, *levels)
    names = [f"_level{n}" for n in (1, 2, 3)]
    named = paths.select(*names, *[F.col(c).alias(f"_of_{c}") for c in PATH])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in PATH])
    placed = product.select("product_key", *PATH).join(named, same).select("product_key", *names)
    held = sales.select("order_id", MONTH, "product_key").join(placed, "product_key").select("order_id", MONTH, *names).distinct()

    def first(*level: str):
        """1 on one of an order's rows in each part of a level; an order has a row for each of its paths."""
        rows = Window.partitionBy("order_id", *level).orderBy(names[-1])
        return F.when(F.row_number().over(rows) == 1, 1).otherwise(0)

    marked = held.repartition("order_id").select(
        MONTH,
        names[-1],
        F.lit(1).alias("path_orders"),
        first(*names[:2]).alias("category_orders"),
        first(*names[:1]).alias("parent_orders"),
        first().alias("orders"),
    )
    counts = marked.groupBy(MONTH, names[-1]).agg(*[F.sum(c).alias(c) for c in ORDER_COUNTS])
    counts = counts.join(paths, names[-1]).select(MONTH, *PATH, *ORDER_COUNTS)
    both = sums.unionByName(counts, allowMissingColumns=True)
    return both.groupBy(MONTH, *PATH).agg(*[F.sum(c).alias(c) for c in (*SUMS, *ORDER_COUNTS)])


def paths_digest(product: DataFrame) -> DataFrame:
    """One row, digest: of which product lies at which path. Partials made under another one no longer hold."""
    hashed = product.select(F.xxhash64("product_key", *PATH).alias("h"))
    return hashed.agg(F.coalesce(F.expr("bit_xor(h)"), F.lit(0)).alias("digest"))
