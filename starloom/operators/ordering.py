"""Global order at scale: ranks, running totals, quantile buckets and row numbers.

A window without PARTITION BY sends every row to one task, and a window over a
large group does the same for that group. Here the rows are range-partitioned on
the complete sort key instead, which is unique and therefore free of skew, each
split is ordered on its own, and the few per-split totals are carried over.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from starloom.workspace import Workspace, splits

RANK_COLUMNS = ["row_number", "rank", "running_total", "group_total", "group_rows"]


def rank_rows(
    df: DataFrame,
    value: str,
    *,
    ties: Sequence[str],
    scratch: Workspace,
    by: Sequence[str] = (),
    descending: bool = True,
) -> DataFrame:
    """Add row_number, rank, running_total, group_total and group_rows.

    Rows are ordered by ``value`` within ``by``; ``ties`` makes the order total and
    must identify a row within ``by``. ``rank`` and ``running_total`` treat equal
    values as one step, also where equal values lie in several splits. NULL is a group,
    and a value that comes last in descending order and first in ascending; as in a plain
    window, it adds nothing to a total.
    """
    ordered = F.desc(value) if descending else F.asc(value)
    sort_key = [F.asc(c) for c in by] + [ordered] + [F.asc(c) for c in ties]
    by_value = Window.partitionBy("_split", *by).orderBy(ordered)
    by_row = Window.partitionBy("_split", *by).orderBy(ordered, *ties)
    # Written once: a second sampling may cut the splits elsewhere, and what follows
    # reads the rows without another shuffle.
    local = scratch.save(
        df.repartitionByRange(splits(df.sparkSession), *sort_key)
        .withColumn("_split", F.spark_partition_id())
        .select(
            "*",
            F.row_number().over(by_row).alias("_row"),
            F.rank().over(by_value).alias("_rank"),
            F.sum(value).over(by_value).alias("_total"),
        ),
        "ranked",
    )
    # Small beside the rows: one per split and group. Written, so that its true size
    # decides whether the join below broadcasts it.
    offsets = scratch.save(_split_offsets(local, value, by), "offsets")
    at_edge = (
        f"CASE WHEN {value} <=> _first THEN _first_{{0}} WHEN {value} <=> _last THEN _last_{{0}} ELSE {{1}} END"
    )
    running = at_edge.format("end_total", "_before_total + coalesce(_total, 0)")
    # A total over nothing but NULL is NULL.
    nothing = f"{value} IS NULL AND {'group_total IS NULL' if descending else 'true'}"
    placed = offsets.select("_split", *[F.col(c).alias(f"_of_{c}") for c in by], *offsets.columns[1 + len(by):])
    same = F.lit(True)
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    joined = local.withColumnRenamed("_split", "_own").join(placed, (F.col("_own") == F.col("_split")) & same)
    return joined.selectExpr(
        *df.columns,
        "_before_n + _row AS row_number",
        at_edge.format("start", "_before_n + _rank - 1") + " + 1 AS rank",
        f"CASE WHEN {nothing} THEN NULL ELSE {running} END AS running_total",
        "group_total",
        "group_rows",
    )


def _split_offsets(
    local: DataFrame, value: str, by: Sequence[str]
) -> DataFrame:
    """Per split and group: what lies before it, the group's totals, and its edge values.

    A value at the edge of a split may continue in the next one, so its start and its
    end are taken over all splits that hold it.
    """
    sizes = local.groupBy("_split", *by).agg(
        F.expr("count(*) AS n"),
        F.expr(f"sum({value}) AS total"),
        F.expr(f"min_by({value}, _row) AS first"),
        F.expr(f"max_by({value}, _row) AS last"),
        F.expr("count_if(_rank = 1) AS first_n"),
        F.expr(f"coalesce(sum({value}) FILTER (WHERE _rank = 1), 0) AS first_total"),
        F.expr("max(_rank) - 1 AS last_offset"),
    )
    group = f"PARTITION BY {', '.join(by)}" if by else ""
    before = f"({group} ORDER BY _split ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    carried = sizes.selectExpr(
        "*",
        f"coalesce(sum(n) OVER {before}, 0) AS before_n",
        f"coalesce(sum(total) OVER {before}, 0) AS before_total",
        f"sum(n) OVER ({group}) AS group_rows",
        f"sum(total) OVER ({group}) AS group_total",
    )
    edges = carried.selectExpr(
        "*",
        """inline(array(
            struct('first' AS side, first AS v, before_n AS at, before_n + first_n AS till,
                   before_total + first_total AS sum_till),
            struct('last' AS side, last AS v, before_n + last_offset AS at, before_n + n AS till,
                   before_total + coalesce(total, 0) AS sum_till)))""",
    )
    same = f"({group}{',' if by else 'PARTITION BY'} v)"
    spread = edges.selectExpr(
        "*", f"min(at) OVER {same} AS start", f"max_by(sum_till, till) OVER {same} AS end_total"
    )
    return spread.groupBy("_split", *by).agg(
        F.expr("first(before_n) AS _before_n"),
        F.expr("first(before_total) AS _before_total"),
        F.expr("first(group_rows) AS group_rows"),
        F.expr("first(group_total) AS group_total"),
        F.expr("first(first) AS _first"),
        F.expr("first(last) AS _last"),
        *[
            F.expr(f"max({c}) FILTER (WHERE side = '{side}') AS _{side}_{c}")
            for side in ("first", "last")
            for c in ("start", "end_total")
        ],
    )


def _common_decimal(kinds: Sequence[T.DataType]) -> T.DecimalType:
    """A decimal that holds values of all these types, and sums of many of them."""
    whole = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
    digits, scale = 18, 0
    for kind in kinds:
        if isinstance(kind, T.DecimalType):
            digits, scale = max(digits, kind.precision - kind.scale), max(scale, kind.scale)
        elif kind.simpleString() in whole:
            digits = max(digits, whole[kind.simpleString()])
        else:
            raise TypeError(f"measures must be whole numbers or decimals, not {kind.simpleString()}")
    return T.DecimalType(min(38, digits + scale), scale)


def rank_measures(
    df: DataFrame,
    entity: Sequence[str],
    orders: dict[str, tuple[str, bool]],
    *,
    scratch: Workspace,
    keep: Sequence[str],
    carry: Sequence[str] = (),
) -> DataFrame:
    """Order the same rows by several measures in one pass.

    ``orders`` maps a prefix to (measure, descending). The measures are stacked, so
    that one range partitioning serves all of them, and folded back to one row per
    entity. Measures are whole numbers or decimals and share the decimal type that holds
    them all; doubles are refused, as their sums depend on the order. ``keep`` names the columns of ``rank_rows`` to return, as prefix_column;
    'value' is the measure itself. Further numeric columns in ``carry`` come along.
    """
    kind = _common_decimal([df.schema[m].dataType for m, _ in orders.values()])
    signed = {
        name: (F.col(m) if desc else -F.col(m)).cast(kind)
        for name, (m, desc) in orders.items()
    }
    pairs = [F.struct(F.lit(n).alias("name"), v.alias("v")) for n, v in signed.items()]
    stacked = df.select(*entity, *carry, F.explode(F.array(*pairs)).alias("m")).select(
        *entity, *carry, F.col("m.name").alias("_measure"), F.col("m.v").alias("_value")
    )
    ranked = rank_rows(stacked, "_value", by=["_measure"], ties=entity, scratch=scratch)

    def folded(name: str, column: str) -> Column:
        source = "_value" if column == "value" else column
        picked = F.max(F.when(F.col("_measure") == name, F.col(source)))
        flipped = column in ("value", "running_total", "group_total") and not orders[name][1]
        return (-picked if flipped else picked).alias(f"{name}_{column}")

    return ranked.groupBy(*entity).agg(
        *[F.first(c).alias(c) for c in carry], *[folded(n, c) for n in orders for c in keep]
    )


def rank_few_rows(
    df: DataFrame, value: str, *, ties: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """``rank_rows`` in descending order with plain windows.

    For rows whose number is bounded by something fixed, such as the calendar.
    """
    group = Window.partitionBy(*by)
    by_value = group.orderBy(F.desc(value))
    return df.select(
        "*",
        F.row_number().over(group.orderBy(F.desc(value), *ties)).alias("row_number"),
        F.rank().over(by_value).alias("rank"),
        F.sum(value).over(by_value).alias("running_total"),
        F.sum(value).over(group).alias("group_total"),
        F.count("*").over(group).alias("group_rows"),
    )


def ntile(row_number: Column, rows: Column, buckets: int) -> Column:
    """The bucket that NTILE(buckets) gives to a row number out of ``rows``.

    The first ``rows % buckets`` buckets hold one row more than the others.
    """
    small = F.floor(rows / buckets)
    extra = rows % buckets
    in_large = F.ceil(row_number / (small + 1))
    in_small = extra + F.ceil((row_number - extra * (small + 1)) / F.nullif(small, F.lit(0)))
    return F.when(row_number <= extra * (small + 1), in_large).otherwise(in_small).cast("int")


def number_rows(
    df: DataFrame, key: str, order: Sequence[str], *, scratch: Workspace, start: int = 0, ranged: bool = False
) -> DataFrame:
    """Number the rows start+1, start+2, ... in the given order, without a single task.

    One range shuffle and one write. The id that Spark gives to each row of the sorted
    splits holds the split number and the position in it, and needs no second shuffle.
    With ``ranged``, the rows lie in splits by range of the order already, and are not shuffled.
    """
    split = df if ranged else df.repartitionByRange(splits(df.sparkSession), *[F.asc(c) for c in order])
    sorted_rows = split.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = scratch.save(sorted_rows, "numbered").withColumn(
        "_split", F.shiftright("_place", 33).cast("int")
    )
    # One row per split reaches the driver: bounded by the number of splits.
    sizes = {r["_split"]: r["count"] for r in placed.groupBy("_split").count().collect()}
    counts = [sizes.get(i, 0) for i in range(max(sizes, default=0) + 1)]
    # One text literal, which Spark folds to a constant array, also for very many splits.
    starts = ",".join(map(str, accumulate(counts, initial=start)))
    offsets = F.split(F.lit(starts), ",").cast("array<bigint>")
    position = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(
        (F.element_at(offsets, F.col("_split") + 1) + position + 1).cast("long").alias(key),
        *df.columns,
    )


def prefix_sums(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    *,
    scratch: Workspace,
    by: Sequence[str] = (),
    name: str = "before",
) -> DataFrame:
    """Add the sum of ``value`` over the rows that stand before a row, within ``by``, in an order that is total.

    Rows are range-partitioned on the whole order and summed within each split; the totals of the splits before are
    added. So a group with most of the rows is many splits. NULL is a group, and stands first in the order.
    """
    key = [F.asc(c) for c in (*by, *order)]
    before = Window.partitionBy("_split", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # Written once: a second sampling may cut the splits elsewhere.
    local = scratch.save(
        df.repartitionByRange(splits(df.sparkSession), *key)
        .withColumn("_split", F.spark_partition_id())
        .withColumn("_local", F.coalesce(F.sum(value).over(before), F.lit(0))),
        "summed",
    )
    # One row for each split, or split and group.
    totals = local.groupBy("_split", *by).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*by).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scratch.save(
        totals.select(
            F.col("_split").alias("_of_split"),
            *[F.col(c).alias(f"_of_{c}") for c in by],
            F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"),
        ),
        "offsets",
    )
    same = F.col("_split") == F.col("_of_split")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return local.join(offsets, same).select(*df.columns, (F.col("_before") + F.col("_local")).alias(name))
