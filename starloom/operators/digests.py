"""Digest tree of the fact: finds the rows of two states that differ without joining the rest.

The leaves are digests of all rows of a month whose order ids fall into one of ``BUCKETS`` buckets; a month's digest
combines those of its leaves. A digest is a count and two combined hashes, the same in any order of rows, and combines
by exclusive or: of leaves of several folders as of rows. Two states are compared by month, then by leaf in the months that
differ; only rows of leaves that differ have to meet.

Leaves of what is stored are kept beside it by folder. Folders never change, so leaves cannot be stale; a folder without
leaves is read once to make them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starloom.operators.facts import MONTH

#: Leaves of a month.
BUCKETS = 256
LEAF = (MONTH, "bucket")
DIGEST = ("n", "one", "two")


def bucket() -> Column:
    return F.pmod(F.xxhash64("order_id"), F.lit(BUCKETS)).cast("int").alias("bucket")


def leaves(fact: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row for each month and bucket with rows: order_month, bucket, and the digest over ``columns``.

    Hashes combine on the map side; what is shuffled is a row for each task and leaf.
    """
    hashed = fact.select(
        MONTH, bucket(), F.xxhash64(*columns).alias("one"), F.xxhash64(F.lit(1), *columns).alias("two")
    )
    return hashed.groupBy(*LEAF).agg(F.count("*").alias("n"), F.expr("bit_xor(one) AS one"), F.expr("bit_xor(two) AS two"))


def combined(digests: DataFrame, *by: str) -> DataFrame:
    return digests.groupBy(*by).agg(
        F.sum("n").alias("n"), F.expr("bit_xor(one) AS one"), F.expr("bit_xor(two) AS two")
    )


def _unequal(old: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """Keys whose digests differ, or that one side lacks."""
    both = old.select(*by, F.struct(*DIGEST).alias("was")).join(
        new.select(*by, F.struct(*DIGEST).alias("is")), list(by), "full_outer"
    )
    return both.filter(~F.col("was").eqNullSafe(F.col("is"))).select(*by)


def differing_months(old: DataFrame, new: DataFrame) -> list[int]:
    """Months whose digests differ, from two tables of leaves; the calendar bounds the list."""
    found = _unequal(combined(old, MONTH), combined(new, MONTH), [MONTH])
    return sorted(r[0] for r in found.collect())


def differing_leaves(old: DataFrame, new: DataFrame, months: Sequence[int]) -> DataFrame:
    """order_month and bucket of the leaves that differ, within the given months."""
    within = F.col(MONTH).isin(*months)
    return _unequal(combined(old.filter(within), *LEAF), combined(new.filter(within), *LEAF), LEAF)


def rows_of(fact: DataFrame, differing: DataFrame) -> DataFrame:
    """The rows of the fact that lie in the given leaves."""
    named = fact.withColumn("bucket", bucket())
    return named.join(differing, list(LEAF), "left_semi").select(*fact.columns)
