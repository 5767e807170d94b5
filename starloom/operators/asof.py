"""Point-in-time join: each event with the version of its key that is valid at its time.

An equi join on the key with the interval as a residual condition compares every event of a key with
every version of it, in one task. Here versions and events form one stream in order of key and time, and the
last version is carried forward over the events after it: the cost is their sum, not their product, and a key
with very many of either is simply several splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from starloom.workspace import Workspace, splits


def carry_versions(
    versions: DataFrame,
    events: DataFrame,
    *,
    key: str,
    valid_from: str,
    valid_to: str,
    at: str,
    ties: Sequence[str],
    scratch: Workspace,
    version_key: str | None = None,
) -> DataFrame:
    """The events that have a valid version, with the version as the struct ``version``.

    A version is valid from ``valid_from`` up to but without ``valid_to``, without end where that is null. The
    versions of a key do not overlap; those that are valid at no time take no part. ``ties`` are columns of the events that
    tell events of one key and time apart, so that also these spread. A null key or time matches nothing. ``version_key``
    is the key's name among the versions, if it differs.

    Rows are range-partitioned on the complete order, and each split carries on its own; what is carried into a split
    from those before it is one row for each split.
    """
    real = F.col(valid_from).isNotNull() & (F.col(valid_to).isNull() | (F.col(valid_from) < F.col(valid_to)))
    opened = versions.filter(real).select(
        F.col(version_key or key).alias("_key"),
        F.col(valid_from).alias("_at"),
        F.lit(0).alias("_side"),
        F.struct(*versions.columns).alias("version"),
        *[F.lit(None).cast(events.schema[c].dataType).alias(f"_tie_{c}") for c in ties],
        F.lit(None).cast(events.schema.simpleString()).alias("_event"),
    )
    seen = events.select(
        F.col(key).alias("_key"),
        F.col(at).alias("_at"),
        F.lit(1).alias("_side"),
        F.lit(None).cast(versions.schema.simpleString()).alias("version"),
        *[F.col(c).alias(f"_tie_{c}") for c in ties],
        F.struct(*events.columns).alias("_event"),
    )
    both = opened.union(seen).filter("_key IS NOT NULL AND _at IS NOT NULL")
    order = ["_key", "_at", "_side", *[f"_tie_{c}" for c in ties]]
    carried = Window.partitionBy("_split", "_key").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, 0)
    # Written once: a second sampling may cut the splits elsewhere.
    local = scratch.save(
        both.repartitionByRange(splits(events.sparkSession), *order)
        .withColumn("_split", F.spark_partition_id())
        .withColumn("_last", F.last("version", ignorenulls=True).over(carried))
        .select("_split", "_key", "_at", "_side", "_last", "_event"),
        "carried",
    )
    # The last version in all splits before: it is the one to carry on if it is of the split's first key.
    ends = local.groupBy("_split").agg(
        F.expr("max_by(struct(_key, _last), struct(_key, _at)) FILTER (WHERE _side = 0)").alias("end")
    )
    before = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    brought = scratch.save(
        ends.select("_split", F.last("end", ignorenulls=True).over(before).alias("_brought")), "brought"
    )
    joined = local.filter("_side = 1").join(brought, "_split")
    own = F.when(F.col("_brought._key") == F.col("_key"), F.col("_brought._last"))
    valid = joined.withColumn("version", F.coalesce("_last", own))
    ends_later = F.col(f"version.{valid_to}").isNull() | (F.col("_at") < F.col(f"version.{valid_to}"))
    return valid.filter(F.col("version").isNotNull() & ends_later).select("_event.*", "version")
