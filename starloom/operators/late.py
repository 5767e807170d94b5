"""Late changes of a Type 2 dimension: intervals are split, and just the fact rows in them are pointed anew.

A notice says that a key had certain attributes from a day that lies before the start of its open version, or
anywhere else in its history. The version of that day is cut there. Notices of one version meet each other
and their version by carrying along a range-partitioned order, so a key with very many of them is several splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.exprs import date_key
from starloom.operators.asof import carry_versions
from starloom.operators.dimensions import assign_keys, highest_key
from starloom.workspace import Workspace

#: A day number after all dates.
_NEVER = 1 << 30


@dataclass(frozen=True)
class LateChanges:
    """What a set of notices makes of a dimension.

    ``dimension`` has a ``change`` column: 'kept', 'corrected', 'closed' or 'inserted'. ``moves`` has a row for each new
    version: from_key, to_key, valid_from, valid_to. ``refused`` are the notices that no version covers.
    """

    dimension: DataFrame
    moves: DataFrame
    refused: DataFrame


def _day(column: Column) -> Column:
    return F.unix_date(column)


def _neighbour(points: DataFrame, cuts: DataFrame, scratch: Workspace) -> DataFrame:
    """cuts with ``version``: the point of the same key at the greatest place below that of the cut."""
    return carry_versions(
        points.withColumn("_until", F.lit(None).cast("int")),
        cuts.withColumn("_below", F.col("_place") - 1),
        key="_key",
        valid_from="_place",
        valid_to="_until",
        at="_below",
        ties=[],
        scratch=scratch,
    )


def apply_late_changes(
    dim: DataFrame,
    notices: DataFrame,
    *,
    natural: str,
    surrogate: str,
    changed_on: str,
    tracked: Sequence[str],
    scratch: Workspace,
) -> LateChanges:
    """Split the versions in which ``notices`` (natural, changed_on, all of tracked) fall.

    From the day of a notice up to the next notice or the end of its version, a new version has the notice's tracked
    attributes, and the others of the version it was cut from; the old one ends on that day and keeps its key. A notice of
    the day a version starts corrects it in place. One that says what was so already changes nothing, so the
    same notices can come again. Later versions stay as they are. Of several notices of one key and day, the one with the greatest
    values counts. Notices of unknown keys, of days before the first version, or without key or day are
    refused. Versions of length zero take no part.
    """
    values = F.struct(*tracked)
    told = scratch.save(
        notices.groupBy(natural, changed_on).agg(F.max(values).alias("_told")), "notices"
    )
    known = F.col(natural).isNotNull() & F.col(changed_on).isNotNull()
    near = dim.join(told.filter(known).select(natural).distinct(), natural, "left_semi").select(*dim.columns)
    covered = scratch.save(
        carry_versions(
            near, told, key=natural, valid_from="valid_from", valid_to="valid_to", at=changed_on, ties=[], scratch=scratch
        ),
        "covered",
    )
    refused = told.join(covered.select(natural, changed_on), [natural, changed_on], "left_anti")

    first_day = F.col(changed_on) == F.col("version.valid_from")
    held = F.struct(*[F.col(f"version.{c}").alias(c) for c in tracked])
    corrections = covered.filter(first_day & ~F.col("_told").eqNullSafe(held)).select(
        F.col(f"version.{surrogate}").alias("_key"), F.col("_told").alias("_fixed")
    )
    inside = covered.filter(~first_day).select(
        F.col(f"version.{surrogate}").alias("_key"),
        _day(F.col(changed_on)).alias("_place"),
        F.col(changed_on).alias("_from"),
        F.col("_told"),
        F.col("version").alias("_old"),
    )
    # What was so just before a notice: the notice before it, or else the version itself, as corrected.
    bases = (
        inside.select("_key", "_old").dropDuplicates(["_key"]).join(corrections, "_key", "left").select(
            "_key",
            _day(F.col("_old.valid_from")).alias("_place"),
            F.coalesce("_fixed", F.struct(*[F.col(f"_old.{c}").alias(c) for c in tracked])).alias("_told"),
            _day(F.col("_old.valid_to")).alias("_end"),
        )
    )
    bases = scratch.save(bases, "late-bases")
    starts = bases.drop("_end").unionByName(inside.select("_key", "_place", "_told"))
    real = scratch.save(
        _neighbour(starts, inside, scratch)
        .filter(~F.col("_told").eqNullSafe(F.col("version._told")))
        .drop("version", "_below"),
        "late-cuts",
    )
    # The same order backwards gives the day on which each new version ends.
    back = (-F.col("_place")).alias("_place")
    ends = bases.select("_key", F.coalesce("_end", F.lit(_NEVER)).alias("_place")).unionByName(
        real.select("_key", "_place")
    )
    closing = _neighbour(ends.select("_key", back), real.withColumn("_place", -F.col("_place")), scratch)
    until = -F.col("version._place")
    last = F.coalesce(_day(F.col("_old.valid_to")), F.lit(_NEVER)) == until

    def opened(column: str) -> Column:
        if column == "valid_from":
            return F.col("_from").alias(column)
        if column == "valid_to":
            ended = F.date_from_unix_date(F.when(~last, until))
            return F.when(last, F.col("_old.valid_to")).otherwise(ended).alias(column)
        if column == "is_current":
            return (F.col("_old.is_current") & last).alias(column)
        return F.col(f"_told.{column}" if column in tracked else f"_old.{column}").alias(column)

    rest = [c for c in dim.columns if c != surrogate]
    new = closing.select(F.col("_key").alias("_from_key"), *[opened(c) for c in rest])
    numbered = scratch.save(
        assign_keys(new, surrogate, [natural, "valid_from"], after=highest_key(dim, surrogate), scratch=scratch),
        "late-versions",
    )
    cut = real.groupBy("_key").agg(F.min("_from").alias("_cut"))
    touched = corrections.join(cut, "_key", "full")
    aged = dim.join(touched, F.col(surrogate) == F.col("_key"), "left")
    fixed, ended = F.col("_fixed").isNotNull(), F.col("_cut").isNotNull()

    def carried(column: str) -> Column:
        kept = F.col(column)
        if column == "valid_to":
            return F.coalesce("_cut", kept).alias(column)
        if column == "is_current":
            return (kept & ~ended).alias(column)
        if column in tracked:
            return F.when(fixed, F.col(f"_fixed.{column}")).otherwise(kept).alias(column)
        return kept

    change = F.when(ended, "closed").when(fixed, "corrected").otherwise("kept").alias("change")
    old = aged.select(*[carried(c) for c in dim.columns], change)
    whole = old.unionByName(numbered.select(*dim.columns, F.lit("inserted").alias("change")))
    moves = numbered.select(
        F.col("_from_key").alias("from_key"), F.col(surrogate).alias("to_key"), "valid_from", "valid_to"
    )
    return LateChanges(whole, moves, refused.select(natural, changed_on, "_told.*"))


def moved_facts(fact: DataFrame, moves: DataFrame, *, surrogate: str, scratch: Workspace) -> DataFrame:
    """The fact rows whose key changes, with the new key; all others are none of them.

    Rows are kept from the first cut of their version on, before any of them is shuffled by order.
    """
    cuts = moves.groupBy(F.col("from_key").alias(surrogate)).agg(
        F.min(date_key(F.col("valid_from"))).alias("_first")
    )
    reached = fact.join(cuts, surrogate).filter(F.col("date_key") >= F.col("_first")).select(*fact.columns)
    versions = moves.select(
        "from_key", "to_key", date_key(F.col("valid_from")).alias("since"), date_key(F.col("valid_to")).alias("until")
    )
    moved = carry_versions(
        versions,
        reached,
        key=surrogate,
        version_key="from_key",
        valid_from="since",
        valid_to="until",
        at="date_key",
        ties=["order_id", "product_key"],
        scratch=scratch,
    )
    return moved.withColumn(surrogate, F.col("version.to_key").cast(fact.schema[surrogate].dataType)).select(*fact.columns)
