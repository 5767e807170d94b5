"""Type 2 history: close changed rows, open their successors."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.exprs import any_changed
from starloom.operators.dimensions import assign_keys, highest_key
from starloom.workspace import Workspace

TRACKED = ("city", "state", "address", "phone", "email")


def customer_attributes(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        "phone",
        "address",
        "city",
        "state",
        "age",
        "sex",
        "signup_date",
    )


def scd2_merge(
    dim: DataFrame,
    incoming: DataFrame,
    *,
    natural: str,
    surrogate: str,
    first_valid: str,
    tracked: Sequence[str],
    as_of: date,
    scratch: Workspace,
    refreshed: Sequence[str] = (),
) -> DataFrame:
    """One load step of a Type 2 dimension; the result has a ``change`` column.

    A current row whose tracked attributes differ is 'closed' at ``as_of``, and every
    key without an open row gets one ('inserted'): from ``as_of`` if the key is known,
    else from its ``first_valid`` date. All other rows are 'kept'. Intervals are half
    open, so a closed row ends on the day its successor starts. Running the same
    input again changes nothing. ``refreshed`` lists attributes that are overwritten
    on the open row without a new version.
    """
    today = F.lit(as_of)
    new = incoming.withColumn("_given", F.lit(True)).alias("new")
    changed = (
        F.col("old.is_current")
        & F.col("new._given").isNotNull()
        & any_changed("old", "new", list(tracked))
    )
    too_early = F.raise_error(
        F.concat(F.lit("a row starts after the change date, key "), F.col(f"old.{natural}"))
    )
    end = F.when(F.col("old.valid_from") <= today, today).otherwise(too_early.cast("date"))

    def carried(column: str) -> Column:
        kept = F.col(f"old.{column}")
        if column in refreshed:
            open_row = F.col("old.is_current") & F.col("new._given").isNotNull() & ~changed
            return F.when(open_row, F.col(f"new.{column}")).otherwise(kept).alias(column)
        if column == "valid_to":
            return F.when(changed, end).otherwise(kept).alias(column)
        if column == "is_current":
            return (kept & ~changed).alias(column)
        return kept.alias(column)

    aged = scratch.save(
        dim.alias("old")
        .join(new, F.col(f"old.{natural}") == F.col(f"new.{natural}"), "left")
        .select(
            *[carried(c) for c in dim.columns],
            F.when(changed, "closed").otherwise("kept").alias("change"),
        ),
        "aged",
    )

    known = aged.groupBy(natural).agg(F.bool_or("is_current").alias("_open"))
    missing = (
        incoming.join(known, natural, "left")
        .filter(~F.coalesce("_open", F.lit(False)))
        .select(
            *incoming.columns,
            F.when(F.col("_open").isNotNull(), today)
            .otherwise(F.col(first_valid))
            .alias("valid_from"),
            F.lit(None).cast("date").alias("valid_to"),
            F.lit(True).alias("is_current"),
        )
    )
    opened = assign_keys(
        missing, surrogate, [natural], after=highest_key(dim, surrogate), scratch=scratch
    ).withColumn("change", F.lit("inserted"))
    return aged.unionByName(opened).select(*dim.columns, "change")


def change_counts(merged: DataFrame) -> DataFrame:
    """Rows closed and inserted by one merge, as a single row."""
    return merged.agg(
        F.count(F.when(F.col("change") == "closed", 1)).alias("closed"),
        F.count(F.when(F.col("change") == "inserted", 1)).alias("inserted"),
    )


def versions_of(dim: DataFrame, natural: str, keys: Sequence[object]) -> DataFrame:
    """All versions of chosen keys, oldest first."""
    return dim.filter(F.col(natural).isin(*keys)).orderBy(natural, "valid_from")


def relocate_customers(
    customers: DataFrame, places: DataFrame, *, move_every: int, mail_every: int, before: date
) -> DataFrame:
    """A changed copy of the source: some customers move, some change their e-mail.

    ``places`` maps a city to the next one. Only customers that signed up before
    ``before`` change, so no version can end before it starts.
    """
    early = F.col("signup_date") < F.lit(before)
    moves = early & (F.col("customer_id") % move_every == 0)
    mails = early & (F.col("customer_id") % mail_every == 0)
    new_mail = F.concat(F.split_part("email", F.lit("@"), F.lit(1)), F.lit("@newdomain.example"))
    return customers.join(places, "city", "left").select(
        *[
            {
                "city": F.when(moves, F.col("next_city")).otherwise(F.col("city")),
                "state": F.when(moves, F.col("next_state")).otherwise(F.col("state")),
                "address": F.when(moves, F.concat(F.lit("Relocated - "), "address")).otherwise(
                    F.col("address")
                ),
                "email": F.when(mails, new_mail).otherwise(F.col("email")),
            }
            .get(c, F.col(c))
            .alias(c)
            for c in customers.columns
        ]
    )
