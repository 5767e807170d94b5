"""Loads a star from source tables, or brings a stored one up to date, checked before it shows."""

from __future__ import annotations

from datetime import date
from types import SimpleNamespace

from pyspark.sql import DataFrame, functions as F

from starloom.functions import labels
from starloom.functions.exprs import any_changed
from starloom.operators import digests, dimensions as dims, facts, history
from starloom.operators.checks import stack_rows
from starloom.operators.sidecars import by_folder
from starloom.plans.star import stored_partials
from starloom.plans.validation import validate
from starloom.plans.warehouse import StoredSourceWarehouse
from starloom.sources.snapshot import SnapshotStore, month_of
from starloom.workspace import Workspace, shuffle_files_released

NEW_DAY = "dim_date"


def _counts(table: str, df: DataFrame) -> DataFrame:
    """Rows per kind of change, of a table with a ``change`` column."""
    kinds = ("inserted", "updated", "closed", "gone")
    return df.agg(*[F.count_if(F.col("change") == k).alias(k) for k in kinds]).select(
        F.lit(table).alias("table_name"), *kinds
    )


def _told(fact: DataFrame) -> list[str]:
    """Surrogate keys of the fact are those of the lines, so all other columns tell a change."""
    return [c for c in fact.columns if c not in (*facts.GRAIN, "sales_key", facts.MONTH)]


def _changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """What the fact lacks or has otherwise, and the lines that the source no longer has."""
    columns = _told(new)
    on = [F.col(f"old.{c}") == F.col(f"new.{c}") for c in facts.GRAIN]
    both = old.alias("old").join(new.alias("new"), on, "full_outer")
    change = (
        F.when(F.col("old.order_id").isNull(), "inserted")
        .when(F.col("new.order_id").isNull(), "gone")
        .when(any_changed("old", "new", columns), "updated")
    )
    return both.withColumn("change", change).where("change IS NOT NULL").select("new.*", "change")


def stored_leaves(store: SnapshotStore, folders: list[str], scratch: Workspace) -> DataFrame:
    """Leaves of the digest tree of these folders of the fact; those without any are read."""
    return by_folder(
        store, "fact_digest", folders, lambda rows: digests.leaves(rows, [*facts.GRAIN, *_told(rows)]), scratch
    )


def changed_rows(store: SnapshotStore, new: DataFrame, scratch: Workspace) -> tuple[DataFrame, DataFrame]:
    """What the stored fact lacks or has otherwise or too much, and its months that hold such rows.

    Digests tell where the two differ. Only these months are read, and only rows of leaves that differ are joined; where
    nothing differs, no row of the stored fact is read.
    """
    folders = store.folders("fact_sales")
    was = stored_leaves(store, folders, scratch)
    now = scratch.save(digests.leaves(new, [*facts.GRAIN, *_told(new)]), "leaves")
    months = digests.differing_months(was, now)
    old = facts.with_month(store.scan("fact_sales", [p for p in folders if month_of(p) in months]))
    leaves = scratch.save(digests.differing_leaves(was, now, months), "differing")
    met = _changes(digests.rows_of(old, leaves), digests.rows_of(new.where(F.col(facts.MONTH).isin(*months)), leaves))
    return scratch.save(met, "changes"), old


def refresh(source: StoredSourceWarehouse, store: SnapshotStore, as_of: date) -> DataFrame:
    """One load on the present content of ``store``: Type 1, Type 2 at ``as_of``, and the fact.

    Only months with a new or other line are written again, and found by their digests. The 54 checks run on the staged
    tables; if one fails, nothing is published. Lines that the source no longer has stay, and
    are counted as gone. Returns table_name, inserted, updated, closed and gone.
    """
    spark, scratch = source.spark, source.scratch
    merged: dict[str, DataFrame] = {}

    def type1(table: str, incoming: DataFrame, natural: str, key: str) -> None:
        made = dims.upsert_type1(
            store.read(table), incoming, natural=natural, surrogate=key, scratch=scratch
        )
        merged[table] = scratch.save(made, table)

    type1("dim_store", source.stores, "store_id", "store_key")
    type1(
        "dim_employee",
        dims.employee_attributes(source.employees, source.stores),
        "employee_id",
        "employee_key",
    )
    type1(
        "dim_product",
        dims.product_attributes(source.products, source.category_tree),
        "product_id",
        "product_key",
    )
    merged["dim_customer"] = scratch.save(
        history.scd2_merge(
            store.read("dim_customer"),
            history.customer_attributes(source.customers),
            natural="customer_id",
            surrogate="customer_key",
            first_valid="signup_date",
            tracked=history.TRACKED,
            as_of=as_of,
            scratch=scratch,
        ),
        "dim_customer",
    )
    star = {t: df.drop("change") for t, df in merged.items()}
    star["dim_employee"] = dims.with_unknown_member(
        star["dim_employee"], "employee_key", dims.UNKNOWN_EMPLOYEE
    )
    old_days = store.read(NEW_DAY).agg(F.min("full_date"), F.max("full_date")).first()
    first, last = source.calendar
    first, last = min(old_days[0] or first, first), max(old_days[1] or last, last)
    star[NEW_DAY] = dims.build_dim_date(spark, first, last)
    staged = {t: store.stage(t, df) for t, df in star.items()}
    fresh = {t: store.scan(t, p) for t, p in staged.items()}

    # Written, as its digests and its changed rows are both taken from it.
    new = scratch.save(
        facts.build_fact_sales(
            source.order_items,
            source.orders,
            *(fresh[t] for t in ("dim_customer", "dim_product", "dim_store", "dim_employee")),
            scratch=scratch,
        ),
        "new-fact",
    )
    changes, old = changed_rows(store, new, scratch)
    # In a first load, each of these two tables is as large as the fact.
    scratch.drop(new)
    incoming = changes.where("change != 'gone'").drop("change")
    months = facts.touched_months(old, incoming)
    folders = store.folders("fact_sales")
    affected = facts.with_month(store.scan("fact_sales", [p for p in folders if month_of(p) in months]))
    staged["fact_sales"] = [p for p in folders if month_of(p) not in months]
    if months:
        staged["fact_sales"] += store.stage("fact_sales", facts.merge_months(affected, incoming))
    fact_counts = scratch.save(_counts("fact_sales", changes), "counts")
    scratch.drop(changes)
    fresh["fact_sales"] = store.scan("fact_sales", staged["fact_sales"])
    staged["fact_digest"] = store.stage("fact_digest", stored_leaves(store, staged["fact_sales"], scratch))
    partials = stored_partials(store, scratch, folders=staged["fact_sales"], product=fresh["dim_product"])
    staged["fact_partial"] = store.stage("fact_partial", partials)

    report = validate(SimpleNamespace(**fresh, scratch=scratch), source.source(), first, last)
    with shuffle_files_released(spark):
        failed = report.where(f"result != '{labels.PASS}'").collect()  # 54 rows at most
    if failed:
        raise ValueError(f"nothing was published; checks {', '.join(str(r.ord) for r in failed)} fail")
    store.publish(staged, replace=True)
    return stack_rows([*[_counts(t, df) for t, df in merged.items()], fact_counts])
