"""What the queries need of a star: five dimensions, the fact and a shared folder."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.labels import CANCELLED
from starloom.operators.sidecars import by_folder
from starloom.operators.summaries import month_partials, paths_digest
from starloom.sources.snapshot import SnapshotStore
from starloom.workspace import Workspace


class Star(Protocol):
    scratch: Workspace
    dim_date: DataFrame
    dim_store: DataFrame
    dim_employee: DataFrame
    dim_product: DataFrame
    dim_customer: DataFrame
    fact_sales: DataFrame
    #: What ``operators.summaries.month_partials`` makes of the fact.
    month_partials: DataFrame


def stored_partials(
    store: SnapshotStore, scratch: Workspace, *, folders: list[str] | None = None, product: DataFrame | None = None
) -> DataFrame:
    """Monthly partials of a stored fact. Those kept beside it are read, and made for the folders that have none.

    Where products lie at other paths than when they were made, all are made again.
    """
    folders = store.folders("fact_sales") if folders is None else folders
    product = store.read("dim_product") if product is None else product
    now = paths_digest(product).first()["digest"]
    known = store.read("fact_partial").filter(F.col("paths_digest") == now)

    def make(fact: DataFrame) -> DataFrame:
        return month_partials(fact, product).withColumn("paths_digest", F.lit(now).cast("long"))

    return by_folder(store, "fact_partial", folders, make, scratch, known=known)


class StoredStar:
    """A star that was published to a snapshot store."""

    def __init__(self, store: SnapshotStore, scratch: Workspace | None = None):
        self.scratch = scratch or Workspace(store.spark)
        self._store = store

    @property
    def month_partials(self) -> DataFrame:
        return stored_partials(self._store, self.scratch)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith(("dim_", "fact_")):
            return self._store.read(name)
        raise AttributeError(name)


def sales(star: Star) -> DataFrame:
    """Fact rows that count as sales: every query leaves out cancelled orders."""
    return star.fact_sales.filter(F.col("order_status") != CANCELLED)


def month_key(key: Column) -> Column:
    """YYYYMM of a YYYYMMDD key."""
    return F.call_function("div", key, F.lit(100)).cast("int")


def month_of_month_key(key: Column) -> Column:
    """First day of a YYYYMM month."""
    return F.make_date(F.call_function("div", key, F.lit(100)).cast("int"), key % 100, F.lit(1))


def month_of_key(key: Column) -> Column:
    """First day of the month of a YYYYMMDD key, without a join."""
    return month_of_month_key(month_key(key))


def day_of_key(key: Column) -> Column:
    """The date of a YYYYMMDD key, without a join."""
    month = month_key(key)
    return F.make_date(F.call_function("div", month, F.lit(100)).cast("int"), month % 100, key % 100)
