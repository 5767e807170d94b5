"""The warehouse build: source tables, dimensions with history, and the fact.

Each table is built on first use, written to the shared folder once, and read from
there by every query after that.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta
from threading import RLock

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.util import inheritable_thread_target

from starloom.operators import dimensions as dims, facts, history
from starloom.operators.ordering import number_rows
from starloom.operators.summaries import month_partials
from starloom.sources import orderdata
from starloom.sources.contracts import LOAD_ORDER, SOURCE_TABLES
from starloom.sources.snapshot import SnapshotStore
from starloom.workspace import Workspace, fit_partitions


@dataclass(frozen=True)
class WarehouseDates:
    """Dates that replace today's date, so that a build can be repeated.

    Without ``as_of``, reports are of the day after the last order.
    """

    relocation: date = date(1998, 7, 1)
    as_of: date | None = None


MOVE_EVERY, MAIL_EVERY = 10, 25


class built_once:
    """An attribute, mostly a table, that is built on first use, by one thread only."""

    def __init__(self, make: Callable[[Warehouse], object]):
        self.make = make
        self.name = make.__name__
        self.__doc__ = make.__doc__

    def __get__(self, owner: Warehouse | None, kind: type | None = None):
        if owner is None:
            return self
        with owner.locks.setdefault(self.name, RLock()):
            if self.name not in owner.__dict__:
                owner.__dict__[self.name] = self.make(owner)
        return owner.__dict__[self.name]


class Warehouse:
    """Source and star tables of one folder of order data."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        dates: WarehouseDates | None = None,
        scratch: Workspace | None = None,
    ):
        self.spark = spark
        self.folder = folder
        self.dates = dates or WarehouseDates()
        self.scratch = scratch or Workspace(spark)
        self.locks: dict[str, RLock] = {}

    def together(self, *tables: str) -> None:
        """Build tables side by side, so that small ones fill the gaps of large ones."""
        build = inheritable_thread_target(self.spark)(lambda table: getattr(self, table))
        with ThreadPoolExecutor(len(tables)) as pool:
            list(pool.map(build, tables))

    def raw(self, table: str) -> DataFrame:
        return orderdata.read_raw(self.spark, self.folder, table)

    # Source tables

    @built_once
    def categories(self) -> DataFrame:
        return self.scratch.save(orderdata.categories(self.raw("part"), self.scratch), "categories")

    @built_once
    def products(self) -> DataFrame:
        return self.scratch.save(
            orderdata.products(self.raw("part"), self.categories), "products"
        )

    @built_once
    def stores(self) -> DataFrame:
        return orderdata.stores(self.raw("nation"), self.raw("region"))

    @built_once
    def employees(self) -> DataFrame:
        return orderdata.employees(self.raw("supplier"))

    @built_once
    def _lines(self) -> DataFrame:
        lines = orderdata.order_lines(self.raw("lineitem"), self.dim_product)
        return number_rows(lines, "order_item_id", orderdata.LINE_ORDER, scratch=self.scratch, ranged=True)

    @built_once
    def order_items(self) -> DataFrame:
        return orderdata.order_items(self._lines)

    @property
    def keyed_items(self) -> DataFrame:
        """The order lines with the key and cost of their product."""
        return self._lines

    @built_once
    def orders(self) -> DataFrame:
        return self.scratch.save(
            orderdata.orders(self.raw("orders"), self.raw("customer"), self._lines), "orders"
        )

    @built_once
    def customers_at_signup(self) -> DataFrame:
        return self.scratch.save(
            orderdata.customers(
                self.raw("customer"), self.orders, self.raw("nation"), self.raw("region")
            ),
            "customers",
        )

    @built_once
    def customers(self) -> DataFrame:
        """The source after some customers moved or changed their e-mail."""
        home = self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        # The next nation by key, the first after the last; one row per nation.
        step = home.selectExpr(
            "n_name AS city",
            "coalesce(lead(n_name) OVER (ORDER BY n_nationkey), "
            "first(n_name) OVER (ORDER BY n_nationkey)) AS next_city",
            "coalesce(lead(r_name) OVER (ORDER BY n_nationkey), "
            "first(r_name) OVER (ORDER BY n_nationkey)) AS next_state",
        )
        return history.relocate_customers(
            self.customers_at_signup,
            step,
            move_every=MOVE_EVERY,
            mail_every=MAIL_EVERY,
            before=self.dates.relocation,
        )

    @built_once
    def payments(self) -> DataFrame:
        return orderdata.payments(self.orders, self.scratch)

    def source(self) -> dict[str, DataFrame]:
        """The source tables in load order; the order data holds no inventory."""
        empty = self.spark.createDataFrame([], SOURCE_TABLES["inventory"].schema)
        return {t: empty if t == "inventory" else getattr(self, t) for t in LOAD_ORDER}

    # Star tables

    def _order_dates(self) -> Row:
        day = F.col("o_orderdate").cast("date")
        return self.raw("orders").agg(F.min(day), F.max(day)).first()

    @built_once
    def order_dates(self) -> tuple[date, date]:
        """The dates of the first and the last order."""
        first, last = self._order_dates()
        if first is None:
            raise ValueError("there are no orders to take dates from")
        return first, last

    @built_once
    def calendar(self) -> tuple[date, date]:
        """The whole years from the first to the last order, so that no order is off the calendar."""
        first, last = self.order_dates
        return date(first.year, 1, 1), date(last.year, 12, 31)

    @built_once
    def as_of(self) -> date:
        """The day that reports are of."""
        return self.dates.as_of or self.order_dates[1] + timedelta(days=1)

    @built_once
    def dim_date(self) -> DataFrame:
        return self.scratch.save(dims.build_dim_date(self.spark, *self.calendar), "dim_date")

    def _first_load(self, table: str, incoming: DataFrame, natural: str, key: str) -> DataFrame:
        merged = dims.upsert_type1(
            dims.empty_table(self.spark, table),
            incoming,
            natural=natural,
            surrogate=key,
            scratch=self.scratch,
        )
        return merged.drop("change")

    @built_once
    def dim_store(self) -> DataFrame:
        return self.scratch.save(
            self._first_load("dim_store", self.stores, "store_id", "store_key"), "dim_store"
        )

    @built_once
    def dim_employee(self) -> DataFrame:
        incoming = dims.employee_attributes(self.employees, self.stores)
        loaded = self._first_load("dim_employee", incoming, "employee_id", "employee_key")
        return self.scratch.save(
            dims.with_unknown_member(loaded, "employee_key", dims.UNKNOWN_EMPLOYEE),
            "dim_employee",
        )

    @built_once
    def category_tree(self) -> DataFrame:
        return dims.flatten_hierarchy(
            self.categories,
            node="category_id",
            parent="parent_category_id",
            name="name",
            scratch=self.scratch,
        )

    @built_once
    def dim_product(self) -> DataFrame:
        incoming = dims.product_attributes(self.products, self.category_tree)
        return self.scratch.save(
            self._first_load("dim_product", incoming, "product_id", "product_key"), "dim_product"
        )

    def merge_customers(self, dim: DataFrame, customers: DataFrame) -> DataFrame:
        """One Type 2 step at the relocation date, with its ``change`` column, written."""
        merged = history.scd2_merge(
            dim,
            history.customer_attributes(customers),
            natural="customer_id",
            surrogate="customer_key",
            first_valid="signup_date",
            tracked=history.TRACKED,
            as_of=self.dates.relocation,
            scratch=self.scratch,
        )
        return self.scratch.save(merged, "dim_customer")

    @built_once
    def customer_first_load(self) -> DataFrame:
        return self.merge_customers(
            dims.empty_table(self.spark, "dim_customer"), self.customers_at_signup
        )

    @built_once
    def customer_second_load(self) -> DataFrame:
        return self.merge_customers(self.customer_first_load.drop("change"), self.customers)

    @built_once
    def dim_customer(self) -> DataFrame:
        return self.customer_second_load.drop("change")

    def facts_of(self, items: DataFrame, orders: DataFrame) -> DataFrame:
        return facts.build_fact_sales(
            items,
            orders,
            self.dim_customer,
            self.dim_product,
            self.dim_store,
            self.dim_employee,
            scratch=self.scratch,
        )

    @built_once
    def fact_sales(self) -> DataFrame:
        self.together("orders", "dim_product", "dim_customer", "dim_store", "dim_employee")
        return self.scratch.save(
            self.facts_of(self.keyed_items, self.orders), "fact_sales"
        )

    @built_once
    def month_partials(self) -> DataFrame:
        return self.scratch.save(month_partials(self.fact_sales, self.dim_product), "month_partials")

    def star(self) -> dict[str, DataFrame]:
        names = ["dim_date", "dim_store", "dim_employee", "dim_product", "dim_customer", "fact_sales"]
        self.together(*names)
        return {n: getattr(self, n) for n in names}

    def publish(self, store: SnapshotStore) -> None:
        """Show the six star tables in a store, all at once."""
        store.publish({t: store.stage(t, df) for t, df in self.star().items()}, replace=True)


class StoredSourceWarehouse(Warehouse):
    """The sources as they lie in a store of nine tables, for ``reload.refresh``."""

    def __init__(
        self,
        store: SnapshotStore,
        dates: WarehouseDates | None = None,
        scratch: Workspace | None = None,
    ):
        super().__init__(store.spark, store.root, dates, scratch)
        # What is here already is not built.
        self.__dict__.update({t: store.read(t) for t in LOAD_ORDER})

    def source(self) -> dict[str, DataFrame]:
        return {t: self.__dict__[t] for t in LOAD_ORDER}

    def _order_dates(self) -> Row:
        return self.orders.agg(F.min("order_date"), F.max("order_date")).first()


_open: dict[tuple[str, str], Warehouse] = {}


def open_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse of a folder, built once per Spark application."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    fit_partitions(spark, f"{key[1]}/{{customer,lineitem,orders,part,supplier}}.parquet")
    if key not in _open:
        _open[key] = Warehouse(spark, folder.rstrip("/"))
    return _open[key]
