"""Declared shape of the nine source tables and the six warehouse tables.

Spark keeps no keys or checks on Parquet, so the contracts are data that the
constraint checks and the CSV reader use.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    target: str


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool = False
    length: int | None = None


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[Column, ...]
    key: str
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[ForeignKey, ...] = ()
    checks: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def lengths(self) -> dict[str, int]:
        return {c.name: c.length for c in self.columns if c.length is not None}

    @property
    def schema(self) -> T.StructType:
        """Spark types; text widths are left to the length check."""
        return T.StructType.fromDDL(", ".join(f"{c.name} {c.type}" for c in self.columns))

    def fill_defaults(self, df: DataFrame) -> DataFrame:
        """Give columns that are NULL or missing their declared default."""
        filled = {
            name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
            for name, value in self.defaults.items()
        }
        return df.withColumns(filled) if filled else df

    def conform(self, df: DataFrame) -> DataFrame:
        df = self.fill_defaults(df)
        return df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])


# The columns, keys, checks and defaults of the data model.
# Identifiers are wide, because the order data outgrows 32 bits at scale.
SOURCE_TABLES = {
    t.name: t
    for t in [
        TableContract(
            "categories",
            (
                Column("category_id", "bigint", required=True),
                Column("name", "string", required=True, length=100),
                Column("parent_category_id", "bigint"),
            ),
            "category_id",
            unique=(("name",),),
            foreign=(ForeignKey("parent_category_id", "categories", "category_id"),),
        ),
        TableContract(
            "stores",
            (
                Column("store_id", "bigint", required=True),
                Column("name", "string", required=True, length=150),
                Column("phone", "string", required=True, length=20),
                Column("city", "string", required=True, length=100),
                Column("opened_date", "date", required=True),
                Column("manager", "string", required=True, length=150),
            ),
            "store_id",
        ),
        TableContract(
            "customers",
            (
                Column("customer_id", "bigint", required=True),
                Column("first_name", "string", required=True, length=100),
                Column("last_name", "string", required=True, length=100),
                Column("email", "string", required=True, length=150),
                Column("phone", "string", required=True, length=20),
                Column("address", "string", required=True, length=200),
                Column("city", "string", required=True, length=100),
                Column("state", "string", required=True, length=50),
                Column("signup_date", "date", required=True),
                Column("age", "int", required=True),
                Column("sex", "string", required=True, length=10),
            ),
            "customer_id",
            unique=(("email",),),
        ),
        TableContract(
            "products",
            (
                Column("product_id", "bigint", required=True),
                Column("category_id", "bigint", required=True),
                Column("name", "string", required=True, length=150),
                Column("brand", "string", required=True, length=100),
                Column("unit_price", "decimal(10,2)", required=True),
                Column("cost", "decimal(10,2)", required=True),
            ),
            "product_id",
            foreign=(ForeignKey("category_id", "categories", "category_id"),),
            checks=("unit_price >= 0", "cost >= 0"),
        ),
        TableContract(
            "employees",
            (
                Column("employee_id", "bigint", required=True),
                Column("first_name", "string", required=True, length=100),
                Column("last_name", "string", required=True, length=100),
                Column("email", "string", required=True, length=150),
                Column("phone", "string", required=True, length=20),
                Column("hire_date", "date", required=True),
                Column("manager_id", "bigint"),
                Column("store_id", "bigint", required=True),
            ),
            "employee_id",
            unique=(("email",),),
            foreign=(
                ForeignKey("store_id", "stores", "store_id"),
                ForeignKey("manager_id", "employees", "employee_id"),
            ),
        ),
        TableContract(
            "orders",
            (
                Column("order_id", "bigint", required=True),
                Column("customer_id", "bigint", required=True),
                Column("store_id", "bigint", required=True),
                Column("employee_id", "bigint"),
                Column("order_date", "date", required=True),
                Column("channel", "string", required=True, length=50),
                Column("status", "string", required=True, length=50),
                Column("total_amount", "decimal(10,2)", required=True),
            ),
            "order_id",
            foreign=(
                ForeignKey("customer_id", "customers", "customer_id"),
                ForeignKey("store_id", "stores", "store_id"),
                ForeignKey("employee_id", "employees", "employee_id"),
            ),
            checks=(
                "channel IN ('online', 'in-store')",
                "status IN ('pending', 'completed', 'cancelled', 'shipped', 'delivered')",
                "total_amount > 0",
            ),
            defaults={"channel": "in-store", "status": "pending"},
        ),
        TableContract(
            "order_items",
            (
                Column("order_item_id", "bigint", required=True),
                Column("order_id", "bigint", required=True),
                Column("product_id", "bigint", required=True),
                Column("quantity", "int", required=True),
                Column("unit_price", "decimal(10,2)", required=True),
                Column("discount", "decimal(10,2)", required=True),
            ),
            "order_item_id",
            unique=(("order_id", "product_id"),),
            foreign=(
                ForeignKey("order_id", "orders", "order_id"),
                ForeignKey("product_id", "products", "product_id"),
            ),
            checks=("quantity > 0", "unit_price >= 0", "discount >= 0"),
            defaults={"discount": 0},
        ),
        TableContract(
            "inventory",
            (
                Column("inventory_id", "bigint", required=True),
                Column("store_id", "bigint", required=True),
                Column("product_id", "bigint", required=True),
                Column("quantity", "int", required=True),
                Column("last_restock_date", "date"),
            ),
            "inventory_id",
            unique=(("store_id", "product_id"),),
            foreign=(
                ForeignKey("store_id", "stores", "store_id"),
                ForeignKey("product_id", "products", "product_id"),
            ),
            checks=("quantity >= 0",),
            defaults={"quantity": 0},
        ),
        TableContract(
            "payments",
            (
                Column("payment_id", "bigint", required=True),
                Column("order_id", "bigint", required=True),
                Column("method", "string", required=True, length=20),
                Column("amount", "decimal(10,2)", required=True),
                Column("paid_at", "timestamp_ntz", required=True),
            ),
            "payment_id",
            foreign=(ForeignKey("order_id", "orders", "order_id"),),
            checks=("method IN ('cash', 'card', 'wallet', 'bank_transfer')", "amount > 0"),
        ),
    ]
}

WAREHOUSE_TABLES = {
    t.name: t
    for t in [
        TableContract(
            "dim_date",
            (
                Column("date_key", "int", required=True),
                Column("full_date", "date", required=True),
                Column("year", "int", required=True),
                Column("quarter", "int", required=True),
                Column("month", "int", required=True),
                Column("day", "int", required=True),
                Column("month_name", "string", required=True),
                Column("day_name", "string", required=True),
                Column("day_of_week", "int", required=True),
                Column("day_of_year", "int", required=True),
                Column("week_of_year", "int", required=True),
                Column("is_weekend", "boolean", required=True),
                Column("is_leap_year", "boolean", required=True),
                Column("fiscal_year", "int", required=True),
                Column("fiscal_quarter", "int", required=True),
            ),
            "date_key",
            unique=(("full_date",),),
        ),
        TableContract(
            "dim_store",
            (
                Column("store_key", "bigint", required=True),
                Column("store_id", "bigint", required=True),
                Column("name", "string", required=True),
                Column("city", "string"),
                Column("phone", "string"),
                Column("manager", "string"),
                Column("opened_date", "date"),
            ),
            "store_key",
            unique=(("store_id",),),
        ),
        TableContract(
            "dim_employee",
            (
                Column("employee_key", "bigint", required=True),
                Column("employee_id", "bigint"),
                Column("full_name", "string", required=True),
                Column("email", "string"),
                Column("hire_date", "date"),
                Column("manager_name", "string"),
                Column("store_name", "string"),
            ),
            "employee_key",
            unique=(("employee_id",),),
        ),
        TableContract(
            "dim_product",
            (
                Column("product_key", "bigint", required=True),
                Column("product_id", "bigint", required=True),
                Column("name", "string", required=True),
                Column("brand", "string"),
                Column("category_name", "string"),
                Column("parent_category_name", "string"),
                Column("category_path", "string"),
                Column("unit_price", "decimal(10,2)"),
                Column("cost", "decimal(10,2)"),
            ),
            "product_key",
            unique=(("product_id",),),
        ),
        TableContract(
            "dim_customer",
            (
                Column("customer_key", "bigint", required=True),
                Column("customer_id", "bigint", required=True),
                Column("full_name", "string", required=True),
                Column("email", "string"),
                Column("phone", "string"),
                Column("address", "string"),
                Column("city", "string"),
                Column("state", "string"),
                Column("age", "int"),
                Column("sex", "string"),
                Column("signup_date", "date", required=True),
                Column("valid_from", "date", required=True),
                Column("valid_to", "date"),
                Column("is_current", "boolean", required=True),
            ),
            "customer_key",
            defaults={"is_current": True},
        ),
        TableContract(
            "fact_sales",
            (
                Column("sales_key", "bigint", required=True),
                Column("date_key", "int", required=True),
                Column("customer_key", "bigint", required=True),
                Column("product_key", "bigint", required=True),
                Column("store_key", "bigint", required=True),
                Column("employee_key", "bigint", required=True),
                Column("order_id", "bigint", required=True),
                Column("order_status", "string", required=True),
                Column("channel", "string", required=True),
                Column("quantity", "int", required=True),
                Column("gross_amount", "decimal(12,2)", required=True),
                Column("discount_amount", "decimal(12,2)", required=True),
                Column("net_amount", "decimal(12,2)", required=True),
                Column("cost_amount", "decimal(12,2)", required=True),
                Column("profit_amount", "decimal(12,2)", required=True),
            ),
            "sales_key",
            unique=(("order_id", "product_key"),),
            foreign=(
                ForeignKey("date_key", "dim_date", "date_key"),
                ForeignKey("customer_key", "dim_customer", "customer_key"),
                ForeignKey("product_key", "dim_product", "product_key"),
                ForeignKey("store_key", "dim_store", "store_key"),
                ForeignKey("employee_key", "dim_employee", "employee_key"),
            ),
            checks=("quantity > 0", "gross_amount >= 0", "discount_amount >= 0"),
            defaults={"discount_amount": 0},
        ),
    ]
}

# Parents before children: a table is loaded after the tables it refers to.
LOAD_ORDER = list(SOURCE_TABLES)

# Kept beside the fact, by its folders: digests for the next load and monthly partials (see operators.digests, operators.summaries).
SIDE_TABLES = {
    t.name: t
    for t in [
        TableContract(
            "fact_digest",
            (
                Column("folder", "string", required=True),
                Column("order_month", "int", required=True),
                Column("bucket", "int", required=True),
                Column("n", "bigint", required=True),
                Column("one", "bigint", required=True),
                Column("two", "bigint", required=True),
            ),
            "folder",
        ),
        TableContract(
            "fact_partial",
            (
                Column("folder", "string", required=True),
                Column("order_month", "int", required=True),
                Column("parent_category_name", "string"),
                Column("category_name", "string"),
                Column("category_path", "string"),
                Column("net", "decimal(22,2)", required=True),
                Column("gross", "decimal(22,2)", required=True),
                Column("profit", "decimal(22,2)", required=True),
                Column("quantity", "bigint", required=True),
                Column("path_orders", "bigint", required=True),
                Column("category_orders", "bigint", required=True),
                Column("parent_orders", "bigint", required=True),
                Column("orders", "bigint", required=True),
                Column("paths_digest", "bigint", required=True),
            ),
            "folder",
        ),
    ]
}
