"""The warehouse test suite: 54 checks of expected against actual, and reconciliations.

Checks that read the same rows share one pass. Every function returns report rows
(ord, dimension, check_name, expected, actual); ``validate`` joins them and adds the
verdict.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.functions import labels
from starloom.functions.exprs import any_changed, date_key, rounded_ratio, pct
from starloom.operators.checks import (
    constraint_report,
    count_where,
    duplicate_keys,
    missing_parents,
    reconcile,
    report_rows,
    stack_rows,
    with_verdict,
)
from starloom.operators.selection import median, sum_of_largest
from starloom.plans.star import Star
from starloom.sources.contracts import SOURCE_TABLES

Source = Mapping[str, DataFrame]
# Number, table and text of every check.
CHECKS = {
    1: ("dim_date", "one row per day of the calendar"),
    2: ("dim_date", "days without a row"),
    3: ("dim_date", "date_key differs from the date"),
    4: ("dim_date", "month or day name with blanks around it"),
    5: ("dim_date", "day_of_week outside 1 to 7"),
    6: ("dim_date", "weekend flag contradicts the day of the week"),
    7: ("dim_date", "leap flag contradicts the length of the year"),
    8: ("dim_date", "fiscal year turns on 17 July"),
    9: ("dim_date", "fiscal quarters start on the 17th"),
    10: ("dim_date", "orders on a day that is not in the calendar"),
    20: ("dim_store", "as many rows as the source"),
    21: ("dim_store", "source stores that are missing or differ"),
    22: ("dim_store", "store_id held by several rows"),
    30: ("dim_employee", "source rows and the unknown member"),
    31: ("dim_employee", "unknown member present once"),
    32: ("dim_employee", "source employees that are missing"),
    33: ("dim_employee", "manager name differs from the manager's row"),
    34: ("dim_employee", "employees without a store name"),
    40: ("dim_product", "as many rows as the source"),
    41: ("dim_product", "source products that are missing or differ"),
    42: ("dim_product", "products without a category"),
    43: ("dim_product", "category name differs from the source"),
    44: ("dim_product", "parent name differs from the tree"),
    45: ("dim_product", "path is not parent and category"),
    46: ("dim_product", "one path per category in use"),
    50: ("dim_customer", "as many customers as the source"),
    51: ("dim_customer", "customers with several open rows"),
    52: ("dim_customer", "source customers without an open row"),
    53: ("dim_customer", "open rows with an end date"),
    54: ("dim_customer", "closed rows without an end date"),
    55: ("dim_customer", "rows that end before they start"),
    56: ("dim_customer", "versions that do not meet their successor"),
    57: ("dim_customer", "open rows that differ from the source"),
    58: ("dim_customer", "first version does not start at signup"),
    59: ("dim_customer", "orders before the first version"),
    70: ("fact_sales", "as many rows as source lines"),
    71: ("fact_sales", "net revenue of the source"),
    72: ("fact_sales", "gross revenue of the source"),
    73: ("fact_sales", "net is not gross less discount"),
    74: ("fact_sales", "profit is not net less cost"),
    75: ("fact_sales", "gross is not quantity times line price"),
    76: ("fact_sales", "cost is not quantity times product cost"),
    77: ("fact_sales", "date key differs from the order date"),
    78: ("fact_sales", "store key leads to another store"),
    79: ("fact_sales", "product key leads to no line of the order"),
    80: ("fact_sales", "customer version not valid on the order date"),
    81: ("fact_sales", "unknown employee on a store order"),
    82: ("fact_sales", "employee on an online order"),
    83: ("fact_sales", "employee key leads to another employee"),
    84: ("fact_sales", "order and product held by several rows"),
    85: ("fact_sales", "status or channel differs from the order"),
    86: ("fact_sales", "negative quantity or amount"),
    87: ("fact_sales", "stores whose revenue differs from the source"),
    88: ("fact_sales", "months whose revenue differs from the source"),
}



def _zero(number: int, column: str) -> tuple[int, Column, Column]:
    """A check that passes when a count of violations is zero."""
    return number, F.lit(0), F.col(column)


def _rows(probe: DataFrame, checks: Sequence[tuple[int, Column, Column]]) -> DataFrame:
    return report_rows(probe, [(n, *CHECKS[n], want, got) for n, want, got in checks])


def _beside(probe: DataFrame, other: DataFrame) -> DataFrame:
    """Two one-row tables as one row; the other one is a single scalar subquery."""
    packed = other.select(F.struct("*").alias("x")).scalar()
    return probe.withColumn("_other", packed).select(*probe.columns, "_other.*")


def _side(df: DataFrame, value: Column) -> Column:
    """One aggregate of another table, as a scalar subquery."""
    return df.agg(value.alias("x")).scalar()


def check_dim_date(star: Star, source: Source, start: date, end: date) -> DataFrame:
    d = star.dim_date
    day = F.col("full_date")
    local = d.agg(
        F.count("*").alias("n"),
        (F.datediff(F.max(day), F.min(day)) + 1 - F.count("*")).alias("gaps"),
        count_where(F.col("date_key") != date_key(day)).alias("bad_key"),
        count_where(
            (F.col("month_name") != F.trim("month_name")) | (F.col("day_name") != F.trim("day_name"))
        ).alias("padded"),
        count_where(~F.col("day_of_week").between(1, 7)).alias("bad_weekday"),
        count_where(F.col("is_weekend") != (F.col("day_of_week") >= 6)).alias("bad_weekend"),
    )
    years = d.groupBy("year").agg(
        F.bool_or("is_leap_year").alias("flagged"), F.count("*").alias("days")
    )
    # The fiscal boundaries of the middle of the calendar, as far as a single year has them.
    y = (start.year + end.year) // 2
    turns = [date(y, 7, 16), date(y, 7, 17), date(y, 10, 17), date(y + 1, 1, 17), date(y + 1, 4, 17)]
    turns = [t for t in turns if t <= end]
    # At most five rows.
    edge = d.filter(day.isin(turns)).agg(
        F.array_sort(F.collect_list(F.struct("full_date", "fiscal_year", "fiscal_quarter"))).alias("e")
    ).select(
        F.array_join(F.transform(F.slice("e", 1, 2), lambda x: x["fiscal_year"].cast("string")), "|").alias("years"),
        F.array_join(F.transform(F.slice("e", 2, 4), lambda x: x["fiscal_quarter"].cast("string")), "|").alias("quarters"),
    )
    probe = _beside(local, edge).select(
        "*",
        _side(years, count_where(F.col("flagged") != (F.col("days") == 366))).alias("bad_leap"),
        _side(
            missing_parents(source["orders"], "order_date", d, "full_date"),
            F.coalesce(F.sum("count"), F.lit(0)),
        ).alias("uncovered"),
    )
    days = (end - start).days + 1
    return _rows(
        probe,
        [
            (1, F.lit(days), F.col("n")),
            _zero(2, "gaps"),
            _zero(3, "bad_key"),
            _zero(4, "padded"),
            _zero(5, "bad_weekday"),
            _zero(6, "bad_weekend"),
            _zero(7, "bad_leap"),
            (8, F.lit(f"{y - 1}|{y}"), F.col("years")),
            (9, F.lit("|".join("1234"[: len(turns) - 1])), F.col("quarters")),
            _zero(10, "uncovered"),
        ],
    )


def check_dims(star: Star, source: Source) -> DataFrame:
    """Store, employee and product dimensions against their sources."""

    def compared(left, right, key, columns, kind="left"):
        a, b = left.alias("s"), right.alias("d")
        joined = a.join(b, F.col(f"s.{key}") == F.col(f"d.{key}"), kind)
        return joined.agg(
            count_where(F.col(f"d.{key}").isNull() | any_changed("s", "d", columns)).alias("x")
        ).scalar()

    def rows(df):
        return _side(df, F.count("*"))

    def orphans(child, parent, key):
        return _side(missing_parents(child, key, parent, key), F.coalesce(F.sum("count"), F.lit(0)))

    one = star.dim_date.sparkSession.range(1)
    stores, employees, products = source["stores"], source["employees"], source["products"]
    store, employee, product = star.dim_store, star.dim_employee, star.dim_product
    store_probe = one.select(
        rows(stores).alias("source_n"),
        rows(store).alias("n"),
        compared(stores, store, "store_id", ["name", "city", "manager", "opened_date"]).alias("differ"),
        _side(duplicate_keys(store, ["store_id"]), F.count("*")).alias("twice"),
    )
    bosses = employees.select(
        F.col("employee_id").alias("manager_id"),
        F.concat("first_name", F.lit(" "), "last_name").alias("manager_name"),
    )
    wanted = employees.join(bosses, "manager_id", "left").select("employee_id", "manager_name")
    real = F.col("employee_key") != labels.UNKNOWN_EMPLOYEE_KEY
    # Inner comparison: a missing employee is check 32 and not 33.
    employee_probe = one.select(
        rows(employees).alias("source_n"),
        rows(employee).alias("n"),
        _side(employee, count_where(~real)).alias("unknown"),
        orphans(employees, employee, "employee_id").alias("missing"),
        compared(wanted, employee, "employee_id", ["manager_name"], "inner").alias("bad_manager"),
        _side(employee, count_where(real & F.col("store_name").isNull())).alias("no_store"),
    )
    tree = source["categories"]
    parents = tree.select(
        F.col("category_id").alias("parent_category_id"), F.col("name").alias("parent_category_name")
    )
    placed = products.join(
        tree.join(parents, "parent_category_id", "left").select(
            "category_id", F.col("name").alias("category_name"), "parent_category_name"
        ),
        "category_id",
    ).select("product_id", "category_name", "parent_category_name")
    path = F.concat("parent_category_name", F.lit(" > "), "category_name")
    product_probe = one.select(
        rows(products).alias("source_n"),
        rows(product).alias("n"),
        compared(products, product, "product_id", ["unit_price", "cost", "name", "brand"]).alias("differ"),
        _side(product, count_where(F.col("category_name").isNull())).alias("no_category"),
        compared(placed, product, "product_id", ["category_name"], "inner").alias("bad_category"),
        compared(placed, product, "product_id", ["parent_category_name"], "inner").alias("bad_parent"),
        _side(
            product,
            count_where(F.col("parent_category_name").isNotNull() & (F.col("category_path") != path)),
        ).alias("bad_path"),
        _side(products, F.countDistinct("category_id")).alias("leaves"),
        _side(product, F.countDistinct("category_path")).alias("paths"),
    )
    return stack_rows(
        [
            _rows(
                store_probe,
                [
                    (20, F.col("source_n"), F.col("n")),
                    _zero(21, "differ"),
                    _zero(22, "twice"),
                ],
            ),
            _rows(
                employee_probe,
                [
                    (30, F.col("source_n") + 1, F.col("n")),
                    (31, F.lit(1), F.col("unknown")),
                    _zero(32, "missing"),
                    _zero(33, "bad_manager"),
                    _zero(34, "no_store"),
                ],
            ),
            _rows(
                product_probe,
                [
                    (40, F.col("source_n"), F.col("n")),
                    _zero(41, "differ"),
                    _zero(42, "no_category"),
                    _zero(43, "bad_category"),
                    _zero(44, "bad_parent"),
                    _zero(45, "bad_path"),
                    (46, F.col("leaves"), F.col("paths")),
                ],
            ),
        ]
    )


def check_history(star: Star, source: Source) -> DataFrame:
    """The Type 2 customer dimension: keys, intervals, attributes, first versions."""
    c, customers = star.dim_customer, source["customers"]
    current = F.col("is_current")
    # One pass per key over the versions, in order, covers all timeline rules.
    seq = Window.partitionBy("customer_id").orderBy("valid_from", F.col("valid_to").asc_nulls_last())
    following = F.lead("valid_from").over(seq)
    timeline = c.select(
        "*",
        (following.isNotNull() & ~F.col("valid_to").eqNullSafe(following)).alias("_broken"),
        (F.row_number().over(seq) == 1).alias("_is_first"),
    )
    per_key = timeline.groupBy("customer_id").agg(
        F.count(F.when(current, 1)).alias("open_rows"),
        F.min("valid_from").alias("first_from"),
        count_where(current & F.col("valid_to").isNotNull()).alias("open_ended"),
        count_where(~current & F.col("valid_to").isNull()).alias("closed_no_end"),
        count_where(F.col("valid_to").isNotNull() & (F.col("valid_from") > F.col("valid_to"))).alias(
            "backwards"
        ),
        count_where(F.col("_broken")).alias("broken"),
        count_where(F.col("_is_first") & (F.col("valid_from") != F.col("signup_date"))).alias(
            "not_backdated"
        ),
    )
    local = per_key.agg(
        F.count("*").alias("n"),
        # A key without any open row is check 52.
        count_where(F.col("open_rows") > 1).alias("several_open"),
        *[
            F.coalesce(F.sum(x), F.lit(0)).alias(x)
            for x in ("open_ended", "closed_no_end", "backwards", "broken", "not_backdated")
        ],
    )
    s = customers.withColumn("full_name", F.concat("first_name", F.lit(" "), "last_name")).alias("s")
    d = c.filter(current).alias("d")
    against = s.join(d, F.col("s.customer_id") == F.col("d.customer_id"), "left").agg(
        F.count_distinct("s.customer_id").alias("source_n"),
        count_where(F.col("d.customer_id").isNull()).alias("no_open"),
        count_where(
            F.col("d.customer_id").isNotNull()
            & any_changed("s", "d", ["city", "state", "email", "address", "full_name"])
        ).alias("differ"),
    )
    first_orders = source["orders"].groupBy("customer_id", "order_date").agg(F.count("*").alias("n"))
    starts = c.groupBy("customer_id").agg(F.min("valid_from").alias("first_from"))
    early = first_orders.join(starts, "customer_id").agg(
        F.coalesce(F.sum(F.when(F.col("order_date") < F.col("first_from"), F.col("n"))), F.lit(0)).alias("x")
    )
    probe = _beside(local, against).withColumn("early", early.scalar())
    return _rows(
        probe,
        [
            (50, F.col("source_n"), F.col("n")),
            _zero(51, "several_open"),
            _zero(52, "no_open"),
            _zero(53, "open_ended"),
            _zero(54, "closed_no_end"),
            _zero(55, "backwards"),
            _zero(56, "broken"),
            _zero(57, "differ"),
            _zero(58, "not_backdated"),
            _zero(59, "early"),
        ],
    )


def check_fact(star: Star, source: Source) -> DataFrame:
    """The fact against its source lines, its own measures, and its dimensions."""
    fact, items, orders = star.fact_sales, source["order_items"], source["orders"]
    value = F.col("quantity") * F.col("unit_price")
    source_side = items.agg(
        F.count("*").alias("source_n"),
        F.sum(value - F.col("discount")).cast("decimal(28,2)").alias("source_net"),
        F.sum(value).cast("decimal(28,2)").alias("source_gross"),
    )
    unknown = F.col("employee_key") == labels.UNKNOWN_EMPLOYEE_KEY
    online = F.col("channel") == labels.ONLINE
    local = fact.agg(
        F.count("*").alias("n"),
        F.sum("net_amount").cast("decimal(28,2)").alias("net"),
        F.sum("gross_amount").cast("decimal(28,2)").alias("gross"),
        count_where(F.col("net_amount") != F.col("gross_amount") - F.col("discount_amount")).alias(
            "bad_net"
        ),
        count_where(F.col("profit_amount") != F.col("net_amount") - F.col("cost_amount")).alias(
            "bad_profit"
        ),
        count_where(unknown & ~online).alias("unknown_in_store"),
        count_where(online & ~unknown).alias("online_employee"),
        count_where(
            (F.col("quantity") <= 0) | (F.col("gross_amount") < 0) | (F.col("discount_amount") < 0)
        ).alias("negative"),
    )
    # Keys and states are those of an order, so its lines are one row in these joins.
    per_order = fact.groupBy(
        "order_id", "date_key", "customer_key", "store_key", "employee_key", "order_status", "channel"
    ).agg(F.count("*").alias("n"))
    o = orders.select(
        "order_id",
        "order_date",
        F.col("customer_id").alias("o_customer"),
        F.col("store_id").alias("o_store"),
        F.col("employee_id").alias("o_employee"),
        F.col("status").alias("o_status"),
        F.col("channel").alias("o_channel"),
    )
    v = star.dim_customer.select(
        "customer_key", F.col("customer_id").alias("v_customer"), "valid_from", "valid_to"
    )
    st = star.dim_store.select("store_key", F.col("store_id").alias("d_store"))
    # The unknown member is hot and needs no partner: each order with it has a key of its own.
    key = lambda alone: F.struct("employee_key", alone.alias("alone")).alias("_staff")
    e = star.dim_employee.select(
        key(F.lit(None).cast("bigint")), F.col("employee_id").alias("d_employee")
    )
    resolved = (
        per_order.withColumn("_staff", key(F.when(unknown, F.col("order_id"))))
        .join(o, "order_id", "left")
        .join(v, "customer_key", "left")
        .join(st, "store_key", "left")
        .join(e, "_staff", "left")
    )
    day = F.col("order_date")
    lines_where = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    of_orders = resolved.agg(
        lines_where(F.col("date_key") != date_key(day)).alias("bad_date"),
        lines_where(F.col("d_store") != F.col("o_store")).alias("bad_store"),
        lines_where(
            (F.col("v_customer") != F.col("o_customer"))
            | (day < F.col("valid_from"))
            | (F.col("valid_to").isNotNull() & (day >= F.col("valid_to")))
        ).alias("bad_version"),
        lines_where(
            ~unknown & day.isNotNull() & ~F.col("d_employee").eqNullSafe(F.col("o_employee"))
        ).alias("bad_employee"),
        lines_where(
            (F.col("order_status") != F.col("o_status")) | (F.col("channel") != F.col("o_channel"))
        ).alias("bad_status"),
    )
    # What is left concerns a line and its product.
    p = star.dim_product.select("product_key", "product_id", "cost")
    line = items.select(
        "order_id", "product_id", F.col("unit_price").alias("line_price"), F.lit(True).alias("has_line")
    )
    of_lines = (
        fact.join(p, "product_key", "left")
        .join(line, ["order_id", "product_id"], "left")
        .agg(
            count_where(F.col("gross_amount") != F.col("quantity") * F.col("line_price")).alias(
                "bad_gross"
            ),
            count_where(F.col("cost_amount") != F.col("quantity") * F.col("cost")).alias("bad_cost"),
            count_where(F.col("product_id").isNotNull() & F.col("has_line").isNull()).alias("no_line"),
        )
    )
    by_store, by_month = reconcile_store(star, source), reconcile_month(star, source)
    probe = _beside(_beside(_beside(local, source_side), of_orders), of_lines).select(
        "*",
        _side(duplicate_keys(fact, ["order_id", "product_key"]), F.count("*")).alias("twice"),
        _side(by_store, count_where(F.col("differs"))).alias("store_differs"),
        _side(by_month, count_where(F.col("differs"))).alias("month_differs"),
    )
    return _rows(
        probe,
        [
            (70, F.col("source_n"), F.col("n")),
            (71, F.col("source_net"), F.col("net")),
            (72, F.col("source_gross"), F.col("gross")),
            _zero(73, "bad_net"),
            _zero(74, "bad_profit"),
            _zero(75, "bad_gross"),
            _zero(76, "bad_cost"),
            _zero(77, "bad_date"),
            _zero(78, "bad_store"),
            _zero(79, "no_line"),
            _zero(80, "bad_version"),
            _zero(81, "unknown_in_store"),
            _zero(82, "online_employee"),
            _zero(83, "bad_employee"),
            _zero(84, "twice"),
            _zero(85, "bad_status"),
            _zero(86, "negative"),
            _zero(87, "store_differs"),
            _zero(88, "month_differs"),
        ],
    )


def _source_net(source: Source, columns: list[Column]) -> DataFrame:
    """Net value per order joined to order attributes; lines are summed before the join."""
    net = F.sum(F.col("quantity") * F.col("unit_price") - F.col("discount"))
    per_order = source["order_items"].groupBy("order_id").agg(net.alias("net"))
    return per_order.join(source["orders"], "order_id").select(*columns, "net")


def reconcile_store(star: Star, source: Source) -> DataFrame:
    """Net revenue per store, warehouse against source."""
    per_store = star.fact_sales.groupBy("store_key").agg(F.sum("net_amount").alias("net"))
    dw = per_store.join(star.dim_store.select("store_key", "store_id"), "store_key")
    src = _source_net(source, [F.col("store_id")])
    return reconcile(dw, src, ["store_id"], "net", ("warehouse_net", "source_net")).orderBy("store_id")


def reconcile_month(star: Star, source: Source) -> DataFrame:
    """Net revenue per month, warehouse against source."""
    per_day = star.fact_sales.groupBy("date_key").agg(F.sum("net_amount").alias("net"))
    dw = per_day.join(star.dim_date.select("date_key", "year", "month"), "date_key")
    src = _source_net(source, [F.year("order_date").alias("year"), F.month("order_date").alias("month")])
    return reconcile(dw, src, ["year", "month"], "net", ("warehouse_net", "source_net")).orderBy(
        "year", "month"
    )


def validate(star: Star, source: Source, start: date, end: date) -> DataFrame:
    """All 54 checks with their verdict, in order."""
    report = stack_rows(
        [
            check_dim_date(star, source, start, end),
            check_dims(star, source),
            check_history(star, source),
            check_fact(star, source),
        ]
    )
    return with_verdict(report).orderBy("ord")


def source_constraints(source: Source) -> DataFrame:
    """Violations of every declared rule of the source tables."""
    return constraint_report(dict(source), SOURCE_TABLES).orderBy("table_name", "rule")


def business_rules(source: Source, unmapped: DataFrame | None = None) -> DataFrame:
    """Rules that no key or check can express, with the number of violations; ``unmapped`` has those of the raw data."""
    orders, items, payments = source["orders"], source["order_items"], source["payments"]
    lines = items.groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price") - F.col("discount")).alias("lines_total")
    )
    paid = payments.groupBy("order_id").agg(
        F.sum("amount").alias("paid"), F.count("*").alias("n_payments")
    )
    opened = source["stores"].select("store_id", "opened_date")
    signed = source["customers"].select("customer_id", "signup_date")
    due = F.col("status").isin(*labels.PAID_STATUSES)
    checked = (
        orders.join(lines, "order_id", "left")
        .join(paid, "order_id", "left")
        .join(opened, "store_id", "left")
        .join(signed, "customer_id", "left")
        .agg(
            count_where(~F.col("total_amount").eqNullSafe(F.col("lines_total"))).alias("total"),
            count_where(due & F.col("paid").isNull()).alias("unpaid"),
            count_where(~due & F.col("paid").isNotNull()).alias("paid_early"),
            count_where(F.col("paid") != F.col("total_amount")).alias("amount"),
            count_where(
                (F.col("channel") == labels.ONLINE) != F.col("employee_id").isNull()
            ).alias("employee"),
            count_where(F.col("order_date") < F.col("opened_date")).alias("before_opening"),
            count_where(F.col("order_date") < F.col("signup_date")).alias("before_signup"),
        )
    )
    names = {
        "total": "order total differs from its lines",
        "unpaid": "order in a paid status without payment",
        "paid_early": "payment of an order in an unpaid status",
        "amount": "payments differ from the order total",
        "employee": "online with employee, or in store without",
        "before_opening": "order before its store opened",
        "before_signup": "order before the customer signed up",
    }
    rows = [F.struct(F.lit(n).alias("rule"), F.col(c).alias("violations")) for c, n in names.items()]
    found = checked.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return (found if unmapped is None else found.unionByName(unmapped)).orderBy("rule")


def distribution_sanity(star: Star, source: Source) -> DataFrame:
    """Shape of the data: November lift of each year, product concentration, orders per customer."""
    orders = source["orders"]
    in_month = lambda m: count_where(F.month("order_date") == m)
    season = orders.groupBy(F.year("order_date").alias("y")).agg(
        in_month(10).alias("october"), in_month(11).alias("november")
    )
    yearly = [
        ("orders in October", F.col("october")),
        ("orders in November", F.col("november")),
        ("November lift", rounded_ratio("november", "october", 2)),
    ]
    seasons = season.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.concat_ws(" ", F.lit(n), F.col("y")).alias("metric"),
                        v.cast("double").alias("value"),
                    )
                    for n, v in yearly
                ]
            )
        ).alias("m")
    ).select("m.*")

    # Both are written once, as the passes of a selection read them anew.
    products = star.scratch.save(
        star.fact_sales.groupBy("product_key").agg(F.sum("net_amount").alias("revenue")), "revenues"
    )
    top = sum_of_largest(products, "revenue", lambda n: n // 5)
    kind = products.schema["revenue"].dataType
    concentration = products.agg(F.sum("revenue").alias("whole")).withColumn("top", F.lit(top).cast(kind))

    per_customer = star.scratch.save(
        orders.groupBy("customer_id").agg(F.count("*").alias("n")), "orders_per_customer"
    )
    spread = per_customer.agg(
        F.sum("n").alias("orders"),
        F.count("*").alias("buyers"),
        F.max("n").alias("most"),
    ).withColumn("median", F.lit(median(per_customer, "n")).cast("double"))
    silent = source["customers"].join(per_customer, "customer_id", "left_anti")
    probe = _beside(spread, concentration).withColumn(
        "silent", _side(silent, F.count("*"))
    )
    metrics = {
        "revenue share of the top fifth of products": pct("top", "whole", 1),
        "orders per buyer, mean": rounded_ratio("orders", "buyers", 2),
        "orders per buyer, median": F.col("median"),
        "orders per buyer, maximum": F.col("most"),
        "customers without orders": F.col("silent"),
    }
    rows = [
        F.struct(F.lit(n).alias("metric"), v.cast("double").alias("value"))
        for n, v in metrics.items()
    ]
    overall = probe.select(F.explode(F.array(*rows)).alias("m")).select("m.*")
    return seasons.unionByName(overall).orderBy("metric")
