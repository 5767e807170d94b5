from datetime import date
from decimal import Decimal

import pytest

from starloom.operators import facts
from starloom.sources.snapshot import SnapshotStore

D = date


@pytest.fixture(scope="module")
def star(spark):
    orders = spark.createDataFrame(
        [
            (1, 9, 5, None, D(2020, 6, 30), "online", "shipped"),
            (2, 9, 5, 3, D(2020, 7, 1), "in-store", "pending"),
            (3, 9, 5, 4, D(2020, 8, 1), "in-store", "cancelled"),
        ],
        "order_id long, customer_id long, store_id long, employee_id long, order_date date,"
        "channel string, status string",
    )
    items = spark.createDataFrame(
        [
            (11, 1, 7, 2, Decimal("10.00"), Decimal("1.50")),
            (12, 2, 7, 1, Decimal("10.00"), Decimal("0.00")),
            (13, 2, 8, 3, Decimal("5.00"), Decimal("0.00")),
            (14, 3, 8, 1, Decimal("5.00"), Decimal("0.00")),
        ],
        "order_item_id long, order_id long, product_id long, quantity int,"
        "unit_price decimal(10,2), discount decimal(10,2)",
    )
    customer = spark.createDataFrame(
        [(1, 9, D(2020, 1, 1), D(2020, 7, 1)), (2, 9, D(2020, 7, 1), None)],
        "customer_key long, customer_id long, valid_from date, valid_to date",
    )
    product = spark.createDataFrame(
        [(70, 7, Decimal("6.00")), (80, 8, Decimal("2.00"))],
        "product_key long, product_id long, cost decimal(10,2)",
    )
    store = spark.createDataFrame([(50, 5)], "store_key long, store_id long")
    employee = spark.createDataFrame(
        [(-1, None), (30, 3), (40, 4)], "employee_key long, employee_id long"
    )
    return items, orders, customer, product, store, employee


def test_fact_build(star):
    rows = {r.sales_key: r for r in facts.build_fact_sales(*star).collect()}
    assert len(rows) == 4
    # The order before the change uses the old version, the one on the day the new one.
    assert {k: r.customer_key for k, r in rows.items()} == {11: 1, 12: 2, 13: 2, 14: 2}
    assert {k: r.employee_key for k, r in rows.items()} == {11: -1, 12: 30, 13: 30, 14: 40}
    assert {k: r.date_key for k, r in rows.items()} == {
        11: 20200630, 12: 20200701, 13: 20200701, 14: 20200801,
    }
    first = rows[11]
    assert (first.gross_amount, first.net_amount, first.cost_amount, first.profit_amount) == (
        Decimal("20.00"), Decimal("18.50"), Decimal("12.00"), Decimal("6.50"),
    )


def test_fact_upsert_touches_only_its_months(spark, scratch, star):
    current = scratch.save(facts.build_fact_sales(*star), "fact", (facts.MONTH,))
    items, orders, *dimensions = star
    moved = orders.filter("order_id = 2").withColumn(
        "order_date", orders.order_date + 62
    )  # from July to September
    new_items = items.filter("order_id = 2 AND product_id = 7").selectExpr(
        "order_item_id + 100 AS order_item_id", "order_id", "product_id", "quantity + 4 AS quantity",
        "unit_price", "discount",
    )
    incoming = scratch.save(
        facts.build_fact_sales(new_items, moved, *dimensions), "late", (facts.MONTH,)
    )
    merged, months = facts.upsert_fact(current, incoming)
    assert months == [202007, 202009]
    got = sorted((r.sales_key, r.date_key, r.quantity) for r in merged.collect())
    # The key of the known line survives; the other July line is carried over.
    assert got == [(12, 20200901, 5), (13, 20200701, 3)]
    untouched = current.filter(~current[facts.MONTH].isin(months)).count()
    assert untouched == 2


def test_fact_upsert_twice_changes_nothing(spark, scratch, star):
    current = scratch.save(facts.build_fact_sales(*star), "fact", (facts.MONTH,))
    merged, months = facts.upsert_fact(current, current)
    same = merged.select(*current.columns)
    assert months == [202006, 202007, 202008]
    assert same.exceptAll(current).count() == current.exceptAll(same).count() == 0


def test_store_rewrites_only_touched_months(spark, scratch, star, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.write_full("fact_sales", facts.build_fact_sales(*star))
    before = store._latest()[1]["fact_sales"]
    assert [p[-6:] for p in before] == ["202006", "202007", "202008"]
    items, orders, *dimensions = star
    late = orders.filter("order_id = 2").withColumn("order_date", orders.order_date + 62)
    incoming = scratch.save(
        facts.build_fact_sales(items, late, *dimensions).drop(facts.MONTH), "late"
    )
    assert store.upsert_fact(incoming) == [202007, 202009]
    after = store._latest()[1]["fact_sales"]
    # July is empty now; June and August are the same folders as before.
    assert sorted(p[-6:] for p in after) == ["202006", "202008", "202009"]
    assert set(before) & set(after) == {before[0], before[2]}
    rows = {r.sales_key: r.date_key for r in store.read("fact_sales").collect()}
    assert rows == {11: 20200630, 12: 20200901, 13: 20200901, 14: 20200801}


def test_upsert_refuses_rows_that_repeat_their_grain(spark, scratch, star, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    fact = scratch.save(facts.build_fact_sales(*star).drop(facts.MONTH), "fact")
    store.write_full("fact_sales", fact)
    with pytest.raises(ValueError, match="repeat their grain"):
        store.upsert_fact(fact.union(fact))
    with pytest.raises(ValueError, match="repeat their grain"):
        facts.upsert_fact(facts.with_month(fact), facts.with_month(fact.union(fact)))
    assert store.read("fact_sales").count() == fact.count()
    assert store.upsert_fact(fact.limit(0)) == []


def test_the_fact_is_gathered_by_month_only_where_it_is_stored_so(star):
    """Its lines go through the exchanges of the join by order, and no other."""
    plan = facts.build_fact_sales(*star)._jdf.queryExecution().executedPlan().toString()
    assert facts.MONTH in plan and "REBALANCE" not in plan
    assert "REBALANCE" in facts.by_month(facts.build_fact_sales(*star))._jdf.queryExecution().executedPlan().toString()
