"""Monthly partials: distinct orders add up at every level, and only touched months are worked out again."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from starloom.operators import facts, summaries
from starloom.plans import categories, star as stars, trends
from starloom.sources import orderdata
from starloom.sources.contracts import WAREHOUSE_TABLES
from starloom.sources.snapshot import SnapshotStore

# product, parent, category, path; a category with two paths, and one without parent.
PRODUCTS = [
    (1, "P", "A", "P > A"), (2, "P", "A", "P > A"), (3, "P", "A", "P > A > deep"), (4, "P", "B", "P > B"),
    (5, "Q", "C", "Q > C"), (6, None, "D", "D"), (7, None, None, None),
]


def product(spark, rows=PRODUCTS):
    made = spark.createDataFrame(rows, "product_key long, parent_category_name string, category_name string, category_path string")
    return WAREHOUSE_TABLES["dim_product"].conform(
        made.selectExpr("*", "product_key AS product_id", "'x' AS name", "'b' AS brand", "1.00 AS unit_price", "1.00 AS cost")
    )


def lines(orders, seed=1):
    """(order, product, date key, status, quantity) rows; an order has one date and one status."""
    rng = random.Random(seed)
    out = []
    for o in orders:
        day = 20200101 + 100 * rng.randrange(3) + rng.randrange(28)
        status = "cancelled" if o % 9 == 0 else "shipped"
        out += [(o, p, day, status, rng.randint(1, 5)) for p in rng.sample(range(1, 8), rng.randint(1, 6))]
    return out


def fact(spark, rows):
    made = spark.createDataFrame(rows, "order_id long, product_key long, date_key int, order_status string, quantity int").selectExpr(
        "order_id * 100 + product_key AS sales_key", "date_key", "1L AS customer_key", "product_key", "2L AS store_key",
        "-1L AS employee_key", "order_id", "order_status", "'online' AS channel", "quantity", "quantity * 2.00 AS gross_amount",
        "quantity * 0.50 AS discount_amount", "quantity * 1.50 AS net_amount", "quantity * 1.00 AS cost_amount",
        "quantity * 0.50 AS profit_amount",
    )
    return WAREHOUSE_TABLES["fact_sales"].conform(made)


def test_counts_of_orders_add_up_at_every_level(spark):
    rows = lines(range(1, 200))
    got = summaries.month_partials(facts.with_month(fact(spark, rows)), product(spark)).collect()
    where = {p: tuple(rest) for p, *rest in PRODUCTS}
    sold = [(o, *where[p], d // 100, q) for o, p, d, status, q in rows if status != "cancelled"]

    def distinct(*keep):
        out = {}
        for o, *cell in sold:
            out.setdefault(tuple(cell[i] for i in keep), set()).add(o)
        return {k: len(v) for k, v in out.items()}

    def added(count, *columns):
        out = {}
        for r in got:
            key = tuple(r[c] for c in columns)
            out[key] = out.get(key, 0) + r[count]
        return out

    parent, category, path, month = *summaries.PATH, facts.MONTH
    assert added("path_orders", parent, category, path, month) == distinct(0, 1, 2, 3)
    assert added("category_orders", parent, category) == distinct(0, 1)
    assert added("category_orders", parent, category, month) == distinct(0, 1, 3)
    assert added("parent_orders", parent) == distinct(0)
    assert added("orders", month) == distinct(3)
    assert added("orders") == distinct()
    assert sum(r.quantity for r in got) == sum(q for *_, q in sold)
    assert len(got) == len(distinct(0, 1, 2, 3))


def _exchanges(plan):
    """The exchanges below a node of a plan."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _exchanges(plan.initialPlan())
    below = [plan.children().apply(i) for i in range(plan.children().size())]
    return [plan] * (plan.nodeName() == "Exchange") + [x for b in below for x in _exchanges(b)]


def test_rows_of_orders_are_shuffled_without_texts_and_measures(spark):
    plan = summaries.month_partials(facts.with_month(fact(spark, lines(range(1, 20)))), product(spark))._jdf.queryExecution()
    wide = [
        x.output().mkString(",")
        for x in _exchanges(plan.executedPlan())
        if "order_id" in x.output().mkString(",")
    ]
    assert wide and not any(c in x for x in wide for c in (*summaries.PATH, *summaries.SUMS.values()))


def test_parts_without_common_orders_stack(spark):
    whole = facts.with_month(fact(spark, lines(range(1, 80))))
    parts = [summaries.month_partials(whole.where(f"order_id % 2 = {k}"), product(spark)) for k in (0, 1)]
    both = parts[0].unionByName(parts[1]).agg(F.sum("orders"), F.sum("parent_orders"), F.sum("net")).first()
    assert both == summaries.month_partials(whole, product(spark)).agg(F.sum("orders"), F.sum("parent_orders"), F.sum("net")).first()


@pytest.fixture
def stored(spark, tmp_path):
    from starloom.operators.dimensions import build_dim_date

    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.write_full("dim_date", build_dim_date(spark, date(2020, 1, 1), date(2020, 12, 31)))
    store.write_full("dim_product", product(spark))
    store.write_full("fact_sales", fact(spark, lines(range(1, 60))))
    return store


def keep_partials(store, scratch):
    store.write_full("fact_partial", stars.stored_partials(store, scratch))


def scans(monkeypatch, store):
    seen = []
    real = store.scan
    monkeypatch.setattr(store, "scan", lambda t, p: (seen.extend(f for f in p if t == "fact_sales"), real(t, p))[1])
    return seen


def answers(star):
    return [q(star).collect() for q in (trends.monthly_trend, trends.category_monthly, categories.category_rollup)]


def test_an_upsert_leaves_only_its_months_to_work_out(spark, scratch, stored, monkeypatch):
    keep_partials(stored, scratch)
    late = [(500, p, 20200215, "shipped", 3) for p in (1, 3, 5)]
    assert stored.upsert_fact(fact(spark, late)) == [202002]
    seen = scans(monkeypatch, stored)
    got = answers(stars.StoredStar(stored, scratch))
    assert {f[-6:] for f in seen} == {"202002"}
    keep_partials(stored, scratch)
    seen.clear()
    again = answers(stars.StoredStar(stored, scratch))
    assert not seen and again == got
    # The same as from nothing.
    stored.write_full("fact_partial", stored.read("fact_partial").limit(0))
    assert answers(stars.StoredStar(stored, scratch)) == got and len(seen) >= 3


def test_partials_do_not_outlive_the_paths_they_were_made_for(spark, scratch, stored):
    keep_partials(stored, scratch)
    moved = [(p, "R", "Z", "R > Z") if p == 1 else (p, *rest) for p, *rest in PRODUCTS]
    stored.write_full("dim_product", product(spark, moved))
    rolled = categories.category_rollup(stars.StoredStar(stored, scratch)).collect()
    assert any(r.parent_category == "R" and r.category == "Z" for r in rolled)


def test_no_sales(spark, scratch):
    empty = facts.with_month(fact(spark, lines(range(1, 3))).where("false"))
    assert summaries.month_partials(empty, product(spark)).collect() == []
    assert summaries.paths_digest(product(spark).where("false")).first()["digest"] == 0


def test_raw_rows_without_a_partner_are_counted(spark):
    frames = {
        "orders": spark.createDataFrame([(1, 10), (2, 11), (3, 99), (4, None)], "o_orderkey long, o_custkey long"),
        "lineitem": spark.createDataFrame([(1, 5), (1, 77), (9, 5), (3, None), (4, 5)], "l_orderkey long, l_partkey long"),
        "customer": spark.createDataFrame([(10, 1), (11, 2), (12, 8)], "c_custkey long, c_nationkey long"),
        "part": spark.createDataFrame([(5,)], "p_partkey long"),
        "nation": spark.createDataFrame([(1, 1), (2, 4)], "n_nationkey long, n_regionkey long"),
        "region": spark.createDataFrame([(1,)], "r_regionkey long"),
    }
    got = {r.rule: r.violations for r in orderdata.unmapped(frames.__getitem__).collect()}
    assert got == {
        "raw order without lines": 1,
        "raw order without customer": 2,
        "raw line without order": 1,
        "raw line without product": 2,
        "raw customer without nation": 2,
    }


def test_reports_follow_the_last_order(spark, tmp_path):
    """Orders three years later move the day that reports are of."""
    from starloom.plans.warehouse import Warehouse, WarehouseDates

    for table in "region nation customer supplier part lineitem".split():
        spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    later = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").withColumn("o_orderdate", F.expr("o_orderdate + interval 3 years"))
    later.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    w = Warehouse(spark, str(tmp_path))
    assert w.as_of == date(2004, 8, 2) and w.calendar[1] == date(2004, 12, 31)
    assert Warehouse(spark, str(tmp_path), WarehouseDates(as_of=date(2010, 1, 1))).as_of == date(2010, 1, 1)
    from starloom.plans import customers

    assert customers.rfm(w, w.as_of).where("recency_days < 1").count() == 0
