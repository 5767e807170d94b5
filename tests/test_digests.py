"""Digests of the fact find exactly the rows that differ, and the reload reads no others."""

import pytest

from starloom.operators import digests, facts
from starloom.plans import reload
from starloom.sources.contracts import WAREHOUSE_TABLES
from starloom.sources.snapshot import SnapshotStore


def fact(spark, rows):
    """rows: (order, product, date key, quantity)."""
    made = spark.createDataFrame(rows, "order_id long, product_key long, date_key int, quantity int").selectExpr(
        "order_id * 100 + product_key AS sales_key", "date_key", "1L AS customer_key", "product_key", "2L AS store_key",
        "-1L AS employee_key", "order_id", "'shipped' AS order_status", "'online' AS channel", "quantity",
        "quantity * 2.00 AS gross_amount", "0.00 AS discount_amount", "quantity * 2.00 AS net_amount",
        "quantity * 1.00 AS cost_amount", "quantity * 1.00 AS profit_amount",
    )
    return facts.with_month(WAREHOUSE_TABLES["fact_sales"].conform(made))


def rows(n):
    return [(o, p, 20200101 + 100 * (o % 6) + o % 28, 1 + (o + p) % 5) for o in range(n) for p in range(1 + o % 3)]


@pytest.fixture
def stored(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.write_full("fact_sales", fact(spark, rows(300)))
    return store


def test_digests_do_not_depend_on_the_order_of_rows(spark):
    columns = ["order_id", "product_key", "quantity"]
    one = digests.leaves(fact(spark, rows(200)), columns)
    two = digests.leaves(fact(spark, rows(200)[::-1]).repartition(7), columns)
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    assert digests.differing_months(one, two) == []
    parts = [digests.leaves(fact(spark, rows(200)).where(f"product_key % 2 = {k}"), columns) for k in (0, 1)]
    assert digests.differing_months(one, parts[0].unionByName(parts[1])) == []


def changed(spark, scratch, store, new):
    found, old = reload.changed_rows(store, fact(spark, new), scratch)
    kinds = {r["change"]: r["count"] for r in found.groupBy("change").count().collect()}
    return kinds, sorted(r[0] for r in old.select(facts.MONTH).distinct().collect())


def test_only_months_that_differ_are_read(spark, scratch, stored):
    before = rows(300)
    assert changed(spark, scratch, stored, before) == ({}, [])
    other = [(o, p, d, q + 1) if (o, p) == (7, 1) else (o, p, d, q) for o, p, d, q in before]
    assert changed(spark, scratch, stored, other) == ({"updated": 1}, [202002])
    # A line that is gone, one that moved to another month, and a new one.
    moved = [(o, p, 20200115 if (o, p) == (9, 0) else d, q) for o, p, d, q in before if (o, p) != (8, 0)] + [(999, 0, 20200605, 1)]
    assert changed(spark, scratch, stored, moved) == ({"gone": 1, "updated": 1, "inserted": 1}, [202001, 202003, 202004, 202006])


def test_leaves_are_kept_by_folder_and_made_where_missing(spark, scratch, stored, monkeypatch):
    folders = stored.folders("fact_sales")
    stored.write_full("fact_digest", reload.stored_leaves(stored, folders, scratch))
    assert stored.read("fact_digest").select("folder").distinct().count() == len(folders)
    scanned = []
    real = stored.scan
    monkeypatch.setattr(stored, "scan", lambda t, p: (scanned.extend((t, f) for f in p), real(t, p))[1])
    assert changed(spark, scratch, stored, rows(300)) == ({}, [])
    assert not [s for s in scanned if s[0] == "fact_sales"]
    # A second folder of a month that another writer added has no leaves yet.
    stored.publish({"fact_sales": stored.stage("fact_sales", fact(spark, [(5000, 1, 20200110, 3)]))}, replace=False)
    scanned.clear()
    assert changed(spark, scratch, stored, [*rows(300), (5000, 1, 20200110, 3)]) == ({}, [])
    assert len([s for s in scanned if s[0] == "fact_sales"]) == 1


def test_rows_of_the_leaves_that_differ(spark):
    one, two = fact(spark, rows(300)), fact(spark, rows(299))
    columns = ["order_id", "quantity"]
    was, now = digests.leaves(one, columns), digests.leaves(two, columns)
    months = digests.differing_months(was, now)
    leaves = digests.differing_leaves(was, now, months)
    met = digests.rows_of(one, leaves)
    assert len(months) == leaves.count() == 1 and met.where("order_id = 299").count() == 3
    assert met.count() < 20 and met.columns == one.columns


def test_months_lie_in_order_of_the_order_id(spark, stored):
    for folder in stored.folders("fact_sales"):
        read = [r.order_id for r in spark.read.parquet(folder).coalesce(1).collect()]
        assert read == sorted(read)
