from pathlib import Path

import pytest
from pyspark.errors import PySparkException

from starloom.sources import csv_io
from starloom.sources.contracts import LOAD_ORDER, SOURCE_TABLES
from starloom.sources.snapshot import PublishConflict, SnapshotStore

FILES = {
    "categories": "category_id,name,parent_category_id\n1,Top,\n2,Leaf,1.0\n",
    "stores": "store_id,name,phone,city,opened_date,manager\n1,S,555,\"C, D\",2020-01-01,M\n",
    "customers": "customer_id,first_name,last_name,email,phone,address,city,state,signup_date,age,sex\n"
    "1,A,B,a@x,1,Street,C,S,2020-02-01,30,F\n",
    "products": "product_id,category_id,name,brand,unit_price,cost\n1,2,P,B,10.00,6.00\n",
    "employees": "employee_id,first_name,last_name,email,phone,hire_date,manager_id,store_id\n"
    "1,E,F,e@x,1,2020-01-01,,1\n",
    # The columns are in another order, and channel and status are left to their defaults.
    "orders": "order_id,store_id,customer_id,employee_id,order_date,total_amount\n"
    "1,1,1,,2020-03-01,19.00\n2,1,1,1.0,2020-03-02,10.00\n",
    "order_items": "order_item_id,order_id,product_id,quantity,unit_price,discount\n"
    "1,1,1,2,10.00,1.00\n2,2,1,1,10.00,0.00\n",
    "inventory": "inventory_id,store_id,product_id,quantity,last_restock_date\n1,1,1,5,\n",
    "payments": "payment_id,order_id,method,amount,paid_at\n1,1,card,19.00,2020-03-01 12:00:00\n",
}


@pytest.fixture
def folder(tmp_path):
    for table, text in FILES.items():
        (tmp_path / f"{table}.csv").write_text(text)
    return tmp_path


def edit(folder: Path, table: str, old: str, new: str):
    path = folder / f"{table}.csv"
    path.write_text(path.read_text().replace(old, new))


def test_values_nulls_and_defaults(spark, folder):
    read = lambda t: csv_io.read_source_csv(spark, str(folder), t)
    orders = read("orders").orderBy("order_id").collect()
    assert [(o.employee_id, o.channel, o.status) for o in orders] == [
        (None, "in-store", "pending"), (1, "in-store", "pending"),
    ]
    assert [r.parent_category_id for r in read("categories").orderBy("category_id").collect()] == [None, 1]
    assert read("stores").first().city == "C, D"
    assert read("inventory").first().last_restock_date is None
    for table in LOAD_ORDER:
        types = [(f.name, f.dataType) for f in read(table).schema]
        assert types == [(f.name, f.dataType) for f in SOURCE_TABLES[table].schema]


@pytest.mark.parametrize("old, new", [("2,Leaf,1.0", "2,Leaf,1.5"), ("2,Leaf,1.0", "x,Leaf,1")])
def test_broken_values_fail_the_read(spark, folder, old, new):
    edit(folder, "categories", old, new)
    with pytest.raises(PySparkException):
        csv_io.read_source_csv(spark, str(folder), "categories").collect()


def test_missing_column_is_refused(spark, folder):
    edit(folder, "categories", "name,", "label,")
    with pytest.raises(ValueError, match="no column name"):
        csv_io.read_source_csv(spark, str(folder), "categories")


def test_load_replace_append_and_refusal(spark, folder, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    loaded = csv_io.ingest_all(spark, str(folder), store, truncate=True).collect()
    assert [(r.table_name, r.rows) for r in loaded] == [
        ("categories", 2), ("stores", 1), ("customers", 1), ("products", 1), ("employees", 1),
        ("orders", 2), ("order_items", 2), ("inventory", 1), ("payments", 1),
    ]
    csv_io.ingest_all(spark, str(folder), store, truncate=True)
    assert store.read("orders").count() == 2

    # The same rows again would repeat their keys: nothing is published.
    with pytest.raises(ValueError, match="orders: unique order_id"):
        csv_io.ingest_all(spark, str(folder), store, truncate=False)
    assert store.read("orders").count() == 2

    edit(folder, "orders", "2020-03-02", "2021-03-02")
    edit(folder, "order_items", "2,2,1,1", "2,7,1,1")
    with pytest.raises(ValueError, match="order_items: order_id in orders"):
        csv_io.ingest_all(spark, str(folder), store, truncate=True)
    assert str(store.read("orders").agg({"order_date": "max"}).first()[0]) == "2020-03-02"

    store.reset()
    assert store.tables() == [] and store.read("orders").count() == 0


def test_append_adds_rows(spark, folder, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    csv_io.ingest_all(spark, str(folder), store, truncate=True)
    head = lambda t: FILES[t].split("\n")[0] + "\n"
    for table in LOAD_ORDER:
        (folder / f"{table}.csv").write_text(head(table))
    (folder / "categories.csv").write_text(head("categories") + "3,Second leaf,1\n")
    csv_io.ingest_all(spark, str(folder), store)
    assert store.read("categories").count() == 3 and store.read("orders").count() == 2


def test_full_reload_replaces(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    schema = SOURCE_TABLES["categories"].schema
    store.write_full("categories", spark.createDataFrame([(1, "a", None), (2, "b", 1)], schema))
    store.write_full("categories", spark.createDataFrame([(3, "c", None)], schema))
    assert [r.category_id for r in store.read("categories").collect()] == [3]


def test_second_of_two_writers_fails_and_a_broken_log_is_no_empty_store(spark, tmp_path):
    root = str(tmp_path / "store")
    schema = SOURCE_TABLES["categories"].schema
    rows = [spark.createDataFrame([(n, "x", None)], schema) for n in (1, 2)]
    store = SnapshotStore(spark, root)
    version, paths = store._latest()
    store.write_full("categories", rows[0])
    with pytest.raises(PublishConflict):
        store._append(version + 1, {**paths, "categories": store.stage("categories", rows[1])})
    assert [r.category_id for r in store.read("categories").collect()] == [1]
    for file in (tmp_path / "store" / "_published").glob("version=*/*.parquet"):
        file.write_bytes(b"damaged")
    with pytest.raises(Exception, match="(?i)parquet"):
        store.tables()
