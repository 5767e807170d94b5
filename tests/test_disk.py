"""What a step no longer needs does not stay on disk, and what is empty moves nothing."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from starloom import workspace
from starloom.operators import facts
from starloom.plans import catalog
from starloom.plans.reload import _changes
from starloom.plans.warehouse import Warehouse
from starloom.sources import csv_io
from starloom.sources.snapshot import SnapshotStore
from starloom.workspace import Workspace

SMALL = "/root/testdata/sf0.001"


def shuffled(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(f.getName()) for f in (files.apply(i) for i in range(files.size())) if str(f.getName()).startswith("shuffle_")}


def test_each_write_releases_its_shuffle_files(spark, tmp_path):
    scratch, store = Workspace(spark, f"file://{tmp_path}"), SnapshotStore(spark, f"{tmp_path}/store")
    before, given = shuffled(spark), spark.conf.get(workspace._CLEANUP, None)
    moved = spark.range(2_000).selectExpr("id AS category_id", "cast(id AS string) AS name", "cast(null AS bigint) AS parent_category_id")
    moved = moved.repartition(3, "category_id")
    with ThreadPoolExecutor(4) as pool:
        saved = list(pool.map(lambda n: scratch.save(moved, f"rows{n}"), range(8)))
    store.stage("categories", moved)
    csv_io.write_csv(moved, f"{tmp_path}/csv", "categories", compression="gzip")
    assert shuffled(spark) <= before and all(s.count() == 2_000 for s in saved)
    assert spark.conf.get(workspace._CLEANUP, None) == given
    assert csv_io.read_source_csv(spark, f"{tmp_path}/csv", "categories").count() == 2_000


def test_drop_deletes_a_saved_table_and_nothing_else(spark, tmp_path):
    scratch = Workspace(spark, f"file://{tmp_path}/a")
    gone, kept = (scratch.save(spark.range(9), "rows") for _ in range(2))
    scratch.drop(gone)
    assert kept.count() == 9 and len(list(tmp_path.glob("a/*/rows-*"))) == 1
    with pytest.raises(ValueError):
        Workspace(spark, f"file://{tmp_path}/b").drop(kept)
    assert kept.count() == 9


def test_first_load_does_not_move_rows_to_an_empty_fact(spark, tmp_path):
    empty = facts.with_month(SnapshotStore(spark, f"{tmp_path}/store").read("fact_sales"))
    new = empty.sparkSession.range(5).selectExpr("id AS order_id", "id AS product_key", "20200101 AS date_key", "id AS sales_key")
    new = facts.with_month(new)
    old = empty.select(*new.columns)
    for rows in (_changes(old, new), facts.merge_months(old, new)):
        assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
        assert rows.count() == 5


def test_star_from_csv_keeps_one_copy_of_the_fact(spark, tmp_path):
    w = Warehouse(spark, SMALL, scratch=Workspace(spark, f"file://{tmp_path}"))
    fact = catalog.star_from_csv(w)
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.glob("*/*")}
    assert "carried" in left and not left & {"new-fact", "changes"}
    files = [p.name for p in tmp_path.glob("*/from-csv-*/csv/order_items.csv/part-*")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert fact.count() == w.order_items.count()
