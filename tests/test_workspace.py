import pytest

from starloom import workspace
from starloom.operators.ordering import number_rows

CONFS = ["spark.sql.shuffle.partitions", workspace._INITIAL, workspace._LEAST_FILES, workspace._ADVISORY]


@pytest.fixture
def settings(spark, monkeypatch):
    monkeypatch.setattr(workspace, "_given", {})
    before = {c: spark.conf.get(c, None) for c in CONFS}
    for c in CONFS[1:]:
        spark.conf.unset(c)
    yield
    for c, value in before.items():
        spark.conf.unset(c) if value is None else spark.conf.set(c, value)


def test_partitions_grow_with_the_input(spark, scratch, settings, tmp_path, monkeypatch):
    for name, rows in (("small", 10), ("large", 20_000)):
        spark.range(rows).coalesce(1).write.parquet(f"{tmp_path}/{name}/orders.parquet")
    monkeypatch.setattr(workspace, "PARTITION_BYTES", 8_000)
    workspace.fit_partitions(spark, f"{tmp_path}/large/{{orders,part}}.parquet")
    many = workspace.splits(spark)
    assert many > 8
    numbered = number_rows(spark.read.parquet(f"{tmp_path}/large/orders.parquet"), "n", ["id"], scratch=scratch)
    assert len(numbered.inputFiles()) == many
    assert numbered.filter("n = id + 1").count() == 20_000
    # The next folder has its own size, and what the session was given is the least.
    workspace.fit_partitions(spark, f"{tmp_path}/small/orders.parquet")
    assert workspace.splits(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))
