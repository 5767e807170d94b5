"""Files that unpack to much more than their size are not sent to all executors through the driver's memory."""

from starloom import workspace


def test_small_files_of_many_rows_are_not_broadcast(spark, tmp_path, monkeypatch):
    names = [workspace._INITIAL, workspace._LEAST_FILES, workspace._ADVISORY, workspace._FILE_FACTOR, "spark.sql.autoBroadcastJoinThreshold"]
    monkeypatch.setattr(workspace, "_given", {})
    before = {c: spark.conf.get(c, None) for c in names}
    path = f"{tmp_path}/orders.parquet"
    spark.range(200_000).selectExpr("id", "id * 3 AS v").coalesce(1).write.option("compression", "zstd").parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "orders.parquet").glob("*.parquet"))
    assert size < 200_000 * 16

    def plan(rows):
        return rows._jdf.queryExecution().sparkPlan().toString()

    try:
        for c in names:
            spark.conf.unset(c)
        spark.conf.set(names[-1], 2 * size)
        workspace.fit_partitions(spark, path)
        large = spark.range(50_000_000)
        assert "BroadcastHashJoin" not in plan(large.join(spark.read.parquet(path), "id"))
        # What the session was given stays.
        spark.conf.set(workspace._FILE_FACTOR, "1.0")
        workspace.fit_partitions(spark, path)
        assert "BroadcastHashJoin" in plan(large.join(spark.read.parquet(path), "id"))
    finally:
        for c, value in before.items():
            spark.conf.unset(c) if value is None else spark.conf.set(c, value)
