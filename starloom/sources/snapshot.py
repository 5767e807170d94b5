"""Parquet tables that are published together.

New data goes to new folders. The publication log has a folder for each version, written
once and never changed; it makes all of a load visible at once, so a load that fails half way
changes nothing for readers. Of two writers that start from the same version, the second
finds the folder of the next one in place and fails.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.operators import facts
from starloom.sources.contracts import SIDE_TABLES, SOURCE_TABLES, WAREHOUSE_TABLES
from starloom.workspace import shuffle_files_released

LOG_SCHEMA = "table string, paths array<string>, version bigint"
MONTHLY = {"fact_sales"}


def month_of(path: str) -> int:
    """The month of a folder of the fact."""
    return int(path.rsplit("=", 1)[1])


class PublishConflict(RuntimeError):
    """Another load was published since this one read the store."""


class SnapshotStore:
    """A set of named tables below one folder, read at their last published version."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.contracts = {**SOURCE_TABLES, **WAREHOUSE_TABLES, **SIDE_TABLES}

    def _latest(self) -> tuple[int, dict[str, list[str]]]:
        """The last version and its tables; only a log that does not exist is an empty one."""
        try:
            log = self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/_published")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, {}
        version = log.agg(F.max("version")).first()[0] or 0
        rows = log.filter(F.col("version") == version).collect()  # one row per table
        return version, {r["table"]: r["paths"] for r in rows if r["table"]}

    def tables(self) -> list[str]:
        return sorted(self._latest()[1])

    def folders(self, table: str) -> list[str]:
        return self._latest()[1].get(table, [])

    def read(self, table: str) -> DataFrame:
        return self.scan(table, self.folders(table))

    def scan(self, table: str, paths: list[str]) -> DataFrame:
        schema = self.contracts[table].schema
        if not paths:
            # Seen to be empty when a query is planned, so that what is joined to it does not move.
            return self.spark.createDataFrame([], schema).limit(0)
        return self.spark.read.schema(schema).parquet(*paths)

    def stage(self, table: str, df: DataFrame) -> list[str]:
        """Write a table to folders that no reader sees yet; the fact gets one per month."""
        path = f"{self.root}/{table}/{uuid.uuid4().hex}"
        df = self.contracts[table].conform(df)
        if table not in MONTHLY:
            with shuffle_files_released(self.spark):
                df.write.option("compression", "zstd").parquet(path)
            return [path]
        with shuffle_files_released(self.spark):
            facts.by_month(df).write.partitionBy(facts.MONTH).option("compression", "zstd").parquet(path)
        months = self.spark.read.parquet(path).select(facts.MONTH).distinct().collect()
        return sorted(f"{path}/{facts.MONTH}={r[0]}" for r in months)

    def publish(self, staged: dict[str, list[str]], *, replace: bool) -> None:
        """Show the staged folders, in place of or in addition to the present ones."""
        version, paths = self._latest()
        for table, added in staged.items():
            paths[table] = [*([] if replace else paths.get(table, [])), *added]
        self._append(version + 1, paths)

    def upsert_fact(self, incoming: DataFrame) -> list[int]:
        """Merge rows into the fact, rewrite the months they touch, and list these.

        The log is read once: if another load is published meanwhile, this one fails.
        """
        table = "fact_sales"
        version, paths = self._latest()
        folders = paths.get(table, [])
        incoming = facts.with_month(incoming)
        facts.refuse_repeats(incoming)
        months = facts.touched_months(facts.with_month(self.scan(table, folders)), incoming)
        if not months:
            return []
        kept, old = ([p for p in folders if (month_of(p) in months) == hit] for hit in (False, True))
        affected = facts.with_month(self.scan(table, old))
        added = self.stage(table, facts.merge_months(affected, incoming))
        self._append(version + 1, {**paths, table: kept + added})
        return months

    def reset(self) -> None:
        """Show an empty store; the folders of earlier versions are left in place."""
        self._append(self._latest()[0] + 1, {})

    def write_full(self, table: str, df: DataFrame) -> None:
        self.publish({table: self.stage(table, df)}, replace=True)

    def _append(self, version: int, paths: dict[str, list[str]]) -> None:
        rows = [(t, p) for t, p in paths.items()] or [(None, None)]
        log = self.spark.createDataFrame(rows, "table string, paths array<string>").coalesce(1)
        try:
            log.write.mode("errorifexists").parquet(f"{self.root}/_published/version={version}")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise PublishConflict(f"version {version} was published by another load") from problem
