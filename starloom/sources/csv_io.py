"""CSV in and out, and the nine-table load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starloom.operators.checks import constraint_report
from starloom.sources.contracts import LOAD_ORDER, SOURCE_TABLES
from starloom.sources.snapshot import SnapshotStore
from starloom.workspace import shuffle_files_released


def _typed(name: str, kind: T.DataType) -> Column:
    """Parse one text column; whole numbers may be written with a fraction of zero."""
    text = F.col(name)
    if not isinstance(kind, (T.IntegerType, T.LongType)):
        return text.cast(kind)
    number = text.cast("decimal(38,6)")
    broken = F.raise_error(F.concat(F.lit(f"{name} is not a whole number: "), text))
    return F.when(number.isNull() | (number == F.floor(number)), number.cast(kind)).otherwise(
        broken.cast(kind)
    )


def read_source_csv(
    spark: SparkSession, folder: str, table: str, *, multi_line: bool = False
) -> DataFrame:
    """One source table with its declared types; columns are matched by header name.

    An empty field is NULL, a missing column gets its default, and a row or value that
    does not parse fails the read. ``multi_line`` allows line breaks inside quotes, at
    the price of files that Spark cannot split.
    """
    contract = SOURCE_TABLES[table]
    raw = (
        spark.read.option("header", True)
        .option("nullValue", "")
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .csv(f"{folder}/{table}.csv")
    )
    known = {f.name: f.dataType for f in contract.schema}
    missing = [c for c in known if c not in raw.columns and c not in contract.defaults]
    if missing:
        raise ValueError(f"{table}.csv has no column {', '.join(missing)}")
    return contract.conform(
        raw.select(*[_typed(c, known[c]).alias(c) for c in raw.columns if c in known])
    )


def write_csv(df: DataFrame, folder: str, table: str, *, compression: str = "none") -> None:
    """One folder of CSV part files per table, with a header; NULL is an empty field."""
    with shuffle_files_released(df.sparkSession):
        df.write.option("header", True).option("compression", compression).mode("overwrite").csv(f"{folder}/{table}.csv")


def ingest_all(
    spark: SparkSession, source: str, store: SnapshotStore, *, truncate: bool = False
) -> DataFrame:
    """Load the nine tables, all or none; returns table and rows loaded, in load order.

    ``truncate`` replaces the present content, otherwise rows are added. The staged
    tables must satisfy their contracts together with what is already there.
    """
    staged = {
        table: store.stage(table, read_source_csv(spark, source, table)) for table in LOAD_ORDER
    }
    fresh = {t: spark.read.schema(SOURCE_TABLES[t].schema).parquet(*p) for t, p in staged.items()}
    complete = fresh if truncate else {t: store.read(t).unionByName(fresh[t]) for t in LOAD_ORDER}
    broken = constraint_report(complete, SOURCE_TABLES).filter("violations > 0")
    with shuffle_files_released(spark):
        problems = [f"{r.table_name}: {r.rule} ({r.violations})" for r in broken.collect()]
    if problems:
        raise ValueError("load refused, nothing was published; " + "; ".join(problems))
    store.publish(staged, replace=truncate)
    counts = None
    for position, (table, df) in enumerate(fresh.items(), start=1):
        one = df.agg(F.count("*").alias("rows")).select(
            F.lit(position).alias("position"), F.lit(table).alias("table_name"), "rows"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts.orderBy("position")
