"""Shared folder for intermediate tables.

A table that is read more than once, or that must not be recomputed differently
(row numbers, split ids), is written here and read back. The files outlive any
executor, so a lost executor costs a re-read and not a recomputation.
"""

from __future__ import annotations

import atexit
import itertools
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock
from urllib.parse import urlparse
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, functions as F

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or a temporary one in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="starloom-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


#: Bytes of input files for each partition: some 400,000 order lines, which a task sorts and groups in memory.
PARTITION_BYTES = 8_000_000
_INITIAL, _LEAST_FILES = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.minPartitionNum"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_given: dict[tuple[str, str], int] = {}
#: Rows in memory are taken to be so many times as large as their files, which zstd and encodings make small.
FILE_FACTOR = 10
_FILE_FACTOR = "spark.sql.sources.fileCompressionFactor"
#: Deletes the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def fit_partitions(spark: SparkSession, paths: str) -> None:
    """Cut scans and exchanges of this session by the size of the files at ``paths``, as tasks of any size must not spill.

    A number of partitions that suits small data gives tasks that grow with the input. Adaptive execution
    joins what is too small, up to a size that still fits when it is unpacked. What the session was given stays, if it is finer.
    Files are taken for what they unpack to when Spark decides on a broadcast, which is built in the driver's memory.
    """
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    size = read.load(paths).agg(F.sum("length")).first()[0] or 0
    if spark.conf.get(_ADVISORY, None) is None:
        spark.conf.set(_ADVISORY, f"{2 * PARTITION_BYTES}b")
    if spark.conf.get(_FILE_FACTOR, None) is None:
        spark.conf.set(_FILE_FACTOR, FILE_FACTOR)
    for name in (_INITIAL, _LEAST_FILES):
        key = (spark.sparkContext.applicationId, name)
        given = _given.setdefault(key, int(spark.conf.get(name, None) or spark.conf.get("spark.sql.shuffle.partitions")))
        spark.conf.set(name, max(given, -(-size // PARTITION_BYTES)))


def splits(spark: SparkSession) -> int:
    """The number of range splits."""
    return max(int(spark.conf.get(n, None) or 1) for n in ("spark.sql.shuffle.partitions", _INITIAL))


_writers: WeakKeyDictionary[SparkSession, tuple[int, str | None]] = WeakKeyDictionary()
_counting = Lock()


@contextmanager
def shuffle_files_released(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files as they end, not when the driver collects its garbage.

    Threads may write side by side: the first sets this for the session, and the last restores what the session was given.
    """
    with _counting:
        n, given = _writers.get(spark, (0, None))
        if not n:
            given = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, True)
        _writers[spark] = n + 1, given
    try:
        yield
    finally:
        with _counting:
            n, given = _writers[spark]
            _writers[spark] = n - 1, given
            if n == 1:
                if given is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, given)


class Workspace:
    """Writes intermediate tables below one run folder and reads them back."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        run = f"starloom-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"
        self.root = f"{root or shared_root(spark)}/{run}"
        self._numbers = itertools.count(1)

    def save(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = f"{self.root}/{name}-{next(self._numbers)}"
        with shuffle_files_released(self.spark):
            df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_and_release(self, df: DataFrame, name: str) -> DataFrame:
        """``save``, by the name that says what it does to the shuffle files."""
        return self.save(df, name)

    def drop(self, saved: DataFrame) -> None:
        """Delete a table that ``save`` returned, as nothing reads it any more."""
        folders = {file.rsplit("/", 1)[0] for file in saved.inputFiles()}
        if any(not urlparse(f).path.startswith(urlparse(self.root).path) for f in folders):
            raise ValueError(f"not a table of {self.root}")
        for folder in folders:
            self._delete(folder)

    def close(self) -> None:
        """Delete all tables of this run; what reads them must be done by then."""
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
