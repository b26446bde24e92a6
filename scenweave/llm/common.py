"""What several operators of this subpackage share."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
#: Spark's setting that deletes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The folder of the tables that only serve to make another one.
_ON_THE_WAY: ContextVar[str | None] = ContextVar("_ON_THE_WAY", default=None)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where none is set, a temporary one, in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="stage-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared one, deleted when the application ends."""
    path = f"{_ON_THE_WAY.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries that end in this block leave no shuffle files; else these stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and go on from the file: its lineage is cut and its size is known to the planner."""
    return _written(df, new_folder(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``stage(make(), name)``; what ``make`` staged for it is deleted as soon as it is written."""
    path, way = new_folder(spark, name), new_folder(spark, f"for-{name}")
    token = _ON_THE_WAY.set(way)
    try:
        return _written(make(), path)
    finally:
        _ON_THE_WAY.reset(token)
        place = spark._jvm.org.apache.hadoop.fs.Path(way)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def parts_for(rows: int | float | None, each: int) -> int:
    """Number of partitions such that each gets about ``each`` rows (or bytes)."""
    return max(1, -(-int(rows or 0) // each))


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of consecutive rows of about ``limit`` bytes together; a longer row stands alone."""
    low, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > low and total + size > limit:
            yield low, i - low
            low, total = i, 0
        total += size
    if len(sizes) > low:
        yield low, len(sizes) - low


def once_per_worker(name: str, make: Callable[[], object]):
    """An object that a Python worker keeps for its later tasks, such as a table that only saves work."""
    kept = sys.modules.setdefault("_once_per_worker", types.ModuleType("_once_per_worker")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]
