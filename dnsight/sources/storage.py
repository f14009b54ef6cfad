"""Shared scratch space for staged tables."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession

_scopes = threading.local()

#: Spark's setting by which a query's shuffle files go when it ends, not at the next garbage collection of the driver.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors reach: the session's checkpoint setting.

    Where the session names none, a local master gets a folder of its own; on a cluster, where other
    machines would not see that, it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="dnsight-")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries inside the block remove their shuffle files when they end."""
    before = spark.conf.get(CLEANUP, "false")
    if before == "true":
        yield
        return
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stage(df: DataFrame) -> DataFrame:
    """Compute a table now, write it to the shared folder and read it back.

    Later uses neither repeat the scan nor depend on executors that are still alive, and Spark
    knows the size of the table when it plans joins with it. It lies there until the `scratch` block
    around it ends, or for as long as the folder does. What was shuffled for it is removed at once.
    """
    path = _scoped_path(df.sparkSession)
    with _shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _scoped_path(spark: SparkSession) -> str:
    """A fresh path that goes with the innermost `scratch` block."""
    path = fresh_path(spark, "staged")
    open_scopes = getattr(_scopes, "paths", [])
    if open_scopes:
        open_scopes[-1].append(path)
    return path


def stage_parts(df: DataFrame, part: Column, count: int) -> Iterator[DataFrame]:
    """Parts 0 to count - 1 of a table that is staged once; each is removed when the next one is asked for.

    What is made of a part has to be stored before that. `part` is an int column, null nowhere.
    """
    spark, path = df.sparkSession, _scoped_path(df.sparkSession)
    with _shuffles_removed(spark):
        df.withColumn("part", part).write.partitionBy("part").option("compression", "zstd").parquet(path)
    for k in range(count):
        own = f"{path}/part={k}"
        # A part without rows has no folder.
        yield spark.read.schema(df.schema).parquet(own) if _exists(spark, own) else spark.createDataFrame([], df.schema)
        _remove(spark, own)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _remove(spark: SparkSession, path: str) -> None:
    """Remove a staged table wherever the shared folder is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables staged inside the block are removed at its end, whether it fails or not.

    The block gets a function that stages a table beyond its end. What leaves the block has to be such
    a table: one that is not computed yet would look for those that are gone.
    """
    if not hasattr(_scopes, "paths"):
        _scopes.paths = []
    own: list[str] = []
    _scopes.paths.append(own)

    def keep(df: DataFrame) -> DataFrame:
        place = next(k for k, paths in enumerate(_scopes.paths) if paths is own)
        inner, _scopes.paths = _scopes.paths[place:], _scopes.paths[:place]
        try:
            return stage(df)
        finally:
            _scopes.paths += inner

    try:
        yield keep
    finally:
        _scopes.paths = [paths for paths in _scopes.paths if paths is not own]
        for path in own:
            _remove(spark, path)
