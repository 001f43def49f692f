"""Session settings and scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Of each open ``temporary`` block, the innermost last, the folders named within it.
_OPEN: list[list[str]] = []


def session(app: str = "kerbside", **settings: str) -> SparkSession:
    """A session with the settings this library is meant to run with, and further ones:
    ``session(**{"spark.sql.shuffle.partitions": "2000"})``."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A scan reads about half of the raw columns, so that a split of this size
        # is still a small task, and there are fewer of them.
        .config("spark.sql.files.maxPartitionBytes", "512m")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder that the cluster names.

    Only a local session without that setting gets a machine-local folder. Within a
    ``temporary`` block the folder lasts as long as the block.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _local_root()
    path = f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Removes at its end, also after an error, all scratch folders named within it.

    What is needed of them has to be written elsewhere before: to a folder named outside.
    """
    folders: list[str] = []
    _OPEN.append(folders)
    try:
        yield
    finally:
        _OPEN.remove(folders)
        for folder in folders:
            remove(spark, folder)


def _located(spark: SparkSession, folder: str) -> tuple:
    """The file system of a folder, and its path there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder, in whatever file system it is."""
    system, path = _located(spark, folder)
    system.delete(path, True)


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether there is such a folder, in whatever file system."""
    system, path = _located(spark, folder)
    return system.exists(path)


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """A small frame written to a scratch folder and read back, so that it is computed once."""
    path = scratch(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def settled(spark: SparkSession, purpose: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` gives, written; the scratch folders it named are removed after that."""
    path = scratch(spark, purpose)
    with temporary(spark):
        frame = build()
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="kerbside-")
