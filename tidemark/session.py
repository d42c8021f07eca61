"""Session settings and shared stages."""

from __future__ import annotations

import contextlib
import contextvars
import os
import uuid
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

_SETTLED: list[DataFrame] = []
_FOLDER: contextvars.ContextVar[str | None] = contextvars.ContextVar("stage folder", default=None)


def local_session(cores: int | str = 8, name: str = "tidemark") -> SparkSession:
    """A single-JVM session for tests and the local benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call sites: they cost more than the calls
        .getOrCreate()
    )


@contextlib.contextmanager
def stages(spark: SparkSession, folder: str | None = None) -> Iterator[str]:
    """Within this block every settled stage is a Parquet table in a folder of its own, which is deleted at the end.

    For long chains of stages, whose plans would otherwise hold all earlier ones. ``folder`` must be shared by all machines;
    without it the session's checkpoint folder is used, and a session without one is an error. Results must be written
    before the block ends.
    """
    top = folder or spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not top:
        raise ValueError(f"name a shared folder for the stages, here or in {CHECKPOINT_KEY}")
    own = f"{top.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    token = _FOLDER.set(own)
    try:
        yield own
    finally:
        _FOLDER.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def in_stages() -> bool:
    return _FOLDER.get() is not None


def settle(df: DataFrame) -> DataFrame:
    """Mark a stage that several branches read, so that it is computed once for all of them.

    Inside ``stages`` it is written at once. Elsewhere nothing runs and nothing is written while a plan is built: its first
    reader computes it, partitions that do not fit in memory go to the executors' disks, those of a lost executor are computed
    again, and ``release`` lets go of all of them. Both are the same on any master.
    """
    folder = _FOLDER.get()
    if folder is not None:
        path = f"{folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    settled = df.persist(StorageLevel.MEMORY_AND_DISK)
    _SETTLED.append(settled)
    return settled


def release() -> int:
    """Drop what the stages hold; returns how many there were. Plans built on them stay right and compute them anew."""
    n = len(_SETTLED)
    while _SETTLED:
        _SETTLED.pop().unpersist()
    return n
