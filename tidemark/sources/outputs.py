"""Table exports. A table is replaced by a finished copy, so a reader finds the old one or the new one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, kind: str = "parquet", compression: str | None = None, index: str | None = None, index_name: str | None = None) -> None:
    """Write a table; ``index`` puts that column first under ``index_name``."""
    if index is not None:
        rest = [c for c in df.columns if c != index]
        df = df.select(index, *rest).withColumnRenamed(index, index_name or index)
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if kind == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def _store(spark: SparkSession, path: str):
    """The file system of a path and the path in its own terms."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _store(spark, path)
    return store.exists(at)


def _previous(path: str) -> str:
    return f"{path.rstrip('/')}__previous"


def recover(spark: SparkSession, path: str) -> None:
    """Put the previous table back if a swap was cut off between its two renames; drop it if the new one is there."""
    store, at = _store(spark, path)
    _, old = _store(spark, _previous(path))
    if store.exists(old):
        if store.exists(at):
            store.delete(old, True)
        else:
            store.rename(old, at)


def swap(spark: SparkSession, fresh: str, path: str) -> None:
    """Move the finished table at ``fresh`` to ``path``; the table that was there goes afterwards."""
    store, at = _store(spark, path)
    _, new = _store(spark, fresh)
    _, old = _store(spark, _previous(path))
    recover(spark, path)
    if store.exists(at) and not store.rename(at, old):
        raise OSError(f"{path} can't be moved aside")
    if not store.rename(new, at):
        recover(spark, path)
        raise OSError(f"{fresh} can't be moved to {path}")
    store.delete(old, True)


def guarded_write(
    df: DataFrame,
    path: str,
    check: Callable[[DataFrame], object] = lambda fresh: None,
    kind: str = "parquet",
    compression: str | None = None,
) -> None:
    """Replace a table only after the new one was written aside, has rows and passed ``check`` (which raises).

    The check reads what was written, so the plan runs once. A refused table leaves the old one as it is; nothing is left
    beside it.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}__staged-{uuid.uuid4().hex}"
    try:
        write_table(df, staged, kind, compression)
        fresh = read_table(spark, staged, df, kind)
        if fresh.limit(1).count() == 0:
            raise ValueError(f"{path} is not replaced by a table without rows")
        check(fresh)
        swap(spark, staged, path)
    finally:
        store, left = _store(spark, staged)
        store.delete(left, True)


def read_table(spark: SparkSession, path: str, like: DataFrame, kind: str = "parquet") -> DataFrame:
    reader = spark.read.schema(like.schema)
    return reader.option("header", True).csv(path) if kind == "csv" else reader.parquet(path)
