"""Published tables in versions: a reader finds a whole table at any moment, on any store.

A table is a folder with one data folder per version and a log of small commit files, ``_commits/00000001.json`` and so on. Data is
written and checked first, under a name of its own; the commit file that names it makes it the current version. Nothing is renamed,
so nothing is ever missing: before the commit file is whole, readers take the version before it. Two writers can't make the same
version, since a commit file is only ever created, never replaced; the second one takes the next number.

A commit also holds the schema, so that readers infer nothing, and the number of rows, so that a lost or cut file is found.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .outputs import _store, write_table

LOG = "_commits"
KEEP = 2


class Version(NamedTuple):
    number: int
    folder: str
    kind: str
    schema: T.StructType
    rows: int


def _commit_file(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{LOG}/{number:08d}.json"


def _read_text(spark: SparkSession, path: str) -> str:
    store, at = _store(spark, path)
    stream = store.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """All begun commits, newest first."""
    store, log = _store(spark, f"{path.rstrip('/')}/{LOG}")
    if not store.exists(log):
        return []
    names = [s.getPath().getName() for s in store.listStatus(log)]
    return sorted((int(n[:8]) for n in names if n.endswith(".json") and n[:8].isdigit()), reverse=True)


def _parsed(path: str, text: str) -> Version | None:
    """A commit ends with a line feed; one that is still being written is none."""
    if not text.endswith("\n"):
        return None
    fact = json.loads(text)
    return Version(fact["version"], f"{path.rstrip('/')}/{fact['folder']}", fact["kind"], T.StructType.fromJson(fact["schema"]), fact["rows"])


def versions(spark: SparkSession, path: str) -> list[Version]:
    """Committed versions, newest first."""
    found = (_parsed(path, _read_text(spark, _commit_file(path, n))) for n in _numbers(spark, path))
    return [v for v in found if v is not None]


def current(spark: SparkSession, path: str) -> Version | None:
    for n in _numbers(spark, path):
        version = _parsed(path, _read_text(spark, _commit_file(path, n)))
        if version is not None:
            return version
    return None


def load(spark: SparkSession, version: Version, text: bool = False) -> DataFrame:
    """The rows of a version; ``text`` leaves the cells of a CSV as they are written."""
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in version.schema]) if text and version.kind == "csv" else version.schema
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(version.folder) if version.kind == "csv" else reader.parquet(version.folder)


def read(spark: SparkSession, path: str, number: int | None = None, text: bool = False) -> DataFrame:
    """The current version of a table, or the one of a number."""
    found = current(spark, path) if number is None else next((v for v in versions(spark, path) if v.number == number), None)
    if found is None:
        raise FileNotFoundError(f"{path} has no version{'' if number is None else f' {number}'}")
    return load(spark, found, text)


def _commit(spark: SparkSession, path: str, folder: str, kind: str, schema: T.StructType, rows: int) -> int:
    number = next(iter(_numbers(spark, path)), 0) + 1
    while True:
        store, at = _store(spark, _commit_file(path, number))
        try:
            stream = store.create(at, False)
        except Exception:
            if not store.exists(at):
                raise
            number += 1  # another writer has this version
            continue
        fact = {"version": number, "folder": folder, "kind": kind, "rows": rows, "schema": schema.jsonValue()}
        try:
            stream.write(bytearray(json.dumps(fact).encode() + b"\n"))
        finally:
            stream.close()
        return number


def publish(
    df: DataFrame,
    path: str,
    check: Callable[[DataFrame], object] = lambda fresh: None,
    kind: str = "parquet",
    compression: str | None = None,
    keep: int = KEEP,
) -> int:
    """Write ``df`` as the next version and return its number; versions before the newest ``keep`` are removed afterwards.

    The new data must have rows and pass ``check`` (which raises) before it is committed. What is refused leaves no trace and the
    current version stays.
    """
    spark = df.sparkSession
    folder = f"data-{uuid.uuid4().hex}"
    own = f"{path.rstrip('/')}/{folder}"
    try:
        write_table(df, own, kind, compression)
        fresh = load(spark, Version(0, own, kind, df.schema, 0))
        rows = fresh.agg(F.count(F.lit(1))).first()[0]
        if rows == 0:
            raise ValueError(f"{path} gets no version without rows")
        check(fresh)
        number = _commit(spark, path, folder, kind, df.schema, rows)
    except BaseException:
        store, left = _store(spark, own)
        store.delete(left, True)
        raise
    vacuum(spark, path, keep)
    return number


def vacuum(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Remove versions before the newest ``keep``: the commit first, so that no commit names data that is gone."""
    for old in versions(spark, path)[max(keep, 1) :]:
        store, at = _store(spark, _commit_file(path, old.number))
        store.delete(at, False)
        store.delete(_store(spark, old.folder)[1], True)
