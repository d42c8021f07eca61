"""Helpers of the corpus operators: stage tables in the shared folder, bounded slices of Arrow batches, word bytes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Bytes of text that a Python worker turns into words and arrays at once.
SLICE_BYTES = 1 << 20

_OWNED: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints. Only a local master without one gets a folder of its own; elsewhere
    a missing setting is an error, since other machines would not see a local folder."""
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all machines share")
    folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    _OWNED.append(path)
    return path


def stage_table(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends here, and rows, row ids included,
    are the same for every later reader, also after executors are lost."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the stage tables written so far. Results that were not written elsewhere can't be read afterwards."""
    jvm = spark.sparkContext._jvm
    while _OWNED:
        path = jvm.org.apache.hadoop.fs.Path(_OWNED.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z: digits, letters and all of UTF-8 beyond ASCII.
_WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    """Lower-cased words; every byte outside a word, NUL included, separates."""
    return text.translate(_WORD_TABLE).split()


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64 on uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, grown by doubling."""
    have = _POWERS.get(base)
    if have is None:
        have = np.ones(1, dtype=np.uint64)
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    _POWERS[base] = have
    return have[:n]


#: Bytes of `[^\x20\x09-\x0D]+` after lower-casing A-Z.
SPACED_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if 0x09 <= b <= 0x0D else b for b in range(256))


def word_hashes(texts: Sequence[bytes], table: bytes = _WORD_TABLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, in order, and the index of the text each belongs to. ``table`` maps the bytes;
    0x20 separates.

    The hash of a word is a polynomial of its bytes modulo 2**64, read off running sums over the joined bytes, then mixed.
    """
    joined = b" ".join(texts).translate(table)
    data = np.frombuffer(joined, dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = data != 0x20
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[data] * _powers(_BASE, len(data)), out=total[1:])
    hashed = mix((total[end] - total[start]) * _powers(_INVERSE, len(data) + 1)[start] + (end - start).astype(np.uint64))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return hashed, np.searchsorted(bounds, start, side="right")


_ROLL = [np.uint64(pow(0xA24BAED4963EE407, i + 1, 1 << 64)) for i in range(64)]


def shingle_hashes(hashes: np.ndarray, owner: np.ndarray, n_texts: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words per text and their texts; a shorter, not empty text is one shingle of its own."""
    counts = np.bincount(owner, minlength=n_texts)
    first = np.cumsum(counts) - counts
    position = np.arange(len(hashes)) - first[owner] if len(hashes) else np.zeros(0, dtype=np.int64)
    left = counts[owner] - position if len(hashes) else position
    whole = np.flatnonzero(left >= size)
    out = np.zeros(len(whole), dtype=np.uint64)
    for j in range(size):
        out += hashes[whole + j] * _ROLL[j]
    own = owner[whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.zeros(len(short), dtype=np.uint64)
        for j in range(size - 1):
            has = counts[short] > j
            extra[has] += hashes[first[short[has]] + j] * _ROLL[j]
        extra += counts[short].astype(np.uint64)
        out, own = np.concatenate([out, extra]), np.concatenate([own, short])
        order = np.argsort(own, kind="stable")
        out, own = out[order], own[order]
    return mix(out), own


def packed(docs: DataFrame) -> DataFrame:
    """All columns as one struct ``row``, so that result columns never clash with those of the input."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


#: What a worker keeps from task to task, by operator.
_KEPT: dict[str, dict] = {}


def kept(operator: str, key, make: Callable):
    """What ``make`` returns, made once per worker and dropped when another operator begins."""
    own = _KEPT.setdefault(operator, {})
    if key not in own:
        own[key] = make()
    return own[key]


def begin(operator: str | None = None) -> None:
    """Drop what other operators left in this worker: Spark uses a worker again for every stage of a session, and what an
    earlier one keeps would stand beside what the next one needs."""
    for other in [o for o in _KEPT if o != operator]:
        del _KEPT[other]
    _POWERS.clear()


def row_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts inside ``row`` as UTF-8 bytes; null counts as empty."""
    rows = batch.column(batch.schema.get_field_index("row"))
    return [v or b"" for v in rows.field(rows.type.get_field_index(column)).cast(pa.binary()).to_pylist()]


def cuts(sizes: Iterable[int], limit: int = SLICE_BYTES, rows: int = 4096):
    """Beginnings and ends of runs of at most ``rows`` rows that end when their sizes reach ``limit``."""
    a = b = held = 0
    for b, size in enumerate(sizes, 1):
        held += size
        if held >= limit or b - a == rows:
            yield a, b
            a, held = b, 0
    if b > a:
        yield a, b


def byte_sizes(texts: pa.Array) -> list[int]:
    return pc.fill_null(pc.binary_length(texts), 0).to_pylist()


def row_slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES, rows: int = 4096, operator: str | None = None):
    """Pairs of a batch cut to at most ``rows`` rows and about ``limit`` bytes of ``row.column``, and its texts. Only the texts of
    one slice are copied out of the batch at a time. What operators other than ``operator`` keep in this worker is dropped."""
    begin(operator)
    for batch in batches:
        held = batch.column(batch.schema.get_field_index("row"))
        for a, b in cuts(byte_sizes(held.field(held.type.get_field_index(column))), limit, rows):
            part = batch.slice(a, b - a)
            yield part, row_texts(part, column)
