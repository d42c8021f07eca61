"""Benchmark decontamination as a prefix-filtered set join of item windows with document shingles.

A window is a run of ``window`` consecutive words of a benchmark item (the whole item where it is shorter). Its shingles
are ordered by how often they occur in the documents; since a window must be contained as a whole, the rarest one is the
only prefix token that has to be joined. A document position that holds a prefix token proposes the window that would put
it there; windows that would begin before the document or end after it are ruled out by position and length, and the
remaining ones are compared word by word.

The benchmark streams through the driver in blocks of at most ``block_bytes`` of text, so what is broadcast and counted at
a time has that bound whatever the size of the benchmark; each block costs two scans of the documents.

Nulls: a null text has no words; a benchmark row with a null id is ignored. Repeated rows are reported once per row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, row_slices, stage_table, words

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 16 << 20

_HITS = "n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _windows(item: list[bytes], window: int) -> list[list[bytes]]:
    return [item[i : i + window] for i in range(max(1, len(item) - window + 1))] if item else []


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    block, held = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    for row in rows.where("item is not null and text is not null").toLocalIterator():
        if block and held + len(row["text"]) > block_bytes:
            yield block
            block, held = [], 0
        block.append((row["item"], bytes(row["text"])))
        held += len(row["text"])
    yield block


def _firsts(shingles) -> dict[bytes, tuple[int, ...]]:
    """First word of a shingle -> the shingle lengths that begin with it."""
    out: dict[bytes, set[int]] = {}
    for s in shingles:
        out.setdefault(s.partition(b" ")[0], set()).add(s.count(b" ") + 1)
    return {w: tuple(sorted(n)) for w, n in out.items()}


def _occurrences(ws: list[bytes], firsts: dict, wanted) -> Iterator[tuple[int, bytes]]:
    for i in [i for i, w in enumerate(ws) if w in firsts]:
        for n in firsts[ws[i]]:
            s = b" ".join(ws[i : i + n]) if n > 1 else ws[i]
            if s in wanted:
                yield i, s


def _shingle_counts(docs: DataFrame, shingles: list[bytes]) -> dict[bytes, int]:
    """Occurrences of the block's shingles in all documents; at most one row per shingle comes back."""
    wanted = {s: k for k, s in enumerate(shingles)}
    sent = docs.sparkSession.sparkContext.broadcast((_firsts(shingles), wanted))

    def count(batches):
        firsts, ids = sent.value
        seen: Counter = Counter()
        for _, texts in row_slices(batches):
            for text in texts:
                seen.update(s for _, s in _occurrences(words(text), firsts, ids))
        keys = list(seen)
        yield pa.RecordBatch.from_pydict({"k": pa.array([ids[s] for s in keys], pa.int64()), "n": pa.array([seen[s] for s in keys], pa.int64())})

    counted = packed(docs.select("text")).mapInArrow(count, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n"))
    return {shingles[r["k"]]: r["n"] for r in counted.collect()}


def _prefixes(block, counts: dict[bytes, int], window: int, shingle: int):
    """(prefix shingle -> its (offset, window length) pairs, window -> items)."""
    prefixes: dict[bytes, set[tuple[int, int]]] = {}
    windows: dict[bytes, set[str]] = {}
    for item, text in block:
        for w in _windows(words(text), window):
            n = min(shingle, len(w))
            ordered = sorted((counts.get(s, 0), k, s) for k, s in enumerate(b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)))
            if ordered[0][0]:  # else the window cannot occur
                prefixes.setdefault(ordered[0][2], set()).add((ordered[0][1], len(w)))
                windows.setdefault(b" ".join(w), set()).add(item)
    return {s: tuple(sorted(p)) for s, p in prefixes.items()}, windows


def _match(ws: list[bytes], firsts: dict, prefixes: dict, windows: dict) -> tuple[list[tuple[int, int]], set[str]]:
    spans, items = set(), set()
    for i, s in _occurrences(ws, firsts, prefixes):
        for offset, n in prefixes[s]:
            start = i - offset
            if start >= 0 and start + n <= len(ws):
                found = windows.get(b" ".join(ws[start : start + n]))
                if found:
                    spans.add((start, start + n))
                    items |= found
    return _merged(spans), items


def _merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``row`` (all its columns), n_words, merged ``spans`` of hit words and the ``items`` found."""
    spark, found, rest = docs.sparkSession, None, packed(docs)
    for k, block in enumerate(_blocks(benchmark, block_bytes)):
        shingles = sorted({b" ".join(w[i : i + min(shingle, len(w))]) for _, t in block for w in _windows(words(t), window) for i in range(len(w) - min(shingle, len(w)) + 1)})
        counts = _shingle_counts(docs, shingles) if shingles else {}
        prefixes, windows = _prefixes(block, counts, window, shingle)
        sent = spark.sparkContext.broadcast((_firsts(prefixes), prefixes, windows))

        def match(batches, sent=sent, later=k > 0):
            firsts, prefixes, windows = sent.value
            for batch, texts in row_slices(batches):
                n_words, spans, items = [], [], []
                before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist()) if later else ((None, None) for _ in texts)
                for text, (old, had) in zip(texts, before):
                    ws = words(text)
                    s, i = _match(ws, firsts, prefixes, windows)
                    s = _merged([*s, *((x["start"], x["end"]) for x in old)]) if old else s
                    n_words.append(len(ws))
                    spans.append([{"start": a, "end": b} for a, b in s])
                    items.append(sorted(i | set(had or ())))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(n_words, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))],
                    ["row", "n_words", "spans", "items"],
                )

        if found is not None:
            rest = stage_table(found, "benchmark-hits")  # one block of the benchmark in memory at a time
        found = rest.mapInArrow(match, f"row {rest.schema['row'].dataType.simpleString()}, {_HITS}")
    return found


def n_hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["end"] - s["start"])


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit word."""
    return benchmark_hits(docs, benchmark, **options).where(F.size("spans") == 0).select("row.*")
