"""Ranked lexical search, reversed: the index is over the queries and the documents stream through it.

A broadcast inverted index holds, for each term of the items, the items that have it and how often. One pass over all documents
counts how many hold each of these terms, all documents with a term and all their terms. A second pass turns each document's
term counts into scores by way of the postings and keeps a heap of the ``depth`` best documents per item; Spark merges the heaps
of all tasks, in two steps so that no task gets the heaps of all others.

The index is bounded: items are dealt to blocks of at most ``BLOCK_BYTES`` of text and ``BLOCK_ITEMS`` items, whose sizes are
measured before a block is fetched, and documents pass through one block after the other. Only an item that is longer than a
block by itself makes a larger one.

Terms are the runs of digits, letters and characters beyond ASCII, A-Z in lower case. A null text has none. Items without terms,
or whose terms no document has, give no rows. Repeated items are ranked each on their own, repeated documents take a place each.
Equal scores are ordered by the document's id, null ids last. Ids of documents are whole numbers; a null item id stays null.
Other columns are not looked at. Without items or documents the result is empty.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table, words

BLOCK_BYTES = 16 << 20
BLOCK_ITEMS = 1 << 16
#: Cells of the score table of a slice and postings read at once by a worker.
CELLS = 1 << 21
#: Parts in which the heaps of one item are merged before they meet.
MERGE_PARTS = 256

# Fixed values of the ranking formula.
LENGTH_SHARE = 75
WEIGHT_SCALE = 1000
SCORE_SCALE = 10**9
SATURATION = 8

_NO_ID = np.iinfo(np.int64).max


class Index(NamedTuple):
    """Items by number; the postings of term t are ``first[t]:first[t + 1]``."""

    numbers: np.ndarray
    terms: dict[bytes, int]
    first: np.ndarray
    items: np.ndarray
    times: np.ndarray


def build_index(numbers: list[int], texts: list[bytes]) -> Index:
    terms: dict[bytes, int] = {}
    of, at = [], []
    for i, text in enumerate(texts):
        found = [terms.setdefault(w, len(terms)) for w in words(text)]
        of.append(np.array(found, dtype=np.int64))
        at.append(np.full(len(found), i, dtype=np.int64))
    key = np.concatenate([np.zeros(0, np.int64), *of]) * max(len(texts), 1) + np.concatenate([np.zeros(0, np.int64), *at])
    key, times = np.unique(key, return_counts=True)
    term, item = np.divmod(key, max(len(texts), 1))
    first = np.searchsorted(term, np.arange(len(terms) + 1))
    return Index(np.array(numbers, dtype=np.int64), terms, first, item, times)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()]


def _counts(docs: DataFrame, index) -> DataFrame:
    """(term, documents that hold it); term -1 counts the documents with a term, -2 all terms."""

    def run(batches):
        known = index.value.terms
        names = frozenset(known)
        held = np.zeros(len(known), dtype=np.int64)
        n_docs = n_terms = 0
        for batch in batches:
            for text in _texts(batch):
                found = words(text)
                n_docs += bool(found)
                n_terms += len(found)
                held[[known[w] for w in names.intersection(found)]] += 1
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1, -2], seen]), pa.int64()), pa.array(np.concatenate([[n_docs, n_terms], held[seen]]), pa.int64())], ["term", "n"]
        )

    return docs.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


class _Heaps:
    """The ``depth`` best (score, id) per item: higher scores first, then lower ids; score 0 is an empty place."""

    def __init__(self, n_items: int, depth: int):
        self.score = np.zeros((n_items, depth), dtype=np.int64)
        self.id = np.full((n_items, depth), _NO_ID, dtype=np.int64)
        self.null = np.ones((n_items, depth), dtype=bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``scores`` is documents x items; only what reaches an item's last place is sorted in."""
        last, last_id = self.score[:, -1], self.id[:, -1]
        row, item = np.nonzero((scores > last) | ((scores == last) & (last > 0) & (ids[:, None] <= last_id)))
        if not len(row):
            return
        touched, item = np.unique(item, return_inverse=True)
        depth = self.score.shape[1]
        of = np.concatenate([np.repeat(np.arange(len(touched)), depth), item])
        score = np.concatenate([self.score[touched].ravel(), scores[row, touched[item]]])
        id_ = np.concatenate([self.id[touched].ravel(), ids[row]])
        empty = np.concatenate([self.null[touched].ravel(), null[row]])
        order = np.lexsort((empty, id_, -score, of))
        starts = np.searchsorted(of[order], np.arange(len(touched)))
        best = order[starts[:, None] + np.arange(depth)]
        self.score[touched], self.id[touched], self.null[touched] = score[best], id_[best], empty[best]


def _slice_scores(texts: list[bytes], index: Index, weight: np.ndarray, n_docs: int, n_terms: int):
    """Score tables (first document, documents x items) of a slice, at most ``CELLS`` cells and about as many postings at a time."""
    n_items, known = len(index.numbers), index.terms.get
    step = max(1, CELLS // max(n_items, 1))
    for a in range(0, len(texts), step):
        part = [words(t) for t in texts[a : a + step]]
        sizes = np.array([len(w) for w in part], dtype=np.int64)
        code = np.fromiter((known(w, -1) for ws in part for w in ws), dtype=np.int64, count=int(sizes.sum()))
        doc = np.repeat(np.arange(len(part)), sizes)
        key, tf = np.unique((doc * len(index.terms) + code)[code >= 0], return_counts=True)
        doc, term = np.divmod(key, max(len(index.terms), 1))
        length = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * int(n) * n_docs // n_terms for n in sizes], dtype=np.int64)
        gain = weight[term] * ((SCORE_SCALE * tf) // (WEIGHT_SCALE * tf + SATURATION * length[doc]))
        scores = np.zeros(len(part) * n_items, dtype=np.int64)
        posts = index.first[term + 1] - index.first[term]
        total = np.cumsum(posts)
        b = 0
        while b < len(key):
            e = max(b + 1, int(np.searchsorted(total, total[b] - posts[b] + CELLS, side="right")))
            n = posts[b:e]
            at = np.arange(n.sum()) + np.repeat(index.first[term[b:e]] - (np.cumsum(n) - n), n)
            np.add.at(scores, np.repeat(doc[b:e] * n_items, n) + index.items[at], np.repeat(gain[b:e], n) * index.times[at])
            b = e
        yield a, scores.reshape(len(part), n_items)


def _best(docs: DataFrame, index, weight, n_docs: int, n_terms: int, depth: int) -> DataFrame:
    """Each task's heaps: item number, doc_id, score."""

    def run(batches):
        own, gain = index.value, weight.value
        heaps = _Heaps(len(own.numbers), depth)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("id"))
            null = column.is_null().to_numpy(zero_copy_only=False)
            ids = column.fill_null(_NO_ID).to_numpy()
            texts = _texts(batch)
            for i in range(0, len(texts), 512):
                for a, scores in _slice_scores(texts[i : i + 512], own, gain, n_docs, n_terms):
                    part = slice(i + a, i + a + len(scores))
                    heaps.add(scores, ids[part], null[part])
        item, place = np.nonzero(heaps.score)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(own.numbers[item], pa.int64()),
                pa.array(heaps.id[item, place], pa.int64(), mask=heaps.null[item, place]),
                pa.array(heaps.score[item, place], pa.int64()),
            ],
            ["item_no", "doc_id", "score"],
        )

    found = docs.mapInArrow(run, "item_no bigint, doc_id bigint, score bigint").withColumn("part", F.spark_partition_id() % MERGE_PARTS)
    first = Window.partitionBy("item_no", "part").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    kept = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= depth)
    last = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return kept.select("item_no", "doc_id", "score", F.row_number().over(last).alias("rank")).where(F.col("rank") <= depth)


def _blocks(items: DataFrame, block_bytes: int, block_items: int) -> tuple[DataFrame, int]:
    """``items`` with a block number; blocks are made smaller until none exceeds the bounds, but for one that is a single item."""
    size, n = items.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    count = max(1, -(-(size or 0) // block_bytes), -(-n // block_items))
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item_no"), F.lit(count)))
        sums = dealt.groupBy("block").agg(F.sum(F.octet_length("text")).alias("size"), F.count(F.lit(1)).alias("n"))
        if not sums.where(F.col("n") > 1).where((F.col("size") > block_bytes) | (F.col("n") > block_items)).take(1):
            return dealt, count
        count *= 2


def search(
    items: DataFrame,
    docs: DataFrame,
    depth: int = 10,
    item_id: str = "item_id",
    doc_id: str = "doc_id",
    text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``depth`` best documents of each item with a score above 0."""
    spark = items.sparkSession
    numbered = items.select(F.col(item_id).alias("item_id"), F.col(text_column).cast("string").alias("text"))
    numbered = stage_table(numbered.withColumn("item_no", F.monotonically_increasing_id()), "search-items")
    slim = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    dealt, count = _blocks(numbered, block_bytes, block_items)
    found = []
    for block in range(count):
        rows = dealt.where(F.col("block") == block).select("item_no", "text").collect()  # bounded by block_bytes
        index = build_index([r.item_no for r in rows], [(r.text or "").encode() for r in rows])
        if not index.terms:
            continue
        shared = spark.sparkContext.broadcast(index)
        held = {r.term: r.n for r in _counts(slim, shared).collect()}  # one number per term of the block
        n_docs, n_terms = held.get(-1, 0), held.get(-2, 0)
        if n_terms:
            weight = [math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(index.terms))]
            weights = spark.sparkContext.broadcast(np.array(weight, dtype=np.int64))
            found.append(_best(slim, shared, weights, n_docs, n_terms, depth))
    if not found:
        found = [spark.createDataFrame([], "item_no bigint, doc_id bigint, score bigint, rank int")]
    return reduce(DataFrame.unionByName, found).join(numbered.select("item_no", "item_id"), "item_no").select("item_id", "rank", "doc_id", "score")
