"""Near-duplicate classes by DartMinHash.

A text is the weighted set of its runs of ``SHINGLE`` words, the weight of a run being how often it occurs; a shorter text
is one run. Every unit of weight of an element owns a random sequence of darts, a rate-1 point process along a rank axis
whose points, buckets and names come from hashes of (element, unit, number of the dart). The darts that fall under a text's
weights and below rank ``T / total weight`` are about ``T`` in number however long the text is. The earliest dart of each of the
``BANDS * ROWS`` coordinates is the signature; texts with an empty coordinate get twice as many darts until none is empty.
Two texts agree in a coordinate with the probability of their weighted Jaccard similarity.

* Texts with the same words are one node: they are folded by a hash of their words, so copies cost no pairs.
* Nodes meet in buckets, one per band of ``ROWS`` coordinates. First every member is compared with the node of the bucket that
  meets most others, then the next ``LEADERS`` such nodes with the members of other classes, which joins nearly all that
  belongs together. The nodes of buckets that still hold several classes go through an exact prefix join, which
  proposes every pair of different classes that can reach the threshold: no candidate link is lost, pairs within a class are
  not built, and texts that merely share a common passage propose none.
* A comparison is the exact weighted Jaccard similarity of both whole texts; ``threshold`` (0.8) or more is a link.
* Classes are the connected components of the links, found by label rounds with pointer jumps on tables.

With 32 bands of 6 a pair at exactly 0.8 is missed with probability 6e-5, one at 0.9 with less than 1e-10.

Nulls: a text without words (null, empty, punctuation only) is a class of its own. Ties and repeated rows: the smallest id
of the class stays (null last), and of rows that repeat it the first one read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_sizes, cuts, mix, packed, row_slices, shingle_hashes, stage_table, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 6
LEADERS = 4  # nodes of a bucket that are compared with its other classes in the second round
SLICE_ROWS = 256  # a text has about BANDS * ROWS * 7 darts, however short it is
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def _units(elements: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The number of each occurrence of an element within its text: 0, 1, ..."""
    order = np.lexsort((elements, owner))
    e, o = elements[order], owner[order]
    new = np.ones(len(e), dtype=bool)
    new[1:] = (e[1:] != e[:-1]) | (o[1:] != o[:-1])
    run = np.arange(len(e)) - np.maximum.accumulate(np.where(new, np.arange(len(e)), 0))
    units = np.empty(len(e), dtype=np.int64)
    units[order] = run
    return units


def _darts(seeds: np.ndarray, owner: np.ndarray, limit: np.ndarray):
    """(owner, rank, name) of the darts with a rank below the owner's limit; seeds stand for the units of weight."""
    seeds, owner, bound = seeds, owner, limit[owner]
    rank = np.zeros(len(seeds))
    out: list[tuple] = []
    number = 0
    while len(seeds):
        number += 1
        name = mix(seeds + _U(number * int(_STEP) % 2**64))
        rank = rank - np.log(((name >> _U(11)).astype(np.float64) + 0.5) / float(1 << 53))
        live = rank < bound
        seeds, owner, bound, rank, name = seeds[live], owner[live], bound[live], rank[live], name[live]
        out.append((owner, rank, mix(name ^ _STEP)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int), np.zeros(0), np.zeros(0, _U))


def signatures(elements: np.ndarray, owner: np.ndarray, n_texts: int, coordinates: int) -> np.ndarray:
    """(n_texts, coordinates) names of the earliest darts; rows of texts without elements are zero. ``owner`` is sorted."""
    out = np.zeros((n_texts, coordinates), dtype=_U)
    weight = np.bincount(owner, minlength=n_texts)
    seeds = mix(elements + mix(_units(elements, owner).astype(_U) + _U(1)))
    todo = np.flatnonzero(weight)
    darts = coordinates * (math.log(coordinates) + 1.5)
    while len(todo):
        picked = np.zeros(n_texts, dtype=bool)
        picked[todo] = True
        mine = picked[owner]
        limit = np.zeros(n_texts)
        limit[todo] = darts / weight[todo]
        o, rank, name = _darts(seeds[mine], owner[mine], limit)
        cell = o * coordinates + (name % _U(coordinates)).astype(np.int64)
        best = np.full(n_texts * coordinates, np.inf)
        np.minimum.at(best, cell, rank)
        win = rank == best[cell]
        flat = out.reshape(-1)
        flat[cell[win]] = name[win]
        full = np.isfinite(best.reshape(n_texts, coordinates)[todo]).all(axis=1)
        todo = todo[~full]
        darts *= 2
    return out


def _sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes, owner = word_hashes(texts)
    elements, of = shingle_hashes(hashes, owner, len(texts), SHINGLE)
    n_words = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    place = (np.arange(len(hashes)) - first[owner]).astype(_U)
    node = np.zeros(len(texts), dtype=_U)
    np.add.at(node, owner, mix(hashes + mix(place + _U(7))))  # depends on every word and its place
    return elements, of, np.where(n_words > 0, mix(node + n_words.astype(_U)), _U(0))


def _signed(text_column: str, id_column: str):
    def run(batches):
        for batch, texts in row_slices(batches, text_column, rows=SLICE_ROWS):
            rows = batch.column("row")
            elements, of, node = _sets(texts)
            names = signatures(elements, of, len(texts), BANDS * ROWS).reshape(len(texts), BANDS, ROWS)
            keys = np.zeros((len(texts), BANDS), dtype=_U)
            for j in range(ROWS):
                keys = mix(keys + names[:, :, j])
            keys = mix(keys + np.arange(BANDS, dtype=_U)).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * BANDS, pa.int32()), pa.array(keys.reshape(-1)))
            nodes = pa.array(node.view(np.int64), mask=node == 0)
            ids = rows.field(rows.type.get_field_index(id_column)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([rows, ids, nodes, lists], ["row", "id", "node", "keys"])

    return run


def similarity(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Exact weighted Jaccard similarities of pairs of texts, by their shingle hashes."""
    n = len(left)
    (a, oa, _), (b, ob, _) = _sets(left), _sets(right)
    keys = np.concatenate([a, b])
    pair = np.concatenate([oa, ob])
    side = np.concatenate([np.ones(len(a), np.int64), np.zeros(len(b), np.int64)])
    order = np.lexsort((keys, pair))
    keys, pair, side = keys[order], pair[order], side[order]
    if not len(keys):
        return np.zeros(n)
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (pair[1:] != pair[:-1])
    at = np.flatnonzero(new)
    in_left = np.add.reduceat(side, at)
    in_right = np.add.reduceat(1 - side, at)
    both = np.bincount(pair[at], weights=np.minimum(in_left, in_right), minlength=n)
    either = np.bincount(pair[at], weights=np.maximum(in_left, in_right), minlength=n)
    return both / np.maximum(either, 1)


def _linked(threshold: float):
    def run(batches):
        for batch in batches:
            texts = [batch.column(c).cast(pa.binary()) for c in ("a_text", "b_text")]
            for a, b in cuts(map(sum, zip(*map(byte_sizes, texts))), rows=batch.num_rows):
                ok = similarity(*(x.slice(a, b - a).to_pylist() for x in texts)) >= threshold
                yield batch.select(["a", "b"]).slice(a, b - a).filter(pa.array(ok))

    return run


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes at or above the threshold. Copies of a hot node's text go only where its pairs are."""
    with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
    both = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
    return both.select("a", "b", "a_text", "b_text").mapInArrow(_linked(threshold), "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, class): the smallest node of each connected component, for all nodes that have a link.

    In each round every class takes the smallest label that a neighbour of one of its nodes has, and follows the label that
    this class itself takes (a pointer jump), so chains shrink by half at least. Each round is a table; the rounds end when
    no label changes.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = stage_table(both, "links")
    labels = stage_table(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("class")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "class"), "b").groupBy("a").agg(F.min("class").alias("m"))
        met = labels.join(near.withColumnRenamed("a", "node"), "node")
        told = stage_table(met.groupBy("class").agg(F.min("m").alias("m")).select(F.col("class").alias("old"), F.least("class", "m").alias("new")), "told")
        if not told.where("new <> old").limit(1).count():
            return labels
        onward = told.select(F.col("old").alias("new"), F.col("new").alias("next"))
        jump = told.join(onward, "new", "left").select("old", F.least("new", F.coalesce("next", "new")).alias("new"))
        moved = labels.join(jump, labels["class"] == jump["old"], "left").select("node", F.coalesce("new", "class").alias("class"))
        labels = stage_table(moved, "labels")


def _open(buckets: DataFrame, labels: DataFrame, low: int) -> DataFrame:
    """Members, with their classes, of the buckets that hold several classes and nodes beyond the first ``low`` ones."""
    known = buckets.join(labels, "node", "left").select("key", "place", "node", F.coalesce("class", "node").alias("class"))
    mixed = known.groupBy("key").agg(F.min("class").alias("x"), F.max("class").alias("y"), F.max("place").alias("last"))
    return known.join(mixed.where((F.col("x") != F.col("y")) & (F.col("last") >= low)).select("key"), "key", "left_semi")


def _round_pairs(members: DataFrame, low: int, high: int) -> DataFrame:
    """Pairs of the ``low``-th to ``high - 1``-th node of a bucket with later nodes of other classes."""
    lead = members.where((F.col("place") >= low) & (F.col("place") < high)).select("key", F.col("place").alias("p"), F.col("node").alias("a"), F.col("class").alias("c"))
    return lead.join(members, "key").where("place > p and class <> c").select("a", F.col("node").alias("b")).distinct()


def _elements(batches):
    """(node, element, size): the units of weight of each text, the n-th occurrence of a shingle being an element of its own."""
    for batch in batches:
        nodes, texts = batch.column("node").to_numpy(), batch.column("text").cast(pa.binary())
        for a, b in cuts(byte_sizes(texts), rows=SLICE_ROWS):
            shingled, of, _ = _sets([t or b"" for t in texts.slice(a, b - a).to_pylist()])
            units = mix(shingled + mix(_units(shingled, of).astype(_U) + _U(1))).view(np.int64)
            size = np.bincount(of, minlength=b - a)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[a:b][of]), pa.array(units), pa.array(size[of])], ["node", "element", "size"])


def _prefix_pairs(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """All pairs of nodes of different classes that can reach the threshold, among the members of open buckets.

    Elements are ordered by how few of these nodes hold them. Two texts at the threshold share an element among the first few
    of each, as many as the overlap they need leaves over, at places that leave room for that overlap. What many texts share, a
    passage say, comes last and proposes no pair.
    """
    nodes = members.select("node", "class").distinct()
    held = texts.join(nodes.select("node"), "node", "left_semi").mapInArrow(_elements, "node bigint, element bigint, size bigint")
    held = stage_table(held, "elements")
    spread = held.groupBy("element").agg(F.count(F.lit(1)).alias("df"))
    rarest = Window.partitionBy("node").orderBy("df", "element")  # one text's elements
    needed = F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1
    # ``shared``: how many of the elements up to this one some other text holds at all.
    placed = held.join(spread, "element").withColumns({"nth": F.row_number().over(rarest), "shared": F.sum(F.when(F.col("df") > 1, 1).otherwise(0)).over(rarest)})
    prefix = placed.where((F.col("nth") <= needed) & (F.col("df") > 1)).join(nodes, "node").select("element", "node", "class", "size", "nth", "shared")
    prefix = stage_table(prefix, "prefixes")
    per_class = prefix.groupBy("element", "class").agg(F.count(F.lit(1)).alias("n"))
    main = per_class.groupBy("element").agg(F.max_by("class", F.struct("n", "class")).alias("main"), F.count(F.lit(1)).alias("classes")).where("classes > 1")
    # Of two nodes of different classes one at least is outside the element's largest class.
    one = prefix.join(main, "element").where("class <> main").select("element", *[F.col(c).alias(f"a_{c}") for c in prefix.columns if c != "element"])
    # The overlap that a pair of these sizes needs; a pair that has it shares one of the first ``size - overlap + 1`` of each.
    overlap = f"ceil((a_size + size) * {threshold / (1 + threshold)} - 1e-9)"
    # What two texts can share at most, seen from this element: the shared elements so far, and all that follow.
    most = "least(a_shared, shared) + least(a_size - a_nth, size - nth)"
    fits = f"class <> a_class and a_nth <= a_size - {overlap} + 1 and nth <= size - {overlap} + 1 and {most} >= {overlap}"
    return one.join(prefix, "element").where(fits).select(F.least("a_node", "node").alias("a"), F.greatest("a_node", "node").alias("b")).distinct()


def _links(buckets: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(node, class) of all nodes with a link."""
    first = buckets.where("place > 0").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = stage_table(_verified(first, texts, threshold), "links")
    labels = components(links)
    for low, high in ((1, 1 + LEADERS), (1 + LEADERS, None)):
        members = stage_table(_open(buckets, labels, low), "open-buckets")
        if not members.limit(1).count():
            break
        pairs = _prefix_pairs(members, texts, threshold) if high is None else _round_pairs(members, low, high)
        links = stage_table(links.union(_verified(pairs, texts, threshold)), "links")
        labels = components(links)
    return labels


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``row`` (all columns), class_id (smallest id of the class), class_size and kept."""
    wide = packed(docs)
    signed = wide.mapInArrow(_signed(text_column, id_column), f"row {wide.schema['row'].dataType.simpleString()}, id bigint, node bigint, keys array<bigint>")
    signed = stage_table(signed.withColumn("rid", F.monotonically_increasing_id()), "signatures")
    rows = signed.select("rid", "id", "node")

    # Copies fold here, map-side first; their ids are all that is kept of them.
    first_row = F.struct(F.col("id").isNull().alias("none"), "id", "rid")
    nodes = signed.where("node is not null").groupBy("node").agg(F.min_by("keys", "rid").alias("keys"))
    members = nodes.select("node", F.explode("keys").alias("key"))  # a key already mixes in its band
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = stage_table(members.join(shared, "key"), "met")
    central = met.groupBy("node").agg(F.sum("size").alias("weight"))  # how many nodes it meets, band by band
    inside = Window.partitionBy("key").orderBy(F.desc("weight"), "node")
    buckets = met.join(central, "node").select("key", "node", F.first("node").over(inside).alias("first"), (F.row_number().over(inside) - 1).alias("place"))
    buckets = stage_table(buckets, "buckets")

    texts = signed.where("node is not null").select("node", "rid", F.col(f"row.{text_column}").alias("text"))
    texts = texts.join(buckets.select("node").distinct(), "node", "left_semi")
    holder = texts.groupBy("node").agg(F.min("rid").alias("rid"))
    texts = stage_table(texts.join(holder, ["node", "rid"], "left_semi").select("node", "text"), "texts")
    labels = _links(buckets, texts, threshold)

    by_node = rows.where("node is not null").groupBy("node").agg(F.min(first_row).alias("best"), F.count(F.lit(1)).alias("n"))
    classed = by_node.join(labels, "node", "left").withColumn("class", F.coalesce("class", "node"))
    by_class = classed.groupBy("class").agg(F.min("best").alias("best"), F.sum("n").alias("size"))
    lookup = classed.select("node", "class").join(by_class, "class").select("node", "best", "size")
    lookup = stage_table(lookup, "classes")
    flags = signed.select("row", "rid", "id", "node").join(lookup, "node", "left")
    return flags.select(
        "row",
        F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("class_id"),
        F.coalesce("size", F.lit(1)).alias("class_size"),
        F.coalesce(F.col("best.rid") == F.col("rid"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class."""
    return classes(docs, **options).where("kept").select("row.*")
