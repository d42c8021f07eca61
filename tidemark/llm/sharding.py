"""Range sharding by sampled splitters; DataFrame functions only.

Rows are ordered by the hash of their text, so equal texts are neighbours, then by id. A sample of at most about
``samples`` keys is drawn with a probability proportional to the rows' sizes; its quantiles are the splitters of
``ranges`` key ranges of nearly equal bytes; the row's own number ends the key, so that rows with equal texts and ids can be split as well.
Each row finds its range through a small table of key cells, the bytes of the ranges are added up exactly, and a range
that is overfull all the same (an unlucky draw) is subdivided by the hash of the row. Running sums inside these ranges and the totals of the ranges before them give every row its exact
place in the byte order, which is cut into ``shards`` equal parts: a shard's bytes differ from the mean by less than the
largest row.

Nulls: a null text has no bytes, crc32 0 and the hash of the empty text; a null id sorts first. Repeated rows are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table

SHARDS = 24
ROW_BYTES = 8
RANGES = 1024
SAMPLES_PER_RANGE = 16
CELLS = 4096
#: A range of more than this many mean ranges, and the rows between two splitters where all rows are drawn, is subdivided.
OVERFULL = 2


def keys(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """rid, id, size, text_crc32 and the order hash of every row, written once."""
    data = F.coalesce(F.col(text_column).cast("binary"), F.lit("").cast("binary"))
    slim = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(id_column).cast("bigint").alias("id"),
        (F.octet_length(data) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.xxhash64(data).alias("hash"),
    )
    return stage_table(slim, "shard-keys")


def _cell(hash_column: str, cells: int) -> Column:
    """The cell of a 64-bit hash: its top bits, in the order of the hashes."""
    return F.shiftright(F.col(hash_column), 64 - (cells - 1).bit_length()) + cells // 2


def splitters(keyed: DataFrame, total: Column, ranges: int = RANGES, samples: int = SAMPLES_PER_RANGE) -> DataFrame:
    """(hash, id, rid, place): at most about ``ranges`` boundaries, quantiles of a size-weighted sample of ``ranges * samples`` keys."""
    chance = F.col("size").cast("double") * ranges * samples / total
    draw = F.pmod(F.xxhash64("rid", "hash", F.lit(8)), F.lit(1 << 53)).cast("double") / float(1 << 53)
    drawn = keyed.where(draw < chance).select("hash", "id", "rid")
    order = Window.orderBy("hash", F.col("id").asc_nulls_first(), "rid")
    placed = drawn.withColumn("place", F.row_number().over(order)).where(F.pmod("place", F.lit(samples)) == 0)
    return placed.withColumn("place", (F.col("place") / samples).cast("int"))


def _ranged(keyed: DataFrame, cuts: DataFrame, cells: int = CELLS) -> DataFrame:
    """Adds ``range``: the number of splitters at or before the row's key. A cell holds the count of the splitters before it
    and the list of its own; the table of cells has ``cells`` rows."""
    own = cuts.withColumn("cell", _cell("hash", cells)).groupBy("cell").agg(
        F.array_sort(F.collect_list(F.struct("hash", F.col("id"), "rid"))).alias("own"), F.count(F.lit(1)).alias("n")
    )
    every = keyed.sparkSession.range(cells).withColumnRenamed("id", "cell").join(own, "cell", "left")
    before = F.sum(F.coalesce("n", F.lit(0))).over(Window.orderBy("cell")) - F.coalesce("n", F.lit(0))
    lookup = every.select("cell", before.alias("before"), "own")
    key = F.struct("hash", "id", "rid")
    inside = F.coalesce(F.size(F.filter("own", lambda s: s <= key)), F.lit(0))
    joined = keyed.withColumn("cell", _cell("hash", cells)).join(F.broadcast(lookup), "cell")
    return joined.select(*keyed.columns, (F.col("before") + F.when(F.col("own").isNull(), 0).otherwise(inside)).cast("int").alias("range"))


def sharded(
    docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text", ranges: int = RANGES, samples: int = SAMPLES_PER_RANGE
) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, shard, slot (gapless from 0 in key order within the shard)."""
    keyed = keys(docs, id_column, text_column)
    total = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("t")).first()["t"]
    placed = _ranged(keyed, splitters(keyed, F.lit(float(max(total, 1))), ranges, samples))
    sizes = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.max("size").alias("largest"))
    mean = max(1.0, total / ranges)
    pieces = F.when(F.col("bytes") > OVERFULL * mean + samples * F.col("largest"), F.ceil(F.col("bytes") / mean)).otherwise(1)
    overfull = sizes.select("range", pieces.cast("int").alias("pieces")).where("pieces > 1")
    divided = placed.join(F.broadcast(overfull), "range", "left").select(
        *placed.columns, F.coalesce(F.pmod(F.xxhash64("rid", F.lit(9)), F.col("pieces")), F.lit(0)).cast("int").alias("sub")
    )
    divided = stage_table(divided, "shard-ranges")

    ordered = Window.orderBy("range", "sub").rowsBetween(Window.unboundedPreceding, -1)
    totals = divided.groupBy("range", "sub").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    offsets = totals.select(
        "range", "sub", F.coalesce(F.sum("bytes").over(ordered), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("rows").over(ordered), F.lit(0)).alias("rows_before")
    )
    inside = Window.partitionBy("range", "sub").orderBy("hash", F.col("id").asc_nulls_first(), "rid")
    local = divided.withColumns({"ahead": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"), "nth": F.row_number().over(inside) - 1})
    # The offsets have one row per range: at most `ranges` plus the subdivisions, which add up to `ranges` again.
    whole = local.join(F.broadcast(offsets), ["range", "sub"]).select(
        "id",
        "size",
        "text_crc32",
        "rid",
        (F.col("nth") + F.col("rows_before")).alias("place"),
        # The middle of the row decides, so no shard gets more than half a row too much at either end.
        F.floor((F.col("bytes_before") + F.col("ahead") + F.col("size") / 2.0) * shards / max(total, 1)).cast("int").alias("shard"),
    )
    whole = stage_table(whole, "shard-places")
    first = whole.groupBy("shard").agg(F.min("place").alias("first"))
    return whole.join(F.broadcast(first), "shard").select("id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"))
