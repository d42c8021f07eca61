"""Exact deduplication with the heavy digests split off; DataFrame functions only.

Texts are equal when they are identical without white space. Frequent digests are found with Spark's frequent-items
sketch (Misra-Gries counters, at most ``tracked`` of them), and the ``heavy`` most frequent of them, all by default, are
candidates.
Exact counts and winners of the candidates are aggregated map-side into at most ``heavy`` slim rows, which are
broadcast: rows of a heavy digest are settled in the task that reads them and never shuffled by digest. A candidate that
the sketch overrated is only a little wasted work, since its count and winner are exact. All other digests are shuffled
as usual; the sketch drops none that holds more than about ``4 / tracked`` of the rows, so no group is larger.

Of equal texts the one with the most code points stays, then the smallest id (null last), then the first row read.
A null text counts as empty. Repeated rows are members of their group like any other; one of them stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table

TRACKED = 4096
HEAVY = TRACKED


def normalised(column: str = "text") -> Column:
    """The text without the characters of `[\\x20\\x09-\\x0D]`; null counts as empty."""
    return F.translate(F.coalesce(F.col(column), F.lit("")), " \t\n\x0b\x0c\r", "")


def _before(column: str) -> Column:
    """Larger for smaller ids, smallest for null; the complement of an id has no overflow."""
    return F.struct(F.col(column).isNotNull().alias("known"), F.bitwise_not(F.coalesce(F.col(column), F.lit(0).cast("bigint"))).alias("id"))


def _rank() -> Column:
    """Larger is better: code points, then small id (null last), then small row id."""
    return F.struct(F.col("points").alias("points"), _before("id").alias("before"), (-F.col("rid")).alias("first"))


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """rid, id, points and digest of every row, written once."""
    keyed = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(id_column).cast("bigint").alias("id"),
        F.coalesce(F.length(text_column), F.lit(0)).cast("bigint").alias("points"),
        F.sha2(normalised(text_column).cast("binary"), 256).alias("digest"),
    )
    return stage_table(keyed, "digests")


def heavy_winners(keyed: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """digest, size, winner of the frequent digests: at most ``heavy`` rows."""
    candidates = (
        keyed.select(F.expr(f"approx_top_k(digest, {heavy}, {tracked})").alias("top"))
        .select(F.explode("top").alias("top"))
        .where("top.count > 1")
        .select(F.col("top.item").alias("digest"))
    )
    return (
        keyed.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("size"), F.max(_rank()).alias("winner"))
    )


def duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """One row per row of ``docs``: rid, id, keep_id (id of the row that stays), group_size, kept, digest."""
    keyed = digests(docs, id_column, text_column)
    winners = stage_table(heavy_winners(keyed, heavy, tracked), "heavy-digests")
    joined = keyed.join(F.broadcast(winners), "digest", "left")
    settled = joined.where("size is not null").select("rid", "id", "digest", "size", "winner")
    group = Window.partitionBy("digest")
    rest = (
        keyed.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumns({"size": F.count(F.lit(1)).over(group), "winner": F.max(_rank()).over(group)})
        .select("rid", "id", "digest", "size", "winner")
    )
    return settled.unionByName(rest).select(
        "rid",
        "id",
        F.when(F.col("winner.before.known"), F.bitwise_not(F.col("winner.before.id"))).alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("winner.first") == -F.col("rid")).alias("kept"),
        "digest",
    )


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """The rows of ``docs`` that stay. Rows of a heavy digest are filtered where they are read; the others are ranked within
    their digest after one shuffle."""
    winners = stage_table(heavy_winners(digests(docs, id_column, text_column), heavy, tracked), "heavy-digests")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(
        "row",
        F.col(f"row.{id_column}").cast("bigint").alias("id"),
        F.coalesce(F.length(f"row.{text_column}"), F.lit(0)).cast("bigint").alias("points"),
        F.sha2(normalised(f"row.{text_column}").cast("binary"), 256).alias("digest"),
    )
    best = winners.select("digest", F.col("winner.points").alias("w_points"), F.col("winner.before").alias("w_id"))
    tagged = rows.join(F.broadcast(best), "digest", "left")
    # Equal rows of a heavy winner meet in a map-side combined aggregate; everything else of its group ends in the filter.
    heavy_rows = tagged.where((F.col("points") == F.col("w_points")) & (_before("id") == F.col("w_id"))).dropDuplicates(["digest"]).select("row")
    order = Window.partitionBy("digest").orderBy(F.col("points").desc(), F.col("id").asc_nulls_last())
    light_rows = tagged.where("w_points is null").withColumn("place", F.row_number().over(order)).where("place = 1").select("row")
    return heavy_rows.unionByName(light_rows).select("row.*")
