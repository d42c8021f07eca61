"""Historical market values from closes and as-reported share counts.

Share counts arrive per symbol with duplicates, renames and split jumps that lead or lag the split date. They are put
on the split basis of the (already split-adjusted) closes and carried to the price dates.

Every table here has one row per entity and day after its first aggregate, which folds map-side. A window over an entity
is therefore no longer than the days of the history, however many raw rows the entity has.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import col, finite, number, positive, ratio
from ..session import settle
from .chunks import ORDER
from .prepare import MARKET_MAX_AGE_DAYS

# Fixed values of the share clean-up.
SPIKE_RATIO = 1.20
NEIGHBOUR_RATIO = 1.10
SEARCH_DAYS = 60
SPLIT_TOLERANCE = 0.35
HISTORY_START = "2015-01-01"

#: Consecutive split dates that are scanned as one array.
PIECE_DAYS = 256


def _by_day():
    return Window.partitionBy("entity").orderBy(ORDER)


def current_symbol(symbol: Column, aliases: Mapping[str, Sequence[str]]) -> tuple[Column, Column]:
    """(current name, position in its alias list) of a symbol; the lists run from the oldest name to the current one."""
    name, place = symbol, F.lit(0)
    for current, history in aliases.items():
        for i, old in enumerate(history):
            name = F.when(symbol == old, F.lit(current)).otherwise(name)
            place = F.when(symbol == old, F.lit(i)).otherwise(place)
    return name, place


def split_events(splits: DataFrame) -> DataFrame:
    """Real splits only; several ratios on one date multiply."""
    r = number("ratio")
    real = splits.select("entity", ORDER, r.alias("ratio")).filter((F.col("ratio") > 0) & (F.col("ratio") != 1))
    return real.groupBy("entity", ORDER).agg(F.product("ratio").alias("ratio"))


def select_observations(shares: DataFrame, splits: DataFrame, piece_days: int = PIECE_DAYS) -> DataFrame:
    """One share count per date.

    The last candidate (alias position, then ``seq``) wins, except on a split date with an earlier selected value:
    there the candidate nearest in log distance to previous x ratio. The choice depends on the previous one only on
    split dates with several candidates, so each run of such dates is scanned on its own. A run is cut into pieces of
    ``piece_days``: every piece is first reduced to the map from each candidate of the day before it to the value it
    ends with, the maps of the earlier pieces give the value a piece starts with, and the piece is then resolved.
    """
    if piece_days < 1:
        raise ValueError("a piece holds at least one day")
    clean = shares.select("entity", ORDER, positive(number("shares")).alias("shares"), "alias_position", "seq")
    place = F.struct("alias_position", "seq")
    values = (
        clean.filter(F.col("shares").isNotNull())
        .groupBy("entity", ORDER, "shares")
        .agg(F.min(place).alias("first_place"), F.max(place).alias("last_place"))
    )
    on_split = F.when(F.col("ratio").isNotNull(), F.struct("first_place", "shares"))
    days = (
        values.join(split_events(splits), ["entity", ORDER], "left")
        .groupBy("entity", ORDER)
        .agg(
            F.max("ratio").alias("ratio"),
            F.max_by("shares", "last_place").alias("last_value"),
            F.collect_list(on_split).alias("candidates"),
        )
    )
    settled = F.count(F.when(F.size("candidates") < 2, F.lit(1)))
    runs = days.withColumn("run", settled.over(_by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    in_run = F.row_number().over(Window.partitionBy("entity", "run").orderBy(ORDER)) - 1
    rows = F.sort_array(F.collect_list(F.struct(ORDER, "last_value", "ratio", "candidates")))
    # Grouping and windows below refine the partitioning by entity: no further exchange.
    pieces = runs.withColumn("piece", F.floor(in_run / piece_days)).groupBy("entity", "run", "piece").agg(rows.alias("rows"))

    def choice(before: Column, day: Column) -> Column:
        target = before * day["ratio"]
        near = F.transform(
            day["candidates"],
            lambda c: F.struct(
                F.abs(F.ln(c["shares"] / target)).alias("distance"), c["first_place"].alias("place"), c["shares"].alias("shares")
            ),
        )
        return F.when(before.isNull(), day["last_value"]).otherwise(F.array_min(near)["shares"])

    def pick(taken: Column, day: Column) -> Column:
        chosen = choice(F.element_at(taken, -1)["shares"], day)
        return F.concat(taken, F.array(F.struct(day[ORDER].alias(ORDER), chosen.alias("shares"))))

    by_piece = Window.partitionBy("entity", "run").orderBy("piece")
    unknown = F.array(F.lit(None).cast("double"))
    newest = F.element_at("rows", -1)
    possible = F.when(F.size(newest["candidates"]) == 0, F.array(newest["last_value"])).otherwise(newest["candidates"]["shares"])
    mapped = pieces.withColumn("starts", F.when(F.col("piece") == 0, unknown).otherwise(F.lag(possible).over(by_piece)))
    ends = F.aggregate("rows", F.col("starts"), lambda now, day: F.transform(now, lambda v: choice(v, day)))
    # Only a piece that another one follows is reduced to its map.
    followed = F.lead("piece").over(by_piece).isNotNull()
    step = F.when(F.col("followed"), F.struct("starts", ends.alias("ends")))
    earlier = F.collect_list("step").over(by_piece.rowsBetween(Window.unboundedPreceding, -1))
    through = lambda value, m: F.when(F.size(m["starts"]) == 1, m["ends"][0]).otherwise(
        F.element_at(m["ends"], F.array_position(m["starts"], value).cast("int"))
    )
    entry = F.aggregate("earlier", F.lit(None).cast("double"), through)
    entered = (
        mapped.withColumn("followed", followed)
        .withColumn("step", step)
        .withColumn("earlier", earlier)
        .select("entity", "rows", entry.alias("entry"))
    )
    # The value a piece starts with stands before its first day and goes again.
    start = F.array(F.struct(F.lit(None).cast("date").alias(ORDER), F.col("entry").alias("shares")))
    return entered.select("entity", F.inline(F.aggregate("rows", start, pick))).filter(F.col(ORDER).isNotNull())


def drop_spikes(shares: DataFrame) -> DataFrame:
    """Drop a single observation that differs from both neighbours while the neighbours agree."""
    here = F.ln("shares")
    near = shares.select("*", here.alias("_here"), F.lag(here).over(_by_day()).alias("_before"), F.lead(here).over(_by_day()).alias("_after"))
    apart = lambda a, b, limit: F.abs(F.col(a) - F.col(b)) > math.log(limit)
    lone = apart("_here", "_before", SPIKE_RATIO) & apart("_here", "_after", SPIKE_RATIO) & (F.abs(F.col("_after") - F.col("_before")) < math.log(NEIGHBOUR_RATIO))
    return near.filter(~F.coalesce(lone, F.lit(False))).drop("_here", "_before", "_after")


def split_transitions(shares: DataFrame, splits: DataFrame, search_days: int = SEARCH_DAYS) -> DataFrame:
    """The date on which each split shows up in the share counts.

    Splits and observations meet on (entity, day band) instead of a bare range condition.
    """
    band = search_days + 1
    number_of = lambda d: F.floor(F.unix_date(d) / F.lit(band))
    steps = shares.select("entity", F.col(ORDER).alias("seen"), ratio("shares", F.lag("shares").over(_by_day())).alias("step"), number_of(F.col(ORDER)).alias("band"))
    reach = F.sequence(number_of(F.date_sub(ORDER, search_days)), number_of(F.date_add(ORDER, search_days)))
    wide = split_events(splits).select("entity", ORDER, "ratio", F.explode(reach).alias("band"))
    near = wide.join(steps.filter("step IS NOT NULL"), ["entity", "band"], "left")
    inside = F.abs(F.datediff("seen", ORDER)) <= search_days
    distance = F.abs(F.ln(F.col("step") / F.col("ratio")))
    best = near.groupBy("entity", ORDER, "ratio").agg(F.min(F.when(inside, F.struct(distance.alias("distance"), "seen", "step"))).alias("best"))
    fits = F.abs(F.col("best.step") / F.col("ratio") - 1.0) <= SPLIT_TOLERANCE
    return best.select("entity", ORDER, "ratio", F.when(fits, F.col("best.seen")).otherwise(F.col(ORDER)).alias("transition"))


def split_adjust(shares: DataFrame, splits: DataFrame, search_days: int = SEARCH_DAYS) -> DataFrame:
    """Multiply every observation by the ratios of all splits that show up after it."""
    moves = split_transitions(shares, splits, search_days)
    events = moves.groupBy("entity", F.col("transition").alias(ORDER)).agg(F.product("ratio").alias("ratio"))
    nothing = lambda: F.lit(None).cast("double")
    both = shares.select("entity", ORDER, "shares", nothing().alias("ratio")).unionByName(events.select("entity", ORDER, nothing().alias("shares"), "ratio"))
    # Newest first; on one date the observation comes before the split, which counts for earlier dates only.
    later = Window.partitionBy("entity").orderBy(F.desc(ORDER), F.col("ratio").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    factor = F.coalesce(F.product("ratio").over(later), F.lit(1.0))
    return both.withColumn("factor", factor).filter("ratio IS NULL").select("entity", ORDER, (F.col("shares") * F.col("factor")).alias("shares"))


def clean_shares(shares: DataFrame, splits: DataFrame, aliases: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Raw (symbol, date, shares, seq) rows to split-adjusted (entity, date, shares)."""
    name, place = current_symbol(F.col("symbol"), aliases or {})
    named = shares.select(name.alias("entity"), ORDER, "shares", place.alias("alias_position"), "seq")
    # Two readers: the adjustment itself and the search for the splits' dates.
    return split_adjust(settle(drop_spikes(select_observations(named, splits))), splits)


def current_value(first: Column | str, second: Column | str) -> Column:
    """Current scalar value: the first field that is there, if it is finite and above zero."""
    return positive(F.coalesce(col(first).cast("double"), col(second).cast("double")))


def _last_close(prices: DataFrame, key: str, out: str) -> DataFrame:
    """Positive closes, the last of a date by ``seq`` where the column is there."""
    place = F.col("seq") if "seq" in prices.columns else F.lit(0)
    clean = prices.select(key, ORDER, positive(number("close")).alias(out), place.alias("_place")).filter(F.col(out).isNotNull())
    return clean.groupBy(key, ORDER).agg(F.max_by(out, "_place").alias(out))


def _valued(close: DataFrame, counts: DataFrame) -> DataFrame:
    """Closes times the newest share count on or before their date."""
    nothing = lambda: F.lit(None).cast("double")
    both = close.select("entity", ORDER, "close", nothing().alias("shares")).unionByName(counts.select("entity", ORDER, nothing().alias("close"), "shares"))
    days = both.groupBy("entity", ORDER).agg(F.max("close").alias("close"), F.max("shares").alias("shares"))
    newest = F.last("shares", ignorenulls=True).over(_by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return days.select("entity", ORDER, "close", newest.alias("shares")).filter("close IS NOT NULL").select("entity", ORDER, finite(F.col("close") * F.col("shares")).alias("market_cap"))


def _converted(valued: DataFrame, rates: DataFrame, needs_fx: Column) -> DataFrame:
    """Values times the newest rate of the last rows of the merged dates of values and rates."""
    nothing = lambda: F.lit(None).cast("double")
    own = valued.select("entity", ORDER, "market_cap", nothing().alias("rate"), F.lit(True).alias("own"))
    other = rates.select("entity", ORDER, nothing().alias("market_cap"), "rate", F.lit(False).alias("own"))
    days = own.unionByName(other).groupBy("entity", ORDER).agg(F.max("market_cap").alias("market_cap"), F.max("rate").alias("rate"), F.max("own").alias("own"))
    newest = F.last("rate", ignorenulls=True).over(_by_day().rowsBetween(-MARKET_MAX_AGE_DAYS, Window.currentRow))
    seen = days.select("entity", ORDER, "market_cap", newest.alias("rate"), "own").filter("own")
    return seen.select("entity", ORDER, F.when(needs_fx, F.col("market_cap") * F.col("rate")).otherwise(F.col("market_cap")).alias("market_cap"))


def market_cap(
    listings: DataFrame,
    prices: DataFrame,
    shares: DataFrame,
    splits: DataFrame,
    start,
    end,
    aliases: Mapping[str, Sequence[str]] | None = None,
    fx: DataFrame | None = None,
    fx_pairs: Mapping[str, str] | None = None,
    history_start=HISTORY_START,
) -> DataFrame:
    """Daily (entity, date, market_cap) for every listed entity from ``start`` to ``end``.

    ``listings`` (entity, cap_first, cap_second) names the entities; ``prices`` (entity, date, close), ``shares``
    (symbol, date, shares, seq), ``splits`` (entity, date, ratio), ``fx`` (pair, date, close) with ``fx_pairs`` mapping
    an entity to its pair. NULL before the first share count. An entity without any history gets its current scalar
    on the last date only.
    """
    first = F.greatest(F.lit(start).cast("date"), F.lit(history_start).cast("date"))
    last = F.lit(end).cast("date")
    inside = F.col(ORDER).between(first, last)
    close = _last_close(prices.filter(inside), "entity", "close")
    valued = _valued(close, clean_shares(shares.filter(inside), splits.filter(inside), aliases))

    pairs = fx_pairs or {}
    needs_fx = F.col("entity").isin(list(pairs)) if pairs else F.lit(False)
    rates = None
    if pairs:
        of_pair = F.array(*[F.struct(F.lit(e).alias("entity"), F.lit(p).alias("pair")) for e, p in pairs.items()])
        rates = (
            _last_close(fx.filter(inside), "pair", "rate")
            .select(ORDER, "rate", F.explode(F.filter(of_pair, lambda m: m["pair"] == F.col("pair"))).alias("m"))
            .groupBy(F.col("m.entity").alias("entity"), ORDER)
            .agg(F.max("rate").alias("rate"))
        )
        valued = _converted(valued, rates, needs_fx)
    history = settle(valued.filter("market_cap IS NOT NULL").select("entity", ORDER, "market_cap"))

    scalar = current_value("cap_first", "cap_second")
    lonely = listings.join(history.select("entity").distinct(), "entity", "left_anti").select("entity", scalar.alias("market_cap"))
    if rates is not None:
        recent = rates.filter(F.col(ORDER) >= F.date_sub(last, MARKET_MAX_AGE_DAYS)).groupBy("entity").agg(F.max_by("rate", ORDER).alias("rate"))
        lonely = lonely.join(recent, "entity", "left").select(
            "entity", F.when(needs_fx, F.col("market_cap") * F.col("rate")).otherwise(F.col("market_cap")).alias("market_cap")
        )
    fallback = lonely.filter("market_cap IS NOT NULL").select("entity", last.alias(ORDER), "market_cap")

    days = listings.select("entity", F.explode(F.sequence(F.lit(start).cast("date"), last)).alias(ORDER))
    return days.join(history.unionByName(fallback), ["entity", ORDER], "left").select("entity", ORDER, "market_cap")
