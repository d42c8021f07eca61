"""Period-return reports: indexed month/year paths, heatmap, comparisons and horizon returns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import anniversary, col, common_day_of_year, pct_change, positive, ratio
from ..operators.chunks import KEYS, ORDER
from ..operators.prepare import as_of as as_of_row
from ..operators.prepare import present
from ..session import settle

# Horizons of the return table, first years, month names.
HORIZONS = (
    ("1 day", "day", 1),
    ("3 day", "day", 3),
    ("7 day", "day", 7),
    ("30 day", "day", 30),
    ("90 day", "day", 90),
    ("1 Year", "year", 1),
    ("2 Year", "year", 2),
    ("4 Year", "year", 4),
    ("5 Year", "year", 5),
    ("10 Year", "year", 10),
)
COMPARISON_FIRST_YEAR = 2014
HEATMAP_FIRST_YEAR = 2012
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
YEARLY = 13


def as_date(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value)[:10])


def _prices(panel: DataFrame, price: str, cut: dt.date, keys: Sequence[str]) -> DataFrame:
    """Positive prices up to the as-of date under one name."""
    rows = panel.filter(F.col(ORDER) <= F.lit(cut)).select(*keys, ORDER, positive(price).alias("price"))
    return rows.filter("price IS NOT NULL")


def _same_period(period: str, cut: dt.date) -> Column:
    """Rows of the report month in any year, or all rows for a year report."""
    return F.month(ORDER) == cut.month if period == "month" else F.lit(True)


def period_table(prices: DataFrame, period: str, keys: Sequence[str] = KEYS, **extra: Column) -> DataFrame:
    """One row per (entity, period): last price, last date, and the last positive price before the period (``base``).

    The prices are read once; only this small table is ordered, and it is settled for its several readers.
    """
    rows = prices.groupBy(*keys, F.trunc(F.col(ORDER), period).alias("period")).agg(
        F.max_by("price", ORDER).alias("close"), F.max(ORDER).alias("last_date"), *[c.alias(n) for n, c in extra.items()]
    )
    earlier = Window.partitionBy(*keys).orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    return settle(rows.withColumn("base", F.last("close", ignorenulls=True).over(earlier)))


def indexed_history(panel: DataFrame, as_of, period: str, price: str = "price_close", min_year: int = COMPARISON_FIRST_YEAR, keys: Sequence[str] = KEYS) -> DataFrame:
    """(entity, position, year, value): each year's path from its period base, rebased to the current period's base.

    Position 0 is the base; then the day of month, or the day of a 365-day year (February 29 left out). Nothing is
    returned for an entity without rows or base in the current period.
    """
    cut = as_date(as_of)
    prices = _prices(panel, price, cut, keys)
    position = F.dayofmonth(ORDER) if period == "month" else common_day_of_year(ORDER)
    shown = period_table(prices, period, keys, days=F.count(position)).filter("base IS NOT NULL AND days > 0")
    starting = F.trunc(F.lit(cut).cast("date"), period)
    now = shown.filter(F.col("period") == starting).select(*keys, F.col("base").alias("current_base"))
    alike = (F.month("period") == F.month(starting)) & (F.year("period") >= min_year)
    years = shown.filter(alike).join(now, list(keys)).select(*keys, "period", F.year("period").alias("year"), "base", "current_base")
    rows = prices.filter(_same_period(period, cut)).select(
        *keys, F.trunc(F.col(ORDER), period).alias("period"), position.alias("position"), "price"
    )
    indexed = rows.filter("position IS NOT NULL").join(years, [*keys, "period"]).select(
        *keys, "position", "year", (ratio("price", "base") * F.col("current_base")).alias("value")
    )
    return indexed.unionByName(years.select(*keys, F.lit(0).alias("position"), "year", F.col("current_base").alias("value")))


def history_aggregates(history: DataFrame, current_year: int, hidden_years: Sequence[int] = (), last_position: int | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Median and Average per position over earlier years, optionally without hidden years or late positions."""
    shown = F.col("year") < current_year
    if hidden_years:
        shown &= ~F.col("year").isin(list(hidden_years))
    rows = history if last_position is None else history.filter(F.col("position") <= last_position)
    value = F.when(shown, F.col("value"))
    return rows.groupBy(*keys, "position").agg(F.median(value).alias("Median"), F.avg(value).alias("Average"))


def indexed_history_wide(panel: DataFrame, as_of, period: str, price: str = "price_close", min_year: int = COMPARISON_FIRST_YEAR, keys: Sequence[str] = KEYS) -> DataFrame:
    """One column per year that has a path, plus Median and Average of the earlier years.

    Which years these are is read off the data first (one number per year comes back).
    """
    cut = as_date(as_of)
    history = settle(indexed_history(panel, cut, period, price, min_year, keys))
    shown = sorted(r["year"] for r in history.select("year").distinct().collect())
    years = [F.max(F.when(F.col("year") == y, F.col("value"))).alias(str(y)) for y in shown]
    earlier = F.when(F.col("year") < cut.year, F.col("value"))
    name = "day" if period == "month" else "day_of_year"
    wide = history.groupBy(*keys, F.col("position").alias(name)).agg(
        *years, F.median(earlier).alias("Median"), F.avg(earlier).alias("Average")
    )
    return wide.orderBy(*keys, name)


def latest_points(history: DataFrame, aggregates: DataFrame, current_year: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """End-of-line labels: the newest point of the current year, and the last Median and Average."""
    current = history.filter((F.col("year") == current_year) & F.col("value").isNotNull()).groupBy(*keys).agg(
        F.max(F.struct("position", "value")).alias("p")
    )
    ends = aggregates.filter("Median IS NOT NULL OR Average IS NOT NULL").groupBy(*keys).agg(
        F.max(F.struct("position", "Median", "Average")).alias("p")
    )
    point = lambda name, x, y: F.struct(F.lit(name).alias("series"), x.alias("x"), y.alias("y"))
    rows = current.select(*keys, F.inline(F.array(point("current", F.col("p.position"), F.col("p.value"))))).unionByName(
        ends.select(
            *keys,
            F.inline(
                F.array(
                    point("median", F.col("p.position"), F.col("p.Median")),
                    point("average", F.col("p.position"), F.col("p.Average")),
                )
            ),
        )
    )
    return rows.withColumn("label", F.concat(F.lit("$"), F.format_number(F.round("y"), 0)))


def roi(panel: DataFrame, as_of, price: str = "price_close", horizons=HORIZONS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Return over each horizon from the newest row at or before (newest row - horizon)."""
    cut = as_date(as_of)
    rows = panel.filter(F.col(ORDER) <= F.lit(cut)).select(*keys, ORDER, col(price).alias("price"))
    newest = as_of_row(rows, cut, keys).withColumnsRenamed({ORDER: "newest", "price": "now"})
    target = lambda unit, n: F.date_sub("newest", n) if unit == "day" else anniversary("newest", n)
    found = rows.join(newest, list(keys)).groupBy(*keys, "newest", "now").agg(
        *[
            F.max_by(F.struct(ORDER, "price"), F.when(F.col(ORDER) <= target(unit, n), F.col(ORDER))).alias(f"h{i}")
            for i, (_, unit, n) in enumerate(horizons)
        ]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("place"),
                F.lit(name).alias("Time Frame"),
                F.coalesce(F.col(f"h{i}.{ORDER}"), target(unit, n)).alias("Start Date"),
                F.col(f"h{i}.price").alias("BTC Price"),
            )
            for i, (name, unit, n) in enumerate(horizons)
        ]
    )
    listed = found.select(*keys, "now", F.inline(entries))
    out = listed.select(*keys, "place", "Time Frame", pct_change("now", "BTC Price").alias("ROI (%)"), "Start Date", "BTC Price")
    return present(out, rows, f"no row on or before {cut}")


def period_cells(panel: DataFrame, as_of, price: str = "price_close", first_year: int = HEATMAP_FIRST_YEAR, keys: Sequence[str] = KEYS) -> DataFrame:
    """(entity, year, cell, fraction, finished): month cells 1..12 and the yearly cell 13 against the last positive value before.

    A cell is unfinished when it is the newest month and that month is not over, or the newest year's yearly cell.
    """
    cut = as_date(as_of)
    months = period_table(_prices(panel, price, cut, keys), "month", keys)
    years = months.groupBy(*keys, F.trunc("period", "year").alias("period")).agg(
        F.max_by("close", "period").alias("close"), F.min_by("base", "period").alias("base"), F.max("last_date").alias("last_date")
    )
    newest = months.groupBy(*keys).agg(F.max("last_date").alias("newest"))
    cells = months.select(*keys, "period", F.month("period").alias("cell"), "close", "base").unionByName(
        years.select(*keys, "period", F.lit(YEARLY).alias("cell"), "close", "base")
    )
    open_month = (F.col("cell") != YEARLY) & (F.col("newest") != F.last_day("newest")) & (F.month("period") == F.month("newest"))
    unfinished = (F.year("period") == F.year("newest")) & ((F.col("cell") == YEARLY) | open_month)
    shown = cells.filter((F.year("period") >= first_year) & F.col("base").isNotNull()).join(newest, list(keys))
    return shown.select(
        *keys, F.year("period").alias("year"), "cell", (ratio("close", "base") - 1.0).alias("fraction"), (~unfinished).alias("finished")
    )


def heatmap(panel: DataFrame, as_of, price: str = "price_close", first_year: int = HEATMAP_FIRST_YEAR, keys: Sequence[str] = KEYS) -> DataFrame:
    """Months by years in percentage points with "4-Year Average", "Median" and "Average" rows.

    The statistics leave out an unfinished current month, and always the current year's yearly cell.
    """
    cells = period_cells(panel, as_of, price, first_year, keys)
    counted = cells.filter("finished")
    recent = Window.partitionBy(*keys, "cell").orderBy(F.desc("year"))  # one row per year
    ranked = counted.withColumn("age", F.row_number().over(recent))
    stats = ranked.groupBy(*keys, "cell").agg(
        F.avg(F.when(F.col("age") <= 4, F.col("fraction"))).alias("four"),
        F.median("fraction").alias("median"),
        F.avg("fraction").alias("mean"),
    )
    row = lambda place, name, value: F.struct(F.lit(place).alias("place"), F.lit(name).alias("time"), value.alias("fraction"))
    summary = stats.select(
        *keys,
        "cell",
        F.inline(
            F.array(
                row(10_000, "4-Year Average", F.col("four")),
                row(10_001, "Median", F.col("median")),
                row(10_002, "Average", F.col("mean")),
            )
        ),
    )
    years = cells.select(*keys, "cell", F.col("year").alias("place"), F.col("year").cast("string").alias("time"), "fraction")
    names = [*MONTHS, "Yearly"]
    wide = years.unionByName(summary).groupBy(*keys, "place", "time").agg(
        *[F.max(F.when(F.col("cell") == i, F.col("fraction"))).alias(n) for i, n in enumerate(names, start=1)]
    )
    return wide.select(*keys, "time", *[(F.col(n) * 100).alias(n) for n in names]).orderBy(*keys, wide["place"])


def period_comparison(panel: DataFrame, as_of, period: str, price: str = "price_close", first_year: int = COMPARISON_FIRST_YEAR, keys: Sequence[str] = KEYS) -> DataFrame:
    """Current period against the median of the same period in earlier years: full period, and up to the same date.

    Two rows per entity, the year and "Median Projection"; none without rows or base in the current period.
    """
    cut = as_date(as_of)
    prices = _prices(panel, price, cut, keys)
    same_day = F.dayofmonth(ORDER) == cut.day
    if period == "year":
        same_day &= F.month(ORDER) == cut.month
    table = period_table(prices, period, keys, same=F.max(F.when(same_day, F.col("price"))))
    alike = F.month("period") == cut.month if period == "month" else F.lit(True)
    years = table.filter(alike & F.col("base").isNotNull()).select(
        *keys,
        F.year("period").alias("year"),
        F.col("base").alias("start"),
        F.col("close").alias("end"),
        pct_change("close", "base").alias("full"),
        pct_change("same", "base").alias("to_date"),
    )
    now, earlier = F.col("year") == cut.year, (F.col("year") < cut.year) & (F.col("year") >= first_year)
    summary = years.groupBy(*keys).agg(
        *[F.max(F.when(now, F.col(c))).alias(c) for c in ("start", "end", "full", "to_date")],
        F.median(F.when(earlier, F.col("full"))).alias("median_full"),
        F.median(F.when(earlier, F.col("to_date"))).alias("median_to_date"),
    )
    row = lambda name, start, end, full, to_date: F.struct(
        F.lit(name).alias("Year"),
        start.alias("Start Price ($)"),
        end.alias("End Price ($)"),
        full.alias("Return (%)"),
        to_date.alias("Report Date Return (%)"),
    )
    c = F.col
    projected = c("start") * (1 + c("median_full") / 100)
    return summary.filter("start IS NOT NULL").select(
        *keys,
        F.inline(
            F.array(
                row(str(cut.year), c("start"), c("end"), c("full"), c("to_date")),
                row("Median Projection", c("start"), projected, c("median_full"), c("median_to_date")),
            )
        ),
    )
