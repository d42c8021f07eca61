"""Event schedules, cycles, eras and drawdown windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import positive, ratio
from ..functions.text import era_label
from .chunks import KEYS, ORDER, running

# Event dates (the first opens the series), projection step, first step value.
EVENT_DATES = ("2009-01-03", "2012-11-28", "2016-07-09", "2020-05-11", "2024-04-20")
EVENT_STEP_DAYS = 1435
FIRST_STEP_VALUE = 50.0

# Cycle-low boundaries and drawdown windows (label, high date, recovery date).
CYCLE_LOW_DATES = ("2010-07-25", "2011-11-18", "2015-01-15", "2018-12-16", "2022-11-20", "2026-02-06")
DRAWDOWN_WINDOWS = (
    ("Drawdown Cycle 1", "2011-06-08", "2013-02-28"),
    ("Drawdown Cycle 2", "2013-11-29", "2017-03-03"),
    ("Drawdown Cycle 3", "2017-12-17", "2020-12-16"),
    ("Drawdown Cycle 4", "2021-11-10", "2024-03-04"),
    ("Drawdown Cycle 5", "2025-10-06", None),
)


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def event_position(date: Column, dates: Sequence[str] = EVENT_DATES, step_days: int = EVENT_STEP_DAYS) -> Column:
    """Position of the newest event on or before a date; known dates first, then one every ``step_days``. NULL before all."""
    known = sum((F.when(date >= _day(d), 1).otherwise(0) for d in dates), F.lit(0))
    later = F.floor(F.datediff(date, _day(dates[-1])) / F.lit(step_days)).cast("int")
    return F.when(known == 0, F.lit(None)).otherwise(known - 1 + F.greatest(later, F.lit(0)))


def event_start(position: Column, dates: Sequence[str] = EVENT_DATES, step_days: int = EVENT_STEP_DAYS) -> Column:
    """Date of the event at a position."""
    newest = len(dates) - 1
    known = F.element_at(F.array(*[_day(d) for d in dates]), F.least(position, F.lit(newest)) + 1)
    return F.date_add(known, (F.greatest(position - newest, F.lit(0)) * step_days).cast("int"))


def schedule(panel: DataFrame, dates: Sequence[str] = EVENT_DATES, step_days: int = EVENT_STEP_DAYS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Event dates per entity, projected until past its newest row."""
    newest = panel.groupBy(*keys).agg(F.max(ORDER).alias("through"))
    last = F.greatest(F.coalesce(event_position(F.col("through"), dates, step_days), F.lit(0)) + 1, F.lit(len(dates) - 1))
    rows = newest.select(*keys, F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("position"))
    return rows.withColumn("event_date", event_start(F.col("position"), dates, step_days))


def step_value(date: Column, dates: Sequence[str] = EVENT_DATES, step_days: int = EVENT_STEP_DAYS, first: float = FIRST_STEP_VALUE) -> Column:
    """A value that halves at every event; dates before the first event get the first value."""
    return F.lit(first) / F.pow(F.lit(2.0), F.coalesce(event_position(date, dates, step_days), F.lit(0)))


def in_windows(panel: DataFrame, windows: Sequence[tuple[str, str, str | None]], closed: bool, label: str) -> DataFrame:
    """Put rows into labelled date windows: [start, end) or, when ``closed``, [start, end]; no end means open.

    The windows are literals in the plan, so no join is needed; overlapping windows repeat a row.
    """
    table = F.array(
        *[
            F.struct(F.lit(name).alias("label"), _day(a).alias("start"), (_day(b) if b else F.lit(None).cast("date")).alias("end"))
            for name, a, b in windows
        ]
    )
    date = F.col(ORDER)
    before_end = (lambda w: date <= w["end"]) if closed else (lambda w: date < w["end"])
    inside = F.filter(table, lambda w: (date >= w["start"]) & (w["end"].isNull() | before_end(w)))
    rows = panel.select("*", F.explode(inside).alias("_w"))
    return rows.select(*[F.col(f"`{c}`") for c in panel.columns], F.col("_w.label").alias(label), F.col("_w.start").alias("window_start"))


def periods(boundaries: Sequence[str], label) -> list[tuple[str, str, str | None]]:
    """Ascending boundary dates to half-open labelled windows; the last one stays open."""
    return [(label(i), a, boundaries[i + 1] if i + 1 < len(boundaries) else None) for i, a in enumerate(boundaries)]


def drawdowns(panel: DataFrame, price: str = "price_close", windows=DRAWDOWN_WINDOWS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Percent below the running high since each window opened."""
    rows = in_windows(panel.select(*keys, ORDER, F.col(price).alias("_price")), windows, True, "Cycle")
    highs = running(rows, {"_high": ("max", "_price")}, [*keys, "Cycle"])
    return highs.select(
        *keys,
        F.datediff(ORDER, "window_start").alias("days_since_ath"),
        ((ratio("_price", "_high") - 1.0) * 100.0).alias("drawdown_pct"),
        "Cycle",
    )


def cycle_lows(panel: DataFrame, price: str = "price_close", boundaries: Sequence[str] = CYCLE_LOW_DATES, keys: Sequence[str] = KEYS) -> DataFrame:
    """Each cycle indexed to its lowest positive price; rows before the first date of that low are dropped."""
    windows = periods(boundaries, lambda i: f"Market Cycle {i + 1}")
    rows = in_windows(panel.select(*keys, ORDER, F.col(price).alias("_price")), windows, False, "Cycle")
    at_low = F.struct(positive("_price").alias("low"), F.col(ORDER).alias("low_date"))
    lows = rows.filter(positive("_price").isNotNull()).groupBy(*keys, "Cycle").agg(F.min(at_low).alias("l"))
    joined = rows.join(lows, [*keys, "Cycle"]).filter(F.col(ORDER) >= F.col("l.low_date"))
    return joined.select(
        *keys,
        F.datediff(ORDER, "l.low_date").alias("days_since_cycle_low"),
        ratio("_price", F.col("l.low")).alias("index_value"),
        "Cycle",
    )


def eras(panel: DataFrame, price: str = "price_close", dates: Sequence[str] = EVENT_DATES, step_days: int = EVENT_STEP_DAYS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Each era indexed to the price on its opening date; an era without a positive price there is left out."""
    rows = panel.select(*keys, ORDER, F.col(price).alias("_price"), event_position(F.col(ORDER), dates, step_days).alias("_era"))
    rows = rows.filter("_era IS NOT NULL").withColumn("_start", event_start(F.col("_era"), dates, step_days))
    opening = F.max(F.when(F.col(ORDER) == F.col("_start"), positive("_price"))).alias("_open")
    opens = rows.groupBy(*keys, "_era").agg(opening).filter("_open IS NOT NULL")
    joined = rows.join(opens, [*keys, "_era"])
    return joined.select(
        *keys,
        F.datediff(ORDER, "_start").alias("days_since_halving"),
        ratio("_price", "_open").alias("index_value"),
        era_label(F.col("_era")).alias("Era"),
    )
