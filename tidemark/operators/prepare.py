"""Series preparation: calendars, daily values, bounded fills, as-of joins and freshness checks."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import anniversary, col, number, positive
from .chunks import KEYS, ORDER, Chunked, running

MARKET_MAX_AGE_DAYS = 5
MONTHLY_WARNING_DAYS = 62
BASE_MAX_AGE_DAYS = 1


# --- keys and daily values ------------------------------------------------------------------------------------------


def dedupe(df: DataFrame, keys: Sequence[str], order: Column | str, keep: str = "last") -> DataFrame:
    """One row per key, the first or last by ``order``; equal orders are settled by the other columns, left to right.

    Rows fold map-side, so a key with many copies stays cheap.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if keep == "last" else F.min_by
    row = F.struct(*[col(c) for c in rest])
    picked = pick(row, F.struct(col(order).alias("_order"), *[col(c) for c in rest])).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*[col(k) for k in keys], *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def daily(df: DataFrame, ts: str, columns: Sequence[str], keep: str = "last", keys: Sequence[str] = KEYS, ties: Sequence[str] = ()) -> DataFrame:
    """One row per entity and day: the first or last non-NULL value of each column.

    Rows of the same time are ordered by ``ties``, then by the value itself.
    """
    pick = F.max_by if keep == "last" else F.min_by
    order = lambda c: F.struct(col(ts).alias("_ts"), *[col(t).alias(f"_tie_{t}") for t in ties], col(c).alias("_value"))
    values = [pick(col(c), F.when(col(c).isNotNull(), order(c))).alias(c) for c in columns]
    return df.groupBy(*keys, F.to_date(col(ts)).alias(ORDER)).agg(*values)


def positive_daily(df: DataFrame, ts: str, column: str, keys: Sequence[str] = KEYS, ties: Sequence[str] = ()) -> DataFrame:
    """Numeric values above zero, the last one of each day."""
    clean = df.select(*keys, ts, *ties, positive(number(column)).alias(column)).filter(col(column).isNotNull())
    return daily(clean, ts, [column], "last", keys, ties)


def local_dates(df: DataFrame, wall_time: str, column: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Series on exchange-local calendar dates: the first ten characters of the wall time, numeric, no NULLs."""
    day = F.to_date(F.substring(col(wall_time).cast("string"), 1, 10))
    out = df.select(*keys, day.alias(ORDER), number(column).alias(column))
    return out.filter(col(column).isNotNull())


def bounds(panel: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return panel.groupBy(*keys).agg(F.min(ORDER).alias("first_date"), F.max(ORDER).alias("last_date"))


def calendar(panel: DataFrame, start=None, end=None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Every day from start to end per entity; missing days are NULL rows.

    The ends are dates or date columns (a scalar subquery); by default each entity's own first and last date.
    """
    ends = bounds(panel, keys)
    first = F.col("first_date") if start is None else F.lit(start).cast("date")
    last = F.col("last_date") if end is None else F.lit(end).cast("date")
    days = ends.filter(first <= last).select(*keys, F.explode(F.sequence(first, last)).alias(ORDER))
    return days.join(panel, [*keys, ORDER], "left").select(*[col(c) for c in panel.columns])


def only_dates_of(df: DataFrame, days: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows whose (entity, date) is in ``days``."""
    return df.join(days.select(*keys, ORDER), [*keys, ORDER], "left_semi")


def align(base: DataFrame, *others: DataFrame, order: str | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """LEFT join every source to the base dates; the first source that has a column name keeps it.

    A frame that has the column ``order`` may repeat a key: its first row by that column counts, and the column goes.
    A frame without it must have one row per key.
    """
    def first(df: DataFrame) -> DataFrame:
        return dedupe(df, [*keys, ORDER], order, "first").drop(order) if order in df.columns else df

    out = first(base)
    for other in others:
        fresh = [c for c in other.columns if c not in out.columns or c == order]
        out = out.join(first(other.select(*keys, ORDER, *[col(c) for c in fresh])), [*keys, ORDER], "left")
    return out


# --- fills ----------------------------------------------------------------------------------------------------------


def source_dates(panel: DataFrame, columns: Sequence[str], suffix: str = "_source_date") -> DataFrame:
    """Remember the observation date of every value before any fill."""
    marks = {f"{c}{suffix}": F.when(col(c).isNotNull(), F.col(ORDER)) for c in columns}
    return panel.withColumns(marks)


def market_columns(panel: DataFrame, base: Collection[str], carried: Collection[str] = (), suffix: str = "_source_date", keys: Sequence[str] = KEYS) -> list[str]:
    """Columns under the short fill budget: not a base series, not a carried monthly one, not a source-date marker."""
    fixed = {*keys, ORDER, *base, *carried}
    return [c for c in panel.columns if c not in fixed and not c.endswith(suffix)]


def ffill(panel: DataFrame, columns: Sequence[str], limit: int | None = None, keys: Sequence[str] = KEYS, dense: bool = False) -> DataFrame:
    """Carry the last value forward, over at most ``limit`` NULL rows in a row when a limit is given."""
    if limit is None:
        filled = running(panel, {f"_f_{c}": ("last", c) for c in columns}, keys)
        return filled.select(*[F.col(f"`_f_{c}`").alias(c) if c in columns else col(c) for c in panel.columns])
    if limit < 0:
        raise ValueError("a fill limit cannot be negative")
    chunks = Chunked(panel, reach=limit, keys=keys, dense=dense)
    frame = chunks.window.rowsBetween(-limit, 0)
    out = chunks.frame.withColumns({c: F.last(col(c), ignorenulls=True).over(frame) for c in columns})
    return chunks.owned(out)


def fill_by_age(
    panel: DataFrame,
    columns: Sequence[str],
    max_age_days: int = MARKET_MAX_AGE_DAYS,
    suffix: str = "_source_date",
    keys: Sequence[str] = KEYS,
    dense: bool = False,
) -> DataFrame:
    """Fill at most ``max_age_days`` rows, and only while the true observation is no older than that many days.

    Columns with a source-date marker are judged by the marker, so an already repeated value cannot pass for a new
    observation; the markers are dropped afterwards.
    """
    marks = [f"{c}{suffix}" for c in columns if f"{c}{suffix}" in panel.columns]
    filled = ffill(panel, [*columns, *marks], max_age_days, keys, dense)
    kept = []
    for c in filled.columns:
        mark = f"{c}{suffix}"
        if c in marks:
            continue
        if mark in marks:
            age = F.datediff(F.col(ORDER), col(mark))
            kept.append(F.when(age.between(0, max_age_days), col(c)).alias(c))
        else:
            kept.append(col(c))
    return filled.select(*kept)


def carry_observation(
    panel: DataFrame, value: str, source_date: str, source_url: str, max_age_days: int | None = None, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Carry a monthly value with its provenance; an optional hard age cap clears all three columns together."""
    if max_age_days is None:
        return ffill(panel, [value, source_date, source_url], None, keys)
    filled = ffill(panel, [value, source_date, source_url], max_age_days, keys)
    young = F.datediff(F.col(ORDER), col(source_date)).between(0, max_age_days)
    return filled.withColumns({c: F.when(young, col(c)) for c in (value, source_date, source_url)})


def monthly_series(df: DataFrame, time: str, value: str, alternate: str, factor: float, url: str, order: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Monthly observations to daily rows: alternate unit scaled, invalid rows dropped, last row of a time wins.

    ``order`` names the column that decides which row of a time is the last one (the line of a landed file, say).
    """
    _require(df, [time, order], "monthly observations")
    if value not in df.columns:
        _require(df, [alternate], f"monthly observations without '{value}'")
    given = number(value) if value in df.columns else number(alternate) / F.lit(factor)
    rows = df.select(
        *keys, F.to_date(F.try_to_timestamp(col(time).cast("string"))).alias(ORDER), given.alias(value), col(order).alias("_order")
    ).filter(F.col(ORDER).isNotNull() & col(value).isNotNull())
    last = dedupe(rows, [*keys, ORDER], "_order").drop("_order")
    marked = last.withColumns({f"{value}_source_date": F.col(ORDER), f"{value}_source_url": F.lit(url)})
    return ffill(calendar(marked, keys=keys), [value, f"{value}_source_date", f"{value}_source_url"], None, keys)


def _require(df: DataFrame, columns: Sequence[str], what: str) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{what}: no column {', '.join(repr(c) for c in absent)} among {df.columns}")


def spread_latest(snapshot: DataFrame, base: DataFrame, value: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Put the latest scalar on the last base date and the day before, with its own observation date."""
    newest = snapshot.groupBy(*keys).agg(F.max_by(F.struct(col(value), F.col(ORDER).alias("seen")), F.col(ORDER)).alias("s"))
    ends = base.groupBy(*keys).agg(F.max(ORDER).alias("last_date"))
    days = F.explode(F.array(F.date_sub("last_date", 1), F.col("last_date"))).alias(ORDER)
    return ends.join(newest, list(keys)).select(
        *keys, days, F.col(f"s.`{value}`").alias(value), F.col("s.seen").alias(f"{value}_source_date")
    )


# --- as-of lookups --------------------------------------------------------------------------------------------------


def present(result: DataFrame, source: DataFrame, complaint: str) -> DataFrame:
    """``result``; running it fails with ``complaint`` if ``source``, from which it was made, has no row.

    Nothing runs before that. The check is a branch beside the result, so it holds when the result itself is found to be empty.
    """
    some = source.select(F.lit(1).alias("one")).limit(1).agg(F.count("one").alias("n"))
    guard = some.filter(F.when(F.col("n") == 0, F.raise_error(F.lit(complaint)).cast("boolean")).otherwise(F.lit(False)))
    return result.unionByName(guard.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in result.schema]))


def as_of(panel: DataFrame, date, keys: Sequence[str] = KEYS, required: bool = False) -> DataFrame:
    """The newest row on or before ``date`` per entity (a row, not a non-NULL value).

    ``required``: a panel without any such row is an error when the plan runs.
    """
    rest = [c for c in panel.columns if c not in keys]
    newest = F.max_by(F.struct(*[col(c) for c in rest]), F.col(ORDER)).alias("_row")
    rows = panel.filter(F.col(ORDER) <= F.lit(date).cast("date"))
    out = rows.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])
    return present(out, rows, f"no row on or before {date}") if required else out


def asof_join(
    left: DataFrame,
    right: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = KEYS,
    forward: bool = False,
    strict: bool = False,
) -> DataFrame:
    """For each left row the newest right row on or before its date (``forward``: the oldest on or after).

    ``strict`` leaves equal dates out. Both sides become one ordered stream of rows scanned in chunks, so neither a
    cross product nor a whole entity in one task is needed. (entity, date) must be unique on the right.
    """
    sign = -1 if forward else 1
    at = (F.unix_date(F.col(ORDER)) * sign).cast("bigint")
    found = F.struct(*[col(c) for c in columns])
    nothing = F.lit(None).cast(right.select(found.alias("f")).schema["f"].dataType)
    payload = F.struct(*[col(c) for c in left.columns])
    empty = F.lit(None).cast(left.select(payload.alias("p")).schema["p"].dataType)
    lefts = left.select(*keys, at.alias("_at"), F.lit(1).alias("_side"), payload.alias("_left"), nothing.alias("_right"))
    rights = right.select(*keys, at.alias("_at"), F.lit(2 if strict else 0).alias("_side"), empty.alias("_left"), found.alias("_right"))
    scanned = running(lefts.unionByName(rights), {"_found": ("last", "_right")}, keys, "_at", ["_side"])
    return scanned.filter(F.col("_side") == 1).select(
        *[F.col(f"_left.`{c}`").alias(c) for c in left.columns], *[F.col(f"_found.`{c}`").alias(c) for c in columns]
    )


def asof_join_rows(left: DataFrame, right: DataFrame, column: str, limit: int, keys: Sequence[str] = KEYS, order: str | None = None) -> DataFrame:
    """Backward as-of where a value reaches at most ``limit`` rows of the merged dates of both sides.

    Where the right side repeats a date, ``order`` names the column whose last row counts; without it a repeated date is an error
    when the plan runs.
    """
    if order is not None:
        right = dedupe(right.select(*keys, ORDER, column, order), [*keys, ORDER], order)
    dates = left.select(*keys, ORDER, F.lit(True).alias("_own"), F.lit(None).cast(right.schema[column].dataType).alias(column))
    merged = (
        dates.unionByName(right.select(*keys, ORDER, F.lit(None).cast("boolean").alias("_own"), col(column)))
        .groupBy(*keys, ORDER)
        .agg(F.bool_or("_own").alias("_own"), F.max(column).alias(column), F.count_if(F.col("_own").isNull()).alias("_n"))
    )
    if order is None:
        twice = F.raise_error(F.lit(f"a date of '{column}' is repeated; name the column that orders its rows")).cast("boolean")
        merged = merged.withColumn("_own", F.when(F.col("_n") > 1, twice).otherwise(F.col("_own")))
    merged = merged.drop("_n")
    filled = ffill(merged, [column], limit, keys).filter(F.col("_own")).drop("_own")
    return left.join(filled, [*keys, ORDER], "left")


PERIODS = {"month": "month", "year": "year"}


def last_positive_before(panel: DataFrame, columns: Sequence[str], period: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per (entity, period present): the last positive value strictly before the period, per column.

    The panel shrinks to one row per period first; only that small table is ordered.
    """
    if period not in PERIODS:
        raise ValueError("period must be 'month' or 'year'")
    start = F.trunc(F.col(ORDER), PERIODS[period]).alias("period")
    closes = panel.groupBy(*keys, start).agg(
        *[F.max_by(col(c), F.when(positive(c).isNotNull(), F.col(ORDER))).alias(c) for c in columns]
    )
    earlier = Window.partitionBy(*keys).orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    return closes.select(*keys, "period", *[F.last(col(c), ignorenulls=True).over(earlier).alias(c) for c in columns])


def calendar_lag(panel: DataFrame, columns: Sequence[str], years: int = 0, days: int = 0, suffix: str = "_prior", keys: Sequence[str] = KEYS) -> DataFrame:
    """Join the row dated exactly ``years``/``days`` earlier; no such row gives NULL."""
    back = F.date_sub(anniversary(ORDER, years), days) if years else F.date_sub(F.col(ORDER), days)
    prior = panel.select(*keys, F.col(ORDER).alias("_back"), *[col(c).alias(f"{c}{suffix}") for c in columns])
    return panel.withColumn("_back", back).join(prior, [*keys, "_back"], "left").drop("_back")


# --- freshness ------------------------------------------------------------------------------------------------------


def stale(panel: DataFrame, columns: Sequence[str], as_of_date, max_age_days: int = MARKET_MAX_AGE_DAYS, suffix: str = "_source_date", keys: Sequence[str] = KEYS) -> DataFrame:
    """Series whose last proven observation is missing, in the future or too old. Run it before ``fill_by_age``."""
    if max_age_days < 0:
        raise ValueError("max_age_days cannot be negative")
    cut = F.lit(as_of_date).cast("date")
    seen = []
    for c in columns:
        mark = col(f"{c}{suffix}") if f"{c}{suffix}" in panel.columns else F.when(col(c).isNotNull(), F.col(ORDER))
        seen += [
            F.count(col(c)).alias(f"_n_{c}"),
            F.max_by(mark, F.when(mark.isNotNull(), F.col(ORDER))).alias(f"_at_{c}"),
        ]
    facts = panel.filter(F.col(ORDER) <= cut).groupBy(*keys).agg(*seen)
    rows = facts.select(
        *keys,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("metric"), col(f"_n_{c}").alias("values"), col(f"_at_{c}").alias("source_date"))
                    for c in columns
                ]
            )
        ),
    )
    age = F.datediff(cut, F.col("source_date"))
    problem = (
        F.when(F.col("values") == 0, "missing")
        .when(F.col("source_date").isNull(), "source date missing")
        .when((age < 0) | (age > max_age_days), "stale")
    )
    return rows.select(*keys, "metric", "source_date", age.alias("age_days"), problem.alias("problem")).filter("problem IS NOT NULL")


def monthly_issues(panel: DataFrame, value: str, source_date: str, source_url: str, as_of_date, max_age_days: int = MONTHLY_WARNING_DAYS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Provenance checks of a carried monthly series: errors, and a warning when the observation is old."""
    if max_age_days < 0:
        raise ValueError("max_age_days cannot be negative")
    absent = [c for c in (value, source_date, source_url) if c not in panel.columns]
    if absent:
        raise ValueError(f"provenance columns are missing: {absent}")
    cut = F.lit(as_of_date).cast("date")
    observed = F.when(col(value).isNotNull(), F.col(ORDER))
    facts = panel.groupBy(*keys).agg(
        F.max(F.when(F.col(ORDER) <= cut, F.col(ORDER))).alias("as_of"),
        F.max_by(
            F.struct(col(source_date).alias("seen"), col(source_url).alias("url")), F.when(F.col(ORDER) <= cut, observed)
        ).alias("last"),
        F.max_by(col(value).isNotNull(), F.when(F.col(ORDER) <= cut, F.col(ORDER))).alias("carried"),
    )
    age = F.datediff(cut, F.col("last.seen"))
    url = F.trim(F.coalesce(F.col("last.url"), F.lit("")))
    rule = (
        F.when(F.col("as_of").isNull(), "no rows")
        .when(F.col("last").isNull(), "no observation")
        .when(F.col("last.seen").isNull(), "source date missing")
        .when(url == "", "source url missing")
        .when(age < 0, "source date in the future")
        .when(~F.col("carried"), "not carried to the newest row")
        .when(age > max_age_days, "old")
    )
    severity = F.when(rule == "old", "warning").otherwise("error")
    return facts.select(*keys, rule.alias("rule"), F.when(rule.isNotNull(), severity).alias("severity"), age.alias("age_days")).filter("rule IS NOT NULL")


def freshness(panel: DataFrame, as_of_date, required: Sequence[str], max_age_days: int = BASE_MAX_AGE_DAYS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Problems of the newest base row: no row, too old, absent columns, NULL in a required metric."""
    present = [c for c in required if c in panel.columns]
    absent = [c for c in required if c not in panel.columns]
    cut = F.lit(as_of_date).cast("date")
    newest = F.max_by(F.struct(*[col(c).isNull().alias(c) for c in present], F.lit(0).alias("_")), F.when(F.col(ORDER) <= cut, F.col(ORDER)))
    facts = panel.groupBy(*keys).agg(F.max(F.when(F.col(ORDER) <= cut, F.col(ORDER))).alias("newest"), newest.alias("nulls"))
    checks = [
        F.struct(F.lit("rows").alias("metric"), F.when(F.col("newest").isNull(), "no rows").alias("problem")),
        F.struct(F.lit("rows").alias("metric"), F.when(F.datediff(cut, "newest") > max_age_days, "stale").alias("problem")),
        *[F.struct(F.lit(c).alias("metric"), F.when(F.col(f"nulls.`{c}`"), "null").alias("problem")) for c in present],
        *[F.struct(F.lit(c).alias("metric"), F.lit("absent").alias("problem")) for c in absent],
    ]
    return facts.select(*keys, "newest", F.inline(F.array(*checks))).filter("problem IS NOT NULL")


def assert_fresh(panel: DataFrame, as_of_date, required: Sequence[str], max_age_days: int = BASE_MAX_AGE_DAYS, keys: Sequence[str] = KEYS) -> None:
    """Raise when any base series is unusable on the as-of date; a panel without rows is unusable too."""
    found = freshness(panel, as_of_date, required, max_age_days, keys)
    # One line per metric and kind of problem, whatever the number of entities, and one if there is no row at all: a single job.
    entity = F.concat_ws("/", *[col(k).cast("string") for k in keys])
    problems = found.groupBy("metric", "problem").agg(F.count(F.lit(1)).alias("entities"), F.min(entity).alias("first"))
    empty = panel.agg(F.count(F.lit(1)).alias("entities")).filter("entities = 0").select(F.lit(None).cast("string").alias("metric"), F.lit("empty").alias("problem"), "entities", F.lit(None).cast("string").alias("first"))
    problems = sorted(problems.unionByName(empty).collect(), key=lambda r: (r.metric or "", r.problem))
    if any(r.metric is None for r in problems):
        raise ValueError(f"no data on or before {as_of_date}")
    if problems:
        raise ValueError(f"base data unusable on {as_of_date}: {[r.asDict() for r in problems]}")
