"""Period changes in percentage points, growth rates and statistics since a start date."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import anniversary, col, finite, growth_rate, pct_change, positive, ratio
from ..session import settle
from .chunks import KEYS, ORDER, RUN_PER_REACH, SMALLEST_RUN, Chunked
from .prepare import last_positive_before

CHANGE_ROWS = (7, 90)
CAGR_YEARS = (4, 2)
ROWS_PER_YEAR = 365


def pct_change_rows(panel: DataFrame, columns: Sequence[str], periods: Sequence[int] = CHANGE_ROWS, keys: Sequence[str] = KEYS, dense: bool = False) -> DataFrame:
    """``{column}_{n}_change`` against the value n ROWS earlier."""
    chunks = Chunked(panel, max(periods), keys=keys, dense=dense)
    out = chunks.frame.withColumns({f"{c}_{n}_change": pct_change(c, chunks.lag(c, n)) for n in periods for c in columns})
    return chunks.owned(out)


def _add_since_period_start(out: DataFrame, panel: DataFrame, columns: Sequence[str], period: str, label: str, keys: Sequence[str]) -> DataFrame:
    base = last_positive_before(panel, columns, period, keys).select(
        *keys, "period", *[col(c).alias(f"_base_{c}") for c in columns]
    )
    joined = out.withColumn("period", F.trunc(F.col(ORDER), period)).join(base, [*keys, "period"], "left")
    return joined.select(
        *[col(c) for c in out.columns], *[pct_change(c, f"_base_{c}").alias(f"{c}_{label}_change") for c in columns]
    )


def _add_since_a_year_ago(out: DataFrame, panel: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    prior = panel.select(*keys, F.col(ORDER).alias("_then"), *[col(c).alias(f"_then_{c}") for c in columns])
    joined = out.withColumn("_then", anniversary(ORDER)).join(prior, [*keys, "_then"], "left")
    return joined.select(
        *[col(c) for c in out.columns], *[pct_change(c, f"_then_{c}").alias(f"{c}_YOY_change") for c in columns]
    )


def mtd(panel: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Change against the last positive value before the month began."""
    return _add_since_period_start(panel, panel, columns, "month", "MTD", keys)


def ytd(panel: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Change against the last positive value before the year began."""
    return _add_since_period_start(panel, panel, columns, "year", "YTD", keys)


def yoy(panel: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Change against the same calendar date one year earlier."""
    return _add_since_a_year_ago(panel, panel, columns, keys)


def _changes_job(columns: Sequence[tuple[str, ...]], periods: Sequence[int], row: str, then: str, month: str, year: str, day: str):
    """Arrow job for one run of rows: every change of every column, in ``row`` order.

    ``columns`` are (value, its last positive value before the year, the names of the changes). Days are whole numbers.
    The closure holds plain values only, so it travels by value and workers need not have this package.
    """
    wanted, periods = [tuple(c) for c in columns], list(periods)

    def compute(table: pa.Table) -> pa.Table:
        table = table.sort_by(row)
        whole = lambda name: table.column(name).to_numpy()
        dates, months, years = whole(day), whole(month), whole(year)
        n = len(dates)
        place = np.arange(n)
        same = np.searchsorted(dates, whole(then))
        same = np.where((same < n) & (dates[np.minimum(same, n - 1)] == whole(then)), same, -1)
        before_month = np.searchsorted(dates, months) - 1

        def at(x, index):
            return np.where(index >= 0, x[np.maximum(index, 0)], np.nan)

        def change(x, base):
            return np.where(base == 0, np.nan, x / base - 1.0) * 100.0

        added = {}
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            for value, carried, *names in wanted:
                x = table.column(value).to_pandas().to_numpy(dtype=float)
                base = table.column(carried).to_pandas().to_numpy(dtype=float)
                newest = np.maximum.accumulate(np.where((x > 0) & (x < np.inf), place, -1))
                inside = at(newest, before_month).astype(int) if n else before_month
                inside = np.where((before_month >= 0) & (inside >= 0) & (dates[np.maximum(inside, 0)] >= years), inside, -1)
                bases = [at(x, place - k) for k in periods] + [base, np.where(inside >= 0, at(x, inside), base), at(x, same)]
                for name, b in zip(names, bases):
                    added[name] = change(x, b)
        for name, values in added.items():
            table = table.append_column(name, pa.array(values, from_pandas=True, type=pa.float64()))
        return table

    return compute


def all_changes(panel: DataFrame, columns: Sequence[str], periods: Sequence[int] = CHANGE_ROWS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Row-lag, MTD, YTD and YOY changes of a column list, in one ordered Arrow pass.

    The panel shrinks to one row per (keys, year) for the row numbers and for the last positive value before each year; that small
    table goes back to the rows once. Then runs of rows travel with the rows before them that a change can need: the longest
    period, or the days of a year, since (keys, date) is unique. Within a run the row a period earlier, the same day
    last year and the last positive value before the month are positions. ``keys`` and date must not be NULL.
    """
    reach = max([*periods, 366])
    size = max(RUN_PER_REACH * reach, SMALLEST_RUN)
    year = F.trunc(F.col(ORDER), "year")
    dated = panel.withColumn("_year", year)
    by_year = dated.groupBy(*keys, "_year").agg(
        F.count(F.lit(1)).alias("_n"), *[F.max_by(col(c), F.when(positive(c).isNotNull(), F.col(ORDER))).alias(f"_p{i}") for i, c in enumerate(columns)]
    )
    earlier = Window.partitionBy(*keys).orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    carried = by_year.select(
        *keys,
        "_year",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        *[F.last(f"_p{i}", ignorenulls=True).over(earlier).cast("double").alias(f"_b{i}") for i, _ in enumerate(columns)],
    )
    inside = Window.partitionBy(*keys, "_year").orderBy(ORDER)
    numbered = dated.withColumn("_row", F.row_number().over(inside)).join(carried, [*keys, "_year"])
    names = {c: [f"{c}_{k}_change" for k in periods] + [f"{c}_{label}_change" for label in ("YTD", "MTD", "YOY")] for c in columns}
    rows = numbered.select(
        *[col(c) for c in panel.columns],
        *[col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)],
        *[f"_b{i}" for i, _ in enumerate(columns)],
        (F.col("_before") + F.col("_row")).alias("_row"),
        F.unix_date("_year").alias("_year"),
        F.unix_date(F.trunc(F.col(ORDER), "month")).alias("_month"),
        F.unix_date(anniversary(ORDER)).alias("_then"),
        F.unix_date(F.col(ORDER).cast("date")).alias("_day"),
    )
    rows = rows.selectExpr("*", f"_row div {size} AS _home", f"explode(sequence(_row div {size}, (_row + {reach}) div {size})) AS _chunk")
    # Grouped Arrow jobs resolve plain column names only, so the columns travel under numbers.
    given = {name: f"c{i}" for i, name in enumerate(rows.columns)}
    made = {name: f"r{i}" for i, name in enumerate(n for c in columns for n in names[c])}
    plain = rows.toDF(*given.values())
    schema = T.StructType([*plain.schema.fields, *[T.StructField(r, T.DoubleType()) for r in made.values()]])
    job = _changes_job(
        [(given[f"_x{i}"], given[f"_b{i}"], *[made[n] for n in names[c]]) for i, c in enumerate(columns)], periods, *[given[n] for n in ("_row", "_then", "_month", "_year", "_day")]
    )
    out = plain.groupBy(*[given[k] for k in (*keys, "_chunk")]).applyInArrow(job, schema).toDF(*given, *made)
    ordered = [n for k in range(len(periods)) for n in (names[c][k] for c in columns)] + [names[c][len(periods) + j] for j in range(3) for c in columns]
    return out.filter("_home = _chunk").select(*[col(c) for c in panel.columns], *[col(n) for n in ordered])


def changes_at(panel: DataFrame, column: str, day: DataFrame, periods: Sequence[int] = CHANGE_ROWS, keys: Sequence[str] = KEYS, since_days: int = 365) -> DataFrame:
    """The changes of each entity on one day, its value then, and the highest and lowest of the days before: one row per entity.

    ``day`` has one row per group (the keys before the last one) with the date ``_day``; without a group it has one row. Everything
    but the row lags is a map-side aggregate, and for those only the newest rows of an entity are ordered; no change is
    computed for any other day. An entity without a row on the day has NULL but for its range.
    """
    *group, _ = keys
    rows = panel.select(*keys, ORDER, col(column).cast("double").alias("_x"))
    rows = rows.join(day, list(group)) if group else rows.withColumn("_day", day.select("_day").scalar())
    rows = rows.filter(F.col(ORDER) <= F.col("_day"))
    x, good = F.col("_x"), positive("_x").isNotNull()
    last_before = lambda start: F.max_by(x, F.when(good & (F.col(ORDER) < start), F.col(ORDER)))
    recent = F.col(ORDER) >= F.date_sub("_day", since_days)
    facts = rows.groupBy(*keys).agg(
        F.max(F.when(F.col(ORDER) == F.col("_day"), F.struct(x))).alias("_now"),
        last_before(F.trunc("_day", "year")).alias("_ytd"),
        last_before(F.trunc("_day", "month")).alias("_mtd"),
        F.max(F.when(F.col(ORDER) == anniversary("_day"), x)).alias("_yoy"),
        F.max(F.when(recent, x)).alias("high"),
        F.min(F.when(recent, x)).alias("low"),
    )
    newest = Window.partitionBy(*keys).orderBy(F.desc(ORDER))
    lagged = rows.select(*keys, "_x", F.row_number().over(newest).alias("_k")).filter(F.col("_k") <= max(periods) + 1)
    lags = lagged.groupBy(*keys).agg(*[F.max(F.when(F.col("_k") == k + 1, x)).alias(f"_lag{k}") for k in periods])
    there, now = F.col("_now").isNotNull(), F.col("_now._x")
    changed = lambda base: F.when(there, pct_change(now, F.col(base)))
    return facts.join(lags, list(keys)).select(
        *keys,
        now.alias(column),
        *[changed(f"_lag{k}").alias(f"{column}_{k}_change") for k in periods],
        changed("_ytd").alias(f"{column}_YTD_change"),
        changed("_mtd").alias(f"{column}_MTD_change"),
        changed("_yoy").alias(f"{column}_YOY_change"),
        "high",
        "low",
    )


def cagr(panel: DataFrame, columns: Sequence[str], years: Sequence[int] = CAGR_YEARS, keys: Sequence[str] = KEYS, dense: bool = False) -> DataFrame:
    """Rolling compound annual growth over ``365 * years`` rows."""
    chunks = Chunked(panel, max(years) * ROWS_PER_YEAR, keys=keys, dense=dense)
    rates = {
        f"{c}_{y}_Year_CAGR": growth_rate(c, chunks.lag(c, y * ROWS_PER_YEAR), y) for y in years for c in columns
    }
    return chunks.owned(chunks.frame.withColumns(rates))


VALUES_PER_BAND = 4096
SKETCH_POINTS = 1000


def _band_edges(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, metric, edges): ascending cut points of the distinct values, about one per ``VALUES_PER_BAND`` of them.

    The points are approximate quantiles of the data itself, so narrow ranges are cut as finely as wide ones.
    """
    shares = F.array(*[F.lit(i / SKETCH_POINTS) for i in range(1, SKETCH_POINTS)])
    sketched = counts.groupBy(*keys, "_metric").agg(F.percentile_approx("_v", shares, 10 * SKETCH_POINTS).alias("_points"), F.count(F.lit(1)).alias("_distinct"))
    step = F.greatest(F.lit(1), F.ceil(F.lit(float(SKETCH_POINTS * VALUES_PER_BAND)) / F.col("_distinct")).cast("int"))
    every = F.transform(F.sequence(step, F.lit(SKETCH_POINTS - 1), step), lambda i: F.element_at("_points", i))
    edges = F.when(step < SKETCH_POINTS, F.array_distinct(every)).otherwise(F.array().cast("array<double>"))
    return sketched.select(*keys, "_metric", edges.alias("_edges"))


def _value_ranks(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, metric, value) -> rows, and average rank of ties / count, for all metrics of a long table in one pass.

    Values are counted first and ordered inside bands of the values between data-driven cut points; band totals give the
    rank offset, so no more than a band's distinct values are sorted in one task.
    """
    counts = long.groupBy(*keys, "_metric", "_v").agg(F.count(F.lit(1)).alias("_n"))
    # A band is the number of cut points at or below the value; the points of a metric are few.
    band = F.size(F.filter("_edges", lambda e: e <= F.col("_v")))
    banded = counts.join(_band_edges(counts, keys), [*keys, "_metric"]).select(*keys, "_metric", "_v", "_n", band.alias("_band"))
    by = [*keys, "_metric"]
    before = Window.partitionBy(*by).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    bands = (
        banded.groupBy(*by, "_band")
        .agg(F.sum("_n").alias("_band_n"))
        .select(*by, "_band", F.coalesce(F.sum("_band_n").over(before), F.lit(0)).alias("_below"), F.sum("_band_n").over(whole).alias("_all"))
    )
    inside = Window.partitionBy(*by, "_band").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    smaller = F.col("_below") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    share = (smaller + (F.col("_n") + 1) / F.lit(2.0)) / F.col("_all")
    return banded.join(bands, [*by, "_band"]).select(*by, "_v", "_n", share.alias("_share"))


#: A value that holds more than this share of all rows is looked up from a broadcast table, of which there are then fewer than this many.
HEAVY_SHARE = 4096


def ranked_values(long: DataFrame, keys: Sequence[str] = KEYS, heavy_share: int = HEAVY_SHARE) -> tuple[DataFrame, DataFrame]:
    """The rows of a long table (keys, date, _metric, _v) with the ``_share`` of their value, in two parts: rows of heavy values, and the rest.

    A value that many rows repeat, such as the zeros of a column, would be one key of the join. The few heavy ones are
    broadcast and meet their rows where these are; only the rest is shuffled, no value of which has more than a
    1 / ``heavy_share`` part of the rows.
    """
    by = [*keys, "_metric", "_v"]
    values = settle(_value_ranks(long, keys))
    most = values.agg(F.sum("_n").alias("total")).select(F.col("total") / heavy_share).scalar()
    heavy = values.filter(F.col("_n") > most).select(*by, F.col("_share").alias("_heavy"))
    tagged = long.join(F.broadcast(heavy), by, "left")  # fewer than ``heavy_share`` rows
    light = tagged.filter(F.col("_heavy").isNull()).drop("_heavy").join(values.drop("_n"), by)
    return tagged.filter(F.col("_heavy").isNotNull()).withColumnRenamed("_heavy", "_share"), light


def percentile_rank(panel: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """``{column}_percentile``: average rank of ties over the non-NULL count; NULL stays NULL.

    All columns travel as one long table (keys, date, metric, value) and come back as one row per date: the number of
    shuffles does not depend on the number of columns. (keys, date) must be unique. The table is read several times; settle a
    costly panel before.
    """
    named = {f"m{i}": c for i, c in enumerate(columns)}
    narrow = panel.select(*keys, ORDER, *[col(c).cast("double").alias(m) for m, c in named.items()])
    long = narrow.unpivot([*keys, ORDER], list(named), "_metric", "_v").filter(F.col("_v").isNotNull())
    heavy, light = ranked_values(long, keys)
    ranked = heavy.select(*keys, ORDER, "_metric", "_share").unionByName(light.select(*keys, ORDER, "_metric", "_share"))
    shares = ranked.groupBy(*keys, ORDER).agg(*[F.max(F.when(F.col("_metric") == m, F.col("_share"))).alias(f"{c}_percentile") for m, c in named.items()])
    return panel.join(shares, [*keys, ORDER], "left").select(*[col(c) for c in panel.columns], *[col(f"{c}_percentile") for c in columns])


def zscore(panel: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """``{column}_zscore`` with the sample standard deviation of the rows given."""
    stats = panel.groupBy(*keys).agg(
        *[F.avg(col(c)).alias(f"_m_{c}") for c in columns], *[F.stddev_samp(col(c)).alias(f"_s_{c}") for c in columns]
    )
    joined = panel.join(stats, list(keys), "left")
    return joined.select(
        *[col(c) for c in panel.columns],
        *[finite(ratio(col(c) - col(f"_m_{c}"), f"_s_{c}")).alias(f"{c}_zscore") for c in columns],
    )


def statistics(panel: DataFrame, start, columns: Sequence[str] | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Percentile rank and z-score of the numeric columns over the rows from ``start`` on."""
    numeric = columns or [f.name for f in panel.schema if isinstance(f.dataType, T.NumericType) and f.name not in keys]
    recent = panel.filter(F.col(ORDER) >= F.lit(start).cast("date"))
    return zscore(percentile_rank(recent, numeric, keys), numeric, keys)


def analyse(panel: DataFrame, columns: Sequence[str], start=None, periods: Sequence[int] = CHANGE_ROWS, include_statistics: bool = False, keys: Sequence[str] = KEYS) -> DataFrame:
    """All changes, and on request percentile and z-score from ``start`` (NULL before it)."""
    out = all_changes(panel, columns, periods, keys)
    if not include_statistics:
        return out
    stats = statistics(panel.select(*keys, ORDER, *[col(c) for c in columns]), start, columns, keys)
    return out.join(stats.drop(*columns), [*keys, ORDER], "left")


def correlation_snapshot(panel: DataFrame, column: str, benchmark: str, as_of_date, windows: Sequence[int] = (7, 30, 90, 365), keys: Sequence[str] = KEYS) -> DataFrame:
    """Correlation of returns with the benchmark over its last n rows up to the as-of date, one row per entity.

    The last key is the entity's; keys before it tell reports apart, each with a benchmark of its own.

    Rows without a benchmark value are left out first. Only the last ``max(windows) + 1`` benchmark dates matter; that
    many rows are broadcast, and each entity contributes at most that many rows.
    """
    *group, entity = keys
    depth = max(windows) + 1
    # Without any row up to the as-of date the snapshot would sit on the first row, where no return exists: NULL.
    leading = panel.filter((col(entity) == F.lit(benchmark)) & col(column).isNotNull() & (F.col(ORDER) <= F.lit(as_of_date).cast("date")))
    newest_first = Window.partitionBy(*group).orderBy(F.desc(ORDER)) if group else Window.orderBy(F.desc(ORDER))
    if group:
        recent = leading.select(*group, ORDER, col(column).alias("_bench"), F.row_number().over(newest_first).alias("_k")).filter(F.col("_k") <= depth)
    else:
        recent = leading.select(ORDER, col(column).alias("_bench")).orderBy(F.desc(ORDER)).limit(depth)  # so the window below is that small
    dates = recent.select(
        *group,
        ORDER,
        F.row_number().over(newest_first).alias("_back"),
        (ratio("_bench", F.lead("_bench").over(newest_first)) - 1.0).alias("_b"),
    )
    near = dates if group else F.broadcast(dates)  # ``depth`` rows
    rows = panel.select(*keys, ORDER, col(column).alias("_x")).join(near, [*group, ORDER])
    per_entity = Window.partitionBy(*keys).orderBy("_back")  # at most ``depth`` rows per entity
    previous = F.when(F.lead("_back").over(per_entity) == F.col("_back") + 1, F.lead("_x").over(per_entity))
    pairs = rows.select(*keys, "_back", "_b", (ratio("_x", previous) - 1.0).alias("_r"))
    both = F.col("_r").isNotNull() & F.col("_b").isNotNull()
    out = []
    for n in windows:
        inside = both & (F.col("_back") <= n)
        r, b = F.when(inside, F.col("_r")), F.when(inside, F.col("_b"))
        value = F.try_divide(F.covar_samp(r, b), F.stddev_samp(r) * F.stddev_samp(b))
        out.append(F.when(F.count(r) == n, value).alias(f"corr_{n}"))
    entities = panel.select(*keys).distinct()
    return entities.join(pairs.groupBy(*keys).agg(*out), list(keys), "left")
