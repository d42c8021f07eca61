"""Readers of landed JSON and CSV files; every schema is explicit."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import col, finite, number
from ..operators.chunks import KEYS, ORDER
from ..operators.prepare import MARKET_MAX_AGE_DAYS, calendar, dedupe, ffill, source_dates
from ..session import settle

SENTIMENT_SCHEMA = "data ARRAY<STRUCT<value: STRING, value_classification: STRING, timestamp: STRING>>"
SNAPSHOT_SCHEMA = "data STRUCT<market_cap_percentage: STRUCT<btc: DOUBLE>, updated_at: BIGINT>"
PAIRS_SCHEMA = "prices ARRAY<ARRAY<DOUBLE>>, total_volumes ARRAY<ARRAY<DOUBLE>>, market_caps ARRAY<ARRAY<DOUBLE>>"
CANDLE_SCHEMA = "dates ARRAY<STRING>, rows ARRAY<ARRAY<DOUBLE>>"
OHLC = ("Open", "High", "Low", "Close")


def read_json(spark: SparkSession, path: str, schema: str, file: str | None = None) -> DataFrame:
    """Landed documents; ``file`` names a column for the path of each one's file."""
    documents = spark.read.schema(schema).option("multiLine", True).json(path)
    return documents if file is None else documents.select("*", F.col("_metadata.file_path").alias(file))


def read_csv(spark: SparkSession, path: str, line: str = "line") -> DataFrame:
    """A landed CSV file or folder: cells stay text, header names lose the blanks around them, and ``line`` orders the rows as they
    stand: by the name of the file, the place of the block in it, and the row in the block."""
    rows = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    names = [c.strip() for c in rows.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"{path}: the header repeats {repeated}")
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row"))
    return rows.select("*", place.alias("_line")).toDF(*names, line)


def read_chunks(spark: SparkSession, paths: Sequence[str], names: Sequence[str], start=None, on: str = "timestamp") -> DataFrame:
    """The base series from landed chunk files, in the order given; a later file overwrites the cells it carries."""
    chunks = [read_csv(spark, p).drop("line") for p in paths]
    for path, df in zip(paths, chunks):
        if on not in df.columns:
            raise ValueError(f"{path}: no column '{on}' among {df.columns}")
    return base_series(chunks, names, start, on)


def parse_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """The same documents when they arrive as a text column."""
    return df.withColumn("_doc", F.from_json(col(column), schema)).select(*[col(c) for c in df.columns], "_doc.*")


def from_seconds(c: Column | str) -> Column:
    return F.timestamp_seconds(col(c).try_cast("double").cast("bigint"))


def from_millis(c: Column | str) -> Column:
    return F.timestamp_millis(col(c).cast("bigint"))


def sentiment(documents: DataFrame, keys: Sequence[str] = (), line: str | None = None) -> DataFrame:
    """``data[]`` records: epoch-seconds text, value numeric or NULL, class. ``line`` names a column for the place in the document."""
    rows = documents.select(*keys, F.posexplode("data").alias("_line", "_record")).select(*keys, "_line", "_record.*")
    return rows.select(
        *keys,
        *([] if line is None else [F.col("_line").alias(line)]),
        from_seconds("timestamp").alias("time"),
        number("value").alias("fear_greed_value"),
        F.col("value_classification").alias("fear_greed_classification"),
    )


def dominance(documents: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One scalar from a nested path with its update time."""
    return documents.select(
        *keys, F.col("data.market_cap_percentage.btc").alias("bitcoin_dominance"), F.timestamp_seconds("data.updated_at").alias("time")
    )


def pairs(documents: DataFrame, column: str, out: str, keys: Sequence[str] = ()) -> DataFrame:
    """``[[epoch ms, value], ...]`` to (time, value) rows."""
    rows = documents.select(*keys, F.explode(col(column)).alias("p"))
    return rows.select(*keys, from_millis(F.col("p")[0]).alias("time"), F.col("p")[1].alias(out))


def on_base_dates(rows: DataFrame, time: str = "time") -> DataFrame:
    """Rows stamped exactly at midnight, keyed by date; other rows never match a daily base row."""
    day = F.to_date(col(time))
    kept = rows.filter(col(time) == day.cast("timestamp"))
    return kept.select(*[day.alias(ORDER) if c == time else col(c) for c in rows.columns])


def assets(documents: DataFrame, keys: Sequence[str] = KEYS, limit: int = MARKET_MAX_AGE_DAYS) -> DataFrame:
    """Price, volume and cap of each asset joined on time, on one daily calendar with a bounded fill and source dates.

    A day shows the newest observation at or before its midnight, at most ``limit`` days after the observation's day;
    the calendar runs from the first to the last day observed by any asset.
    """
    columns = {"prices": "close", "total_volumes": "volume", "market_caps": "market_cap"}
    parts = [pairs(documents, c, out, keys) for c, out in columns.items()]
    joined = settle(reduce(lambda a, b: a.join(b, [*keys, "time"]), parts))
    names = list(columns.values())
    day = F.to_date("time")
    shown = F.when(F.col("time") == day.cast("timestamp"), day).otherwise(F.date_add(day, 1))
    seen = [F.when(col(c).isNotNull(), day).alias(f"{c}_source_date") for c in names]
    rows = dedupe(joined.select(*keys, shown.alias(ORDER), "time", *names, *seen), [*keys, ORDER], "time").drop("time")
    ends = joined.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    days = calendar(rows, ends.select("a").scalar(), ends.select("b").scalar(), keys)
    filled = ffill(days, [*names, *[f"{c}_source_date" for c in names]], limit, keys, dense=True)
    young = lambda c: F.datediff(ORDER, f"{c}_source_date") <= limit
    return filled.select(
        *keys, ORDER, *[F.when(young(c), col(c)).alias(c) for c in names], *[F.when(young(c), col(f"{c}_source_date")).alias(f"{c}_source_date") for c in names]
    )


def daily_observations(series: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS, limit: int = MARKET_MAX_AGE_DAYS, start=None, end=None) -> DataFrame:
    """Observation dates kept, every calendar day present, values and dates carried over at most ``limit`` rows."""
    marked = source_dates(series, columns)
    days = calendar(marked, start, end, keys)
    return ffill(days, [*columns, *[f"{c}_source_date" for c in columns]], limit, keys, dense=True)


def closes(prices: DataFrame, start, end, keys: Sequence[str] = KEYS, limit: int = MARKET_MAX_AGE_DAYS) -> DataFrame:
    """Daily closes per entity over a full calendar; entities without any close are skipped."""
    alive = prices.filter(F.col("close").isNotNull()).select(*keys).distinct()
    used = prices.join(alive, list(keys), "left_semi").select(*keys, ORDER, "close")
    return daily_observations(used, ["close"], keys, limit, start, end)


def candles(documents: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Parallel ``dates[]`` and ``rows[][4]`` to candles; empty or unequal arrays are an error."""
    sizes = F.size("dates"), F.size("rows")
    checked = (
        F.when(F.coalesce(sizes[0], F.lit(0)) <= 0, F.raise_error(F.lit("the document holds no candle")))
        .when(sizes[0] != sizes[1], F.raise_error(F.lit("as many dates as rows are needed")))
        .otherwise(F.arrays_zip("dates", "rows"))
    )
    rows = documents.select(*keys, F.inline(checked))
    return rows.select(
        *keys, F.to_date("dates").alias("Time"), *[F.col("rows")[i].cast("double").alias(c) for i, c in enumerate(OHLC)]
    )


def check_candles(df: DataFrame, label: str = "candles") -> DataFrame:
    """The frame itself if it has at least one complete numeric candle, else an error."""
    missing = [c for c in OHLC if c not in df.columns]
    if missing:
        raise ValueError(f"{label} lack the columns {missing}; nothing is replaced")
    usable = df.select(*[finite(number(c)).alias(c) for c in OHLC]).dropna()
    if usable.limit(1).count() == 0:
        raise ValueError(f"{label} hold no whole numeric row; nothing is replaced")
    return df


def merge_chunks(chunks: Sequence[DataFrame], on: str = "timestamp") -> DataFrame:
    """Wide tables sharing a time column, merged by time; a later table overwrites the cells it carries.

    Cells travel in long form, so one shuffle merges any number of tables.
    """
    long = []
    for i, df in enumerate(chunks):
        names = [c for c in df.columns if c != on]
        cells = df.select(on, *[col(c).cast("string").alias(c) for c in names]).unpivot([on], names, "metric", "cell")
        long.append(cells.withColumn("_part", F.lit(i)))
    names = list(dict.fromkeys(c for df in chunks for c in df.columns if c != on))
    rows = reduce(DataFrame.unionByName, long)
    merged = rows.groupBy(on).agg(
        *[
            F.max_by("cell", F.when(F.col("metric") == name, F.col("_part"))).alias(name)
            for name in names
        ]
    )
    return merged


def require_series(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The frame itself if every requested series is a column, else an error naming the absent ones."""
    absent = sorted(set(names).difference(df.columns))
    if absent:
        raise ValueError("required series are absent: " + ", ".join(absent))
    return df


def base_series(chunks: Sequence[DataFrame], names: Sequence[str], start=None, on: str = "timestamp") -> DataFrame:
    """Merged, contract-checked, numeric base frame from a start date; ``time`` from epoch seconds."""
    merged = require_series(merge_chunks(chunks, on), names)
    out = merged.select(from_seconds(on).alias("time"), *[number(n).alias(n) for n in names])
    return out if start is None else out.filter(F.col("time") >= F.lit(start).cast("timestamp"))
