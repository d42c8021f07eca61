"""From landed observations to the filled base panel that the report reads.

The order is fixed: join to the base calendar, report what is stale, fill market columns within their age, carry the monthly
series, then insist that the base series themselves are fresh. Base series are never filled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings
from ..functions.expressions import col
from ..operators import prepare, shares
from ..operators.chunks import KEYS, ORDER
from ..session import settle
from ..sources import landed
from . import report

MONTHLY = "cm_efficiency_j_gh"
MONTHLY_ALTERNATE = "efficiency_j_th"
MONTHLY_FACTOR = 1000.0


class Prepared(NamedTuple):
    """The filled panel, and what was stale or unproven before it was filled."""

    panel: DataFrame
    stale: DataFrame
    monthly: DataFrame


def network_panel(series: DataFrame, network: str = "BTC", time: str = "time") -> DataFrame:
    """Base series (time, ...) as a panel of one network; rows without a time are dropped, the last of a day by time counts."""
    rows = series.filter(col(time).isNotNull()).select(F.lit(network).alias("entity"), F.to_date(col(time)).alias(ORDER), *[col(c) for c in series.columns])
    return prepare.dedupe(rows, ["entity", ORDER], time).drop(time)


def assemble(
    base: DataFrame,
    daily: Sequence[DataFrame] = (),
    snapshot: DataFrame | None = None,
    snapshot_value: str = "bitcoin_dominance",
    monthly: DataFrame | None = None,
    monthly_url: str = "",
    monthly_order: str = "line",
    order: str | None = None,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """LEFT join all sources to the base dates.

    ``daily`` frames are (keys, date, ...) with their source dates where they have them; the scalar ``snapshot`` goes to the
    two last base dates; ``monthly`` is the landed sheet. ``order`` decides between rows of a repeated date.
    """
    sources = list(daily)
    if snapshot is not None:
        sources.append(prepare.spread_latest(snapshot, base, snapshot_value, keys))
    if monthly is not None:
        sources.append(prepare.monthly_series(monthly, "time", MONTHLY, MONTHLY_ALTERNATE, MONTHLY_FACTOR, monthly_url, monthly_order, keys))
    return prepare.align(base, *sources, order=order, keys=keys)


def prepared(joined: DataFrame, as_of, base_columns: Sequence[str], required: Sequence[str], keys: Sequence[str] = KEYS) -> Prepared:
    """Warn, fill, insist: the stale market series and monthly issues as tables, and the filled panel of a fresh base.

    The joined panel is settled, since the check of the base, the stale report and the fills all read it. Base series are not
    filled, so the check reads them there.
    """
    joined = settle(joined)
    fresh = set(required) <= {*base_columns}
    if fresh:
        prepare.assert_fresh(joined, as_of, required, keys=keys)
    proof = [f"{MONTHLY}_source_date", f"{MONTHLY}_source_url"]
    carried = [c for c in (MONTHLY, *proof) if c in joined.columns]
    market = prepare.market_columns(joined, base_columns, carried, keys=keys)
    stale = prepare.stale(joined, market, as_of, keys=keys)
    filled = prepare.fill_by_age(joined, market, keys=keys)
    if len(carried) == 3:
        filled = prepare.carry_observation(filled, MONTHLY, *proof, keys=keys)
        monthly = prepare.monthly_issues(filled, MONTHLY, *proof, as_of, keys=keys)
    else:
        monthly = prepare.stale(joined, [], as_of, keys=keys).select(*keys, F.lit("absent").alias("rule"), F.lit("error").alias("severity"), F.lit(None).cast("int").alias("age_days"))
    if not fresh:
        prepare.assert_fresh(filled, as_of, required, keys=keys)
    return Prepared(filled, stale, monthly)


class Landed(NamedTuple):
    """Where the landed files of one day are; ``None`` for a source that did not arrive."""

    chunks: Sequence[str]
    closes: str
    listings: str
    share_counts: str
    splits: str
    weekly: str
    daily: str
    sentiment: str | None = None
    snapshot: str | None = None
    monthly: str | None = None
    fx: str | None = None


CLOSES = "entity STRING, date DATE, close DOUBLE"


def _typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A landed CSV file under a fixed schema, by column name."""
    wanted = spark.createDataFrame([], schema).schema
    rows = landed.read_csv(spark, path)
    absent = [f.name for f in wanted if f.name not in rows.columns]
    if absent:
        raise ValueError(f"{path}: no column {absent} among {rows.columns}")
    return rows.select(*[col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted], col("line"))


def sentiment(spark: SparkSession, path: str) -> DataFrame:
    """The landed sentiment index by base date; of a repeated date the first record counts, in the order of files and records."""
    records = landed.sentiment(landed.read_json(spark, path, landed.SENTIMENT_SCHEMA, "file"), ["file"], "line")
    placed = landed.on_base_dates(records).withColumn("line", F.struct("file", "line")).drop("file")
    return prepare.dedupe(placed, [ORDER], "line", "first").drop("line")


def _candles(spark: SparkSession, path: str, network: str) -> DataFrame:
    rows = landed.candles(landed.read_json(spark, path, landed.CANDLE_SCHEMA))
    return landed.check_candles(rows).select(F.lit(network).alias("entity"), *rows.columns)


def report_from_files(
    spark: SparkSession,
    files: Landed,
    names: Sequence[str],
    outlook: DataFrame,
    as_of,
    start: str,
    network: str = "BTC",
    aliases: Mapping[str, Sequence[str]] = settings.SHARE_ALIASES,
    fx_pairs: Mapping[str, str] = settings.CAP_FX_PAIRS,
    **options,
) -> tuple[dict[str, DataFrame], Prepared]:
    """All published tables from landed files, and the warnings of the preparation."""
    base = network_panel(landed.read_chunks(spark, files.chunks, names, start), network)
    daily = []
    if files.sentiment:
        daily.append(sentiment(spark, files.sentiment).select(F.lit(network).alias("entity"), "*"))
    snapshot = None
    if files.snapshot:
        one = landed.dominance(landed.read_json(spark, files.snapshot, landed.SNAPSHOT_SCHEMA))
        snapshot = one.select(F.lit(network).alias("entity"), F.to_date("time").alias(ORDER), "bitcoin_dominance")
    monthly = landed.read_csv(spark, files.monthly).withColumn("entity", F.lit(network)) if files.monthly else None
    joined = assemble(base, daily, snapshot, monthly=monthly, monthly_url=files.monthly or "")
    ready = prepared(joined, as_of, list(names), settings.REQUIRED_BASE_COLUMNS)

    raw = _typed(spark, files.closes, CLOSES)
    closes = prepare.dedupe(raw, ["entity", ORDER], "line").drop("line")
    filled = landed.closes(closes, start, as_of)
    fresh = F.datediff(F.col(ORDER), F.col("close_source_date")) <= prepare.MARKET_MAX_AGE_DAYS
    filled = filled.select("entity", ORDER, F.when(fresh, F.col("close")).alias("close"))
    caps = shares.market_cap(
        _typed(spark, files.listings, "entity STRING, cap_first DOUBLE, cap_second DOUBLE").drop("line"),
        closes.withColumn("seq", F.lit(0)),
        _typed(spark, files.share_counts, "symbol STRING, date DATE, shares DOUBLE").withColumnRenamed("line", "seq"),
        _typed(spark, files.splits, "entity STRING, date DATE, ratio DOUBLE").drop("line"),
        start,
        as_of,
        aliases,
        _typed(spark, files.fx, "pair STRING, date DATE, close DOUBLE").withColumnRenamed("line", "seq") if files.fx else None,
        fx_pairs if files.fx else None,
    )
    caps = prepare.ffill(caps, ["market_cap"], prepare.MARKET_MAX_AGE_DAYS, dense=True)
    tables = report.build_report(
        ready.panel, filled, caps, _candles(spark, files.weekly, network), _candles(spark, files.daily, network), outlook, as_of, **options
    )
    return tables, ready
