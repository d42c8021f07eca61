"""The whole report: wide network panels and long asset series to all published tables.

Every table but the price outlook starts with the column ``entity``: the network its row is about. Several networks may be
reported at once; asset series are shared by all of them, and each is compared with its own price.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings
from ..functions.expressions import col
from ..operators import changes, energy, metrics, models, prepare, segments, windows
from ..operators.chunks import KEYS, ORDER
from ..session import in_stages, settle
from ..sources import versions
from . import quality, returns, tables

ASSET = "symbol"


def wide_columns(long: DataFrame, value: str, names: Mapping[str, str]) -> DataFrame:
    """Long (entity, date, value) to one column per listed entity; ``names`` maps entity to column."""
    listed = long.filter(F.col("entity").isin(list(names)))
    return listed.groupBy(ORDER).agg(*[F.max(F.when(F.col("entity") == e, col(value))).alias(n) for e, n in names.items()])


def join_series(base: DataFrame, *series: DataFrame) -> DataFrame:
    """LEFT join date-keyed frames, one row per date, to the rows of every network."""
    return reduce(lambda out, s: out.join(s, ORDER, "left"), series, base)


def network_stage(base: DataFrame, closes: DataFrame, caps: DataFrame, as_of, keys: Sequence[str] = KEYS) -> DataFrame:
    """All derived columns of the wide panel, in the published order of stages; closes and values of the listed assets included.

    The supply is carried forward by the metal parity and stays so for everything after it. Stages that are read by
    several later ones are settled.
    """
    companies = settings.cap_columns()
    joined = join_series(base, wide_columns(closes, "close", settings.close_columns()), wide_columns(caps, "market_cap", companies))
    data = settle(metrics.onchain_metrics(settle(joined), keys))
    averaged = [c for c in settings.MOVING_AVERAGE_COLUMNS if c in data.columns]
    data = metrics.fiat_parity(windows.moving_averages(data, averaged, keys=keys), settings.FIAT_TRILLIONS)
    symbols = {m: f"{s}_close" for m, s in settings.METAL_SYMBOLS.items()}
    data = settle(metrics.cap_breakdown(metrics.metal_caps(settle(data), settings.METAL_OUNCES, symbols, keys), settings.GOLD_SPLIT))
    data = metrics.metal_parity(data, settings.GOLD_SPLIT, keys)
    data = settle(metrics.asset_parity(data, list(companies)))
    data = settle(metrics.stock_to_flow(data, keys))
    return settle(energy.energy(models.network_models(data, as_of, keys)))


def change_columns(data: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, date) and the change columns of the listed ones."""
    known = [c for c in columns if c in data.columns]
    narrow = settle(data.select(*keys, ORDER, *[col(c) for c in known]))
    return changes.all_changes(narrow, known, keys=keys).drop(*known)


def price_panel(data: DataFrame, closes: DataFrame, benchmark: str, symbols: Sequence[str]) -> DataFrame:
    """(entity, symbol, date, price): each network's own price as the benchmark asset, and the listed assets on its dates.

    An asset series is copied once per network; networks are few beside the rows of a series.
    """
    lead = data.select(*KEYS, F.lit(benchmark).alias(ASSET), ORDER, F.col("price_close").alias("price"))
    others = closes.filter(F.col("entity").isin(list(symbols))).select(F.col("entity").alias(ASSET), ORDER, F.col("close").alias("price"))
    dated = data.select(*KEYS, ORDER).join(others, ORDER)
    return lead.unionByName(dated.select(*lead.columns))


def build_report(
    base: DataFrame,
    closes: DataFrame,
    caps: DataFrame,
    weekly: DataFrame,
    daily: DataFrame,
    outlook: DataFrame,
    as_of,
    benchmark: str = "BTC",
    first_indexed_year: int = returns.COMPARISON_FIRST_YEAR,
) -> dict[str, DataFrame]:
    """Published tables by name. To be built and written within ``session.stages``.

    ``base`` is the filled wide panel (entity, date, ...), ``closes`` and ``caps`` are long asset series,
    ``weekly`` and ``daily`` are candles (entity, Time, OHLC) and ``outlook`` is the table of price levels.
    """
    if not in_stages():
        raise RuntimeError("build and write the report within session.stages()")
    prepare.assert_fresh(base, as_of, settings.REQUIRED_BASE_COLUMNS)
    keys = list(KEYS)
    per_asset = [*keys, ASSET]
    assets = settings.performance_assets(benchmark)
    data = network_stage(base, closes, caps, as_of)
    prices = settle(price_panel(data, closes, benchmark, sorted({s for _, _, s in assets} | set(settings.GROWTH_SYMBOLS))))
    snapshot = settle(changes.correlation_snapshot(prices, "price", benchmark, as_of, keys=per_asset))

    report = settle(data.join(change_columns(data, settings.analysis_columns()), [*keys, ORDER], "left"))
    grown = [c for c in (*settings.GROWTH_COLUMNS, *[f"{s}_close" for s in settings.GROWTH_SYMBOLS]) if c in data.columns]
    growth = settle(changes.cagr(data.select(*keys, ORDER, *[col(c) for c in grown]), grown))
    growth_rates = growth.select(*keys, ORDER, *[col(c) for c in growth.columns if c.endswith("_CAGR")])
    shown_growth = [f"{s}_close_{changes.CAGR_YEARS[0]}_Year_CAGR" for s in settings.GROWTH_SYMBOLS]
    shown_growth = ["price_close_4_Year_CAGR", *shown_growth]

    priced = report.select(*keys, ORDER, "price_close")
    performed = tables.performance(prices, assets, as_of, snapshot, price="price", benchmark=benchmark, keys=per_asset)
    stamps = F.unix_timestamp(F.col(ORDER).cast("timestamp")).alias("timestamp")
    master = report.join(growth_rates.select(*keys, ORDER, *[col(c) for c in shown_growth]), [*keys, ORDER], "left")
    return {
        "onchain_raw": base.select(*keys, stamps, *[col(c) for c in base.columns if c not in (*keys, ORDER)]),
        "cagr_data": growth_rates.withColumnRenamed(ORDER, "time"),
        "master_metrics_data": master.withColumnRenamed(ORDER, "time"),
        "1k_bucket_table": tables.price_buckets(priced, 1000, as_of).drop("low", "high"),
        "5k_bucket_table": tables.price_buckets(priced, 5000, as_of).drop("low", "high"),
        "cycle_low_data": segments.cycle_lows(priced),
        "drawdown_data": segments.drawdowns(priced),
        "halving_data": segments.eras(priced),
        "electricity_cost_scenarios": tables.electricity_export(report, as_of),
        "network_model_metrics": tables.network_export(report, as_of),
        "onchain_price_models": tables.price_model_export(report, as_of),
        "eoy_model_data": tables.year_end_table(data, growth, as_of).withColumnRenamed(ORDER, "time"),
        "fundamentals_table": tables.fundamentals(report, settings.FUNDAMENTALS, as_of).orderBy(*keys, "place").drop("place"),
        "monthly_heatmap_data": returns.heatmap(priced, as_of),
        "mtd_return_comparison": returns.period_comparison(priced, as_of, "month"),
        "ytd_return_comparison": returns.period_comparison(priced, as_of, "year"),
        "mtd_returns_history": returns.indexed_history_wide(priced, as_of, "month", min_year=first_indexed_year),
        "ytd_returns_history": returns.indexed_history_wide(priced, as_of, "year", min_year=first_indexed_year),
        "ohlc_data": tables.clean_candles(weekly).orderBy(*keys, "Time"),
        "report_ohlc_summary": tables.candle_summary(daily, as_of),
        "performance_table": tables.combined_performance(performed, keys).drop("place"),
        "price_outlook": outlook,
        "relative_value_comparison": tables.asset_valuation(data, settings.valued_assets(), as_of),
        "roi_table": returns.roi(priced, as_of).orderBy(*keys, "place").drop("place"),
        "summary_history": tables.summary_history(report, as_of),
        "summary_table": tables.summary_table(report, as_of).orderBy(*keys, "place").drop("place", "Number"),
    }


def write_report(published: Mapping[str, DataFrame], folder: str, kind: str = "csv") -> None:
    """One versioned folder per table; the widest one is compressed. A table gets a new version only if that is finished and has rows."""
    for name, df in published.items():
        compression = "gzip" if kind == "csv" and name == "master_metrics_data" else None
        versions.publish(df, f"{folder.rstrip('/')}/{name}", kind=kind, compression=compression)


def current_tables(spark: SparkSession, folder: str, names: Sequence[str] = tuple(quality.RULES)) -> dict[str, versions.Version]:
    found = {name: versions.current(spark, f"{folder.rstrip('/')}/{name}") for name in names}
    return {name: v for name, v in found.items() if v is not None}


def read_report(spark: SparkSession, folder: str, names: Sequence[str] = tuple(quality.RULES)) -> dict[str, DataFrame]:
    """The published tables of a folder; CSV cells stay text, nothing is inferred and nothing is run."""
    return {name: versions.load(spark, v, text=True) for name, v in current_tables(spark, folder, names).items()}


def validate_report(spark: SparkSession, folder: str, as_of, rules: Mapping[str, quality.Rule] = quality.RULES) -> DataFrame:
    """Issues of a published folder, per network. Rows, columns, infinities and cut files of all CSV tables come from one scan."""
    found = current_tables(spark, folder, tuple(rules))
    shown = {name: versions.load(spark, v, text=True) for name, v in found.items()}
    scanned = quality.scan(spark, {t: v for t, v in found.items() if v.kind == "csv"})
    return quality.validate(spark, shown, as_of, rules, KEYS, scanned)
