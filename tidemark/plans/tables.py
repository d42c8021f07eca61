"""Snapshot and export tables as of one date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sql
from ..functions.expressions import col, finite, number, pct_change, positive, ratio
from ..functions.text import formatted, sentiment_class, thousands_range, valuation_class
from ..operators.changes import changes_at
from ..operators.chunks import KEYS, ORDER
from ..operators.energy import TARIFFS, cents
from ..operators.metrics import UNITS_PER_COIN
from ..operators.prepare import as_of as as_of_row
from ..operators.prepare import daily, present

# Published column names.
NETWORK_COLUMNS = {
    "price_close": "BTC Price",
    "market_cap": "Bitcoin Market Cap",
    "supply": "Bitcoin Supply",
    "addr_count": "Non-Zero Address Count",
    "addrs_over_100k_sats_addr_count": "Addresses Holding 0.001+ BTC",
    "addrs_over_1m_sats_addr_count": "Addresses Holding 0.01+ BTC",
    "addrs_over_10m_sats_addr_count": "Addresses Holding 0.1+ BTC",
    "metcalfe_value": "Metcalfe Value (Any Balance)",
    "metcalfe_value_0p001_btc": "Metcalfe Value (0.001+ BTC)",
    "metcalfe_value_0p01_btc": "Metcalfe Value (0.01+ BTC)",
    "metcalfe_value_0p1_btc": "Metcalfe Value (0.1+ BTC)",
    "metcalfe_scale_any_balance": "Metcalfe Scale (Any Balance)",
    "metcalfe_scale_0p001_btc": "Metcalfe Scale (0.001+ BTC)",
    "metcalfe_scale_0p01_btc": "Metcalfe Scale (0.01+ BTC)",
    "metcalfe_scale_0p1_btc": "Metcalfe Scale (0.1+ BTC)",
    "metcalfe_price_multiple": "BTC Price / Metcalfe Value",
    "power_law_price": "Power Law Price",
    "power_law_price_multiple": "BTC Price / Power Law Price",
    "days_since_genesis": "Days Since Genesis",
    "power_law_exponent": "Power Law Exponent",
    "power_law_scale": "Power Law Scale",
    "hash_rate": "Hash Rate (H/s)",
    "30_day_ma_hash_rate": "Hash Rate 30-Day MA (H/s)",
    "60_day_ma_hash_rate": "Hash Rate 60-Day MA (H/s)",
    "hash_ribbon_ratio": "Hash Ribbon 30D / 60D",
    "hash_ribbon_capitulation": "Hash Ribbon Capitulation",
}
ELECTRICITY_COLUMNS = {
    "price_close": "BTC Price",
    "cm_efficiency_j_gh": "Fleet Efficiency (J/GH)",
    "network_power_watts": "Network Power Draw (W)",
    "daily_electricity_consumption_kwh": "Daily Electricity Consumption (kWh)",
    "subsidy_sum_24h": "Subsidy (BTC)",
    "fees_sum_24h": "Fees (BTC)",
    "miner_revenue_btc": "Miner Revenue (BTC)",
    **{f"Electricity_Cost_{cents(t)}c": f"Power Expense (${t:.2f}/kWh)" for t in TARIFFS},
    "power_only_breakeven_tariff_usd_per_kwh": "Power-Only Break-Even Tariff ($/kWh)",
    "Electricity_Cost_PUE_Subsidy_Only": "Legacy PUE/Subsidy-Only Cost",
    "Bitcoin_Production_Cost": "Bitcoin Production Cost",
    "Hayes_Network_Price_Per_BTC": "Hayes Network Price",
    "Energy_Value": "Energy Value",
}
PRICE_MODEL_COLUMNS = {
    "price_close": "BTC Price",
    "Electricity_Cost": "Electricity Cost",
    "metcalfe_value": "Metcalfe Value",
    "power_law_price": "Power Law Price",
    "sth_realized_price": "STH Realized Price",
    "lth_realized_price": "LTH Realized Price",
    "realized_price": "Realized Price",
}
YEAR_END_COLUMNS = (
    "price_close",
    "realized_price",
    "thermocap_price",
    "200_day_ma_price_close",
    "Lagged_Energy_Value",
    "mvrv_ratio",
    "thermocap_multiple",
    "200_day_multiple",
    "Energy_Value_Multiple",
)
YEAR_END_GROWTH = tuple(f"{c}_4_Year_CAGR" for c in YEAR_END_COLUMNS[:5])
SUMMARY_METRICS = {
    "Bitcoin Price USD": "price_close",
    "Bitcoin Marketcap": "market_cap",
    "Sats Per Dollar": "sat_per_dollar",
    "Bitcoin Supply": "supply",
    "Bitcoin Miner Revenue": "coinbase_sum_24h_usd",
    "Bitcoin Transaction Volume": "transfer_volume_sum_24h_usd",
    "Bitcoin Fear & Greed Index": "fear_greed_value",
}
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
OHLC = ("Open", "High", "Low", "Close")
YEAR_OBSERVATIONS = 365


MOST_BUCKETS = 1_000_000


def _need(df: DataFrame, columns, what: str) -> None:
    missing = sorted(set(columns).difference(df.columns))
    if missing:
        raise ValueError(f"{what} needs columns: {missing}")


def _until(panel: DataFrame, as_of) -> DataFrame:
    return panel if as_of is None else panel.filter(F.col(ORDER) <= F.lit(as_of).cast("date"))


def publish(panel: DataFrame, columns: Mapping[str, str], as_of=None, required: Sequence[str] = (), keys: Sequence[str] = KEYS) -> DataFrame:
    """Select, rename and cut at the as-of date; rows with a NULL in a required column are dropped."""
    _need(panel, columns, "the export")
    rows = _until(panel, as_of)
    if required:
        rows = rows.dropna(subset=list(required))
    return rows.select(*keys, ORDER, *[col(a).alias(b) for a, b in columns.items()])


def network_export(panel: DataFrame, as_of=None, keys: Sequence[str] = KEYS) -> DataFrame:
    return publish(panel.filter(positive("price_close").isNotNull()), NETWORK_COLUMNS, as_of, keys=keys)


def electricity_export(panel: DataFrame, as_of=None, keys: Sequence[str] = KEYS) -> DataFrame:
    needed = ["price_close", "daily_electricity_consumption_kwh", "miner_revenue_btc"]
    return publish(panel, ELECTRICITY_COLUMNS, as_of, needed, keys)


def price_model_export(panel: DataFrame, as_of=None, keys: Sequence[str] = KEYS) -> DataFrame:
    out = publish(panel, PRICE_MODEL_COLUMNS, as_of, ["price_close"], keys)
    return out.withColumn("3x Realized Price", F.col("Realized Price") * 3)


def year_end_table(panel: DataFrame, growth: DataFrame, as_of=None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Valuation columns left-joined to their growth rates, both cut at the as-of date; absent columns are skipped."""
    left = _until(panel, as_of).select(*keys, ORDER, *[col(c) for c in YEAR_END_COLUMNS if c in panel.columns])
    right = _until(growth, as_of).select(*keys, ORDER, *[col(c) for c in YEAR_END_GROWTH if c in growth.columns])
    return left.join(right, [*keys, ORDER], "left")


def price_buckets(panel: DataFrame, size: float, as_of=None, price: str = "price_close", ts: str | None = None, keys: Sequence[str] = KEYS, most: int = MOST_BUCKETS) -> DataFrame:
    """Days per price range from zero to the highest price, empty ranges kept, current range marked.

    The FIRST positive value of a day counts when ``ts`` gives intraday order. A price that would need more than
    ``most`` ranges is an error: the published contract ends far below the default.
    """
    if size <= 0:
        raise ValueError("bucket size must be greater than zero")
    rows = panel.withColumn("_p", positive(price)).filter("_p IS NOT NULL")
    if ts is not None:
        rows = daily(rows, ts, ["_p"], "first", keys)
    rows = _until(rows, as_of)
    bucket = F.floor(F.col("_p") / F.lit(float(size)))
    counts = rows.groupBy(*keys, bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("Count"), F.max(F.struct(ORDER, "_p")).alias("newest")
    )
    ends = counts.groupBy(*keys).agg(F.max("bucket").alias("top"), F.max("newest").alias("newest"))
    too_many = F.raise_error(F.concat(F.lit(f"a price needs more than {most} ranges of {size}: "), F.col("top").cast("string"))).cast("bigint")
    ends = ends.withColumn("top", F.when(F.col("top") >= most, too_many).otherwise(F.col("top")))
    ranges = ends.select(*keys, F.col("newest._p").alias("Current Price"), F.explode(F.sequence(F.lit(0).cast("bigint"), "top")).alias("bucket"))
    low, high = F.col("bucket") * F.lit(float(size)), (F.col("bucket") + 1) * F.lit(float(size))
    out = ranges.join(counts.drop("newest"), [*keys, "bucket"], "left").select(
        *keys,
        thousands_range(low, high).alias("Price Range ($)"),
        F.coalesce("Count", F.lit(0)).cast("bigint").alias("Count"),
        ((F.col("Current Price") >= low) & (F.col("Current Price") < high)).alias("Is Current Bucket"),
        "Current Price",
        low.alias("low"),
        high.alias("high"),
    )
    return present(out, rows, f"no positive '{price}' on or before {as_of}")


def summary_history(panel: DataFrame, as_of, metrics: Mapping[str, str] = SUMMARY_METRICS, comparison_days: int = 30, keys: Sequence[str] = KEYS) -> DataFrame:
    """Long (Metric, date, Value) for the newest row and the ``comparison_days`` before it, both ends included."""
    if comparison_days < 0:
        raise ValueError("comparison_days cannot be negative")
    known = {label: c for label, c in metrics.items() if c in panel.columns}
    rows = _until(panel, as_of)
    newest = rows.groupBy(*keys).agg(F.max(ORDER).alias("newest"))
    recent = rows.join(newest, list(keys)).filter(F.col(ORDER) >= F.date_sub("newest", comparison_days))
    cells = recent.select(*keys, ORDER, *[col(c).cast("double").alias(label) for label, c in known.items()])
    long = cells.unpivot([*keys, ORDER], list(known), "Metric", "Value")
    return long.filter("Value IS NOT NULL").select(*keys, "Metric", ORDER, "Value")


def fundamentals(panel: DataFrame, template: Mapping[str, Mapping[str, tuple[str, str]]], as_of=None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Formatted current and prior values, change, the newest week and the range of the last 365 observations.

    "Current" is the last non-NULL value of the metric; the prior one is looked up seven days before that date; the
    week is that of the newest row.
    """
    entries = [
        (i, section, label, column, kind)
        for i, (section, label, column, kind) in enumerate(
            (section, label, column, kind) for section, rows in template.items() for label, (column, kind) in rows.items()
        )
    ]
    _need(panel, [e[3] for e in entries], "fundamentals")
    rows = _until(panel, as_of)
    cells = ", ".join(
        f"struct({i} AS place, {sql.text(section)} AS Section, {sql.text(label)} AS Metric, {sql.text(kind)} AS kind, {sql.finite(sql.q(column))} AS value)"
        for i, section, label, column, kind in entries
    )
    recent = _recent_years(rows, [column for *_, column, _ in entries], keys)
    kept = f"inline(filter(array({cells}), x -> x.value IS NOT NULL AND year({ORDER}) >= element_at(_from, x.place + 1)))"
    long = rows.join(recent, list(keys)).selectExpr(*map(sql.q, keys), ORDER, "newest", kept)
    # A metric keeps the values of its newest years only: under 365 and those of one year more.
    seen = F.sort_array(F.collect_list(F.struct(ORDER, "value")), asc=False).alias("seen")
    facts = long.groupBy(*keys, "place", "Section", "Metric", "kind", "newest").agg(seen)
    first = lambda condition: f"get(filter(seen, x -> {condition}), 0).value"
    year = f"transform(slice(seen, 1, {YEAR_OBSERVATIONS}), x -> x.value)"
    wide = facts.selectExpr(
        *map(sql.q, keys),
        "place",
        "Section",
        "Metric",
        "kind",
        "seen[0].value AS current",
        f"{first(f'x.{ORDER} <= date_sub(seen[0].{ORDER}, 7)')} AS prior",
        f"array_min({year}) AS low",
        f"array_max({year}) AS high",
        *[f"{first(f'x.{ORDER} = date_add(newest, {i} - weekday(newest))')} AS {d}" for i, d in enumerate(WEEKDAYS)],
    )
    cell = lambda c: formatted(c, "kind")
    return wide.select(
        *keys,
        "place",
        "Section",
        "Metric",
        cell("current").alias("Current Value"),
        cell("prior").alias("7 Days Ago"),
        pct_change("current", "prior").alias("7 Day Change (%)"),
        *[cell(d).alias(d) for d in WEEKDAYS],
        cell("low").alias("52W Low"),
        cell("high").alias("52W High"),
    )


def _recent_years(rows: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys, _from, newest): per column the year from which on it has ``YEAR_OBSERVATIONS`` values, or its first year; the newest date.

    Counted on one row per year, so that only the newest years of a long history are turned into cells.
    """
    n = range(len(columns))
    counts = [f"count({sql.finite(sql.q(c))}) AS _n{i}" for i, c in enumerate(columns)]
    counted = rows.groupBy(*keys, F.year(ORDER).alias("_year")).agg(*map(F.expr, counts), F.max(ORDER).alias("_last"))
    # One small array of (year, counts) per report, newest first, folded from the newest year on.
    years = F.sort_array(F.collect_list(F.struct("_year", F.array(*[f"_n{i}" for i in n]).alias("n"))), asc=False)
    small = counted.groupBy(*keys).agg(years.alias("_years"), F.max("_last").alias("newest"))
    reached = ", ".join(
        f"coalesce(aggregate(_years, struct(0L AS s, CAST(NULL AS INT) AS y), (a, x) -> struct(a.s + x.n[{i}] AS s, "
        f"CASE WHEN a.y IS NULL AND a.s + x.n[{i}] >= {YEAR_OBSERVATIONS} THEN x._year ELSE a.y END AS y), a -> a.y), element_at(_years, -1)._year)"
        for i in n
    )
    return small.selectExpr(*map(sql.q, keys), f"array({reached}) AS _from", "newest")


def summary_table(panel: DataFrame, as_of, keys: Sequence[str] = KEYS) -> DataFrame:
    """Ten headline values of the as-of row: text in ``Value`` and, where it is a number, a DOUBLE in ``Number``."""
    row = as_of_row(panel, as_of, keys, required=True)
    c = lambda name: finite(name) if name in panel.columns else F.lit(None).cast("double")
    given = col("fear_greed_classification") if "fear_greed_classification" in panel.columns else F.lit(None).cast("string")
    mood = F.when(F.coalesce(given, F.lit("")) != "", given).otherwise(sentiment_class(c("fear_greed_value")))
    none = F.lit(None).cast("double")
    entries = [
        ("Bitcoin Price USD", "Market Data", c("price_close"), None),
        ("Bitcoin Marketcap", "Market Data", c("market_cap"), None),
        ("Sats Per Dollar", "Market Data", ratio(F.lit(float(UNITS_PER_COIN)), c("price_close")), None),
        ("Bitcoin Supply", "On-chain Data", c("supply"), None),
        ("Bitcoin Miner Revenue", "On-chain Data", c("coinbase_sum_24h_usd"), None),
        ("Bitcoin Transaction Volume", "On-chain Data", c("transfer_volume_sum_24h_usd"), None),
        ("Bitcoin Dominance", "Investor Sentiment", c("bitcoin_dominance"), None),
        ("Bitcoin Fear & Greed Index", "Investor Sentiment", c("fear_greed_value"), None),
        ("Bitcoin Market Sentiment", "Investor Sentiment", none, mood),
        ("Bitcoin Valuation", "Investor Sentiment", none, valuation_class(c("mvrv_ratio"))),
    ]
    cells = [
        F.struct(
            F.lit(i).alias("place"),
            F.lit(metric).alias("Metric"),
            (value.cast("string") if text is None else text).alias("Value"),
            F.lit(category).alias("Category"),
            value.alias("Number"),
        )
        for i, (metric, category, value, text) in enumerate(entries)
    ]
    return row.select(*keys, F.inline(F.array(*cells)))


def performance(panel: DataFrame, assets: Sequence[tuple[str, str, str]], as_of, correlations: DataFrame, price: str = "price_close", benchmark: str | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per (category, label, entity) asset: as-of price and changes, 52-week range, 90-row correlation.

    All assets are read on one date, the benchmark's newest one (the newest of all where none is named), and a configured
    asset without a row on that date is published with NULLs. The last key is the asset's; the keys before it tell reports
    apart. Changes are computed for that date alone, unless ``panel`` carries them (``{price}_7_change`` and so on);
    ``correlations`` is (keys, corr_90).
    """
    *group, entity = keys
    labels = ("7", "MTD", "YTD", "90")
    given = [f"{price}_{p}_change" for p in labels]
    given = given if set(given) <= set(panel.columns) else []
    wanted = F.col(entity).isin(sorted({e for _, _, e in assets}))
    rows = _until(panel, as_of).select(*keys, ORDER, col(price).alias("price"), *[col(c).alias(f"price_{p}_change") for p, c in zip(labels, given)])
    lead = rows if benchmark is None else rows.filter(F.col(entity) == F.lit(benchmark))
    day = lead.groupBy(*group).agg(F.max(ORDER).alias("_day"))
    dimension = F.array(
        *[
            F.struct(F.lit(i).alias("place"), F.lit(category).alias("Category"), F.lit(label).alias("Asset"), F.lit(e).alias(entity))
            for i, (category, label, e) in enumerate(assets)
        ]
    )
    listed = day.select(*group, "_day", F.inline(dimension))
    changes = [f"price_{p}_change" for p in labels]
    seen = rows.filter(wanted)
    if not given:
        facts = changes_at(seen, "price", day, keys=keys)
        facts = facts.select(*keys, F.struct("price", *changes).alias("_now"), "high", "low")
    else:
        dated = seen.join(day, list(group)) if group else seen.withColumn("_day", day.select("_day").scalar())
        dated = dated.filter(F.col(ORDER).between(F.date_sub("_day", 365), F.col("_day")))
        facts = dated.groupBy(*keys).agg(
            F.max(F.when(F.col(ORDER) == F.col("_day"), F.struct("price", *changes))).alias("_now"), F.max("price").alias("high"), F.min("price").alias("low")
        )
    joined = listed.join(facts, list(keys), "left").join(correlations.select(*keys, "corr_90"), list(keys), "left")
    own = F.when(F.col(entity) == F.lit(benchmark), F.lit(1.0)) if benchmark is not None else F.lit(None).cast("double")
    now = lambda c: F.col(f"_now.`{c}`")
    out = joined.select(
        *group,
        "place",
        "Category",
        "Asset",
        now("price").alias("Price"),
        now(changes[0]).alias("7 Day Return (%)"),
        now(changes[1]).alias("MTD Return (%)"),
        now(changes[2]).alias("YTD Return (%)"),
        now(changes[3]).alias("90 Day Return (%)"),
        F.col("high").alias("52 Week High"),
        F.col("low").alias("52 Week Low"),
        F.coalesce(own, F.col("corr_90")).alias("90 Day BTC Correlation"),
    )
    return present(out, lead, f"no row of {benchmark or 'any asset'} on or before {as_of}")


def combined_performance(rows: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """One row per asset: the last category's values, at the position of the first."""
    rest = [c for c in rows.columns if c not in ("place", "Asset", *group)]
    merged = rows.groupBy(*group, "Asset").agg(
        F.min("place").alias("place"), F.max_by(F.struct(*[col(c) for c in rest]), "place").alias("_row")
    )
    return merged.select(*group, "place", "Asset", *[F.col(f"_row.`{c}`").alias(c) for c in rest]).orderBy(*group, "place")


def clean_candles(candles: DataFrame, order: str = "Time", keys: Sequence[str] = KEYS) -> DataFrame:
    """Numeric, finite, complete candles."""
    _need(candles, OHLC, "candles")
    return candles.select(*keys, order, *[number(c).alias(c) for c in OHLC]).dropna(subset=list(OHLC))


def weekly_candles(daily_candles: DataFrame, order: str = "Time", keys: Sequence[str] = KEYS) -> DataFrame:
    """Monday-labelled candles from complete daily ones."""
    week = F.to_date(F.date_trunc("week", F.col(order))).alias(order)
    return clean_candles(daily_candles, order, keys).groupBy(*keys, week).agg(
        F.min_by("Open", order).alias("Open"), F.max("High").alias("High"), F.min("Low").alias("Low"), F.max_by("Close", order).alias("Close")
    )


def candle_summary(daily_candles: DataFrame, as_of, order: str = "Time", keys: Sequence[str] = KEYS) -> DataFrame:
    """The as-of daily candle and the week to date from Monday."""
    rows = clean_candles(daily_candles, order, keys).filter(F.col(order) <= F.lit(as_of).cast("date"))
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(order, *OHLC), order).alias("d"))
    start = F.date_sub(F.col(f"d.{order}"), F.weekday(F.col(f"d.{order}")))
    week = rows.join(newest.withColumn("week_start", start), list(keys)).filter(F.col(order) >= F.col("week_start"))
    out = week.groupBy(*keys, "week_start", "d").agg(
        F.min_by("Open", order).alias("wo"), F.max("High").alias("wh"), F.min("Low").alias("wl"), F.count(F.lit(1)).alias("days")
    ).select(
        *keys,
        F.col(f"d.{order}").alias("Report Date"),
        *[F.col(f"d.{c}").alias(f"Daily {c}") for c in OHLC],
        F.col("week_start").alias("Week Start"),
        F.col("wo").alias("Week-to-Date Open"),
        F.col("wh").alias("Week-to-Date High"),
        F.col("wl").alias("Week-to-Date Low"),
        F.col("d.Close").alias("Week-to-Date Close"),
        F.col("days").alias("Week-to-Date Days"),
    )
    return present(out, rows, f"no complete candle on or before {as_of}")


def asset_valuation(panel: DataFrame, assets: Sequence[tuple[str, str, str]], as_of, price: str = "price_close", keys: Sequence[str] = KEYS) -> DataFrame:
    """Cap, implied price and move of each (name, implied-price column, cap column) asset on the as-of row."""
    row = as_of_row(panel, as_of, keys, required=True)
    c = lambda name: col(name).cast("double") if name in panel.columns else F.lit(None).cast("double")
    entries = [F.struct(F.lit(n).alias("Asset"), c(cap).alias("cap"), c(implied).alias("implied")) for n, implied, cap in assets]
    listed = row.select(*keys, col(price).alias("_price"), F.inline(F.array(*entries)))
    move = ratio(F.col("implied") - F.col("_price"), positive("_price")) * 100
    return listed.select(
        *keys,
        "Asset",
        F.col("cap").alias("Market Cap (USD)"),
        F.col("implied").alias("Market Cap BTC Price"),
        move.alias("BTC % Move to Marketcap BTC Price"),
    ).orderBy(*keys, F.desc_nulls_last("Market Cap (USD)"))
