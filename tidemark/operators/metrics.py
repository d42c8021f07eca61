"""Valuation and network metrics of a panel with one entity per network.

Input column names are the contract of the wide table; each function adds columns and leaves the rest as it is.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sql
from ..functions.expressions import col, positive, ratio
from ..session import settle
from .chunks import KEYS, ORDER, ROW, Calc, Chunked, Roll, beside, needed, reach_of, running
from .prepare import ffill

UNITS_PER_COIN = 100_000_000
MAX_SUPPLY = 21_000_000

# Fixed values of the stock-to-flow line.
FLOW_INTERCEPT = 14.6
FLOW_POWER = 3.3


# Input columns of the on-chain metrics.
ONCHAIN_INPUTS = (
    "market_cap",
    "supply",
    "realized_cap",
    "realized_price",
    "price_close",
    "transfer_volume_sum_24h_usd",
    "coinbase_sum_24h_usd",
    "coinbase_sum_24h",
    "fees_sum_24h",
    "utxos_over_1y_old_supply",
    "coindays_destroyed_sum_24h",
    "supply_in_profit",
    "supply_in_loss",
    "active_addrs_average_24h",
)


# Row-wise columns before the windows, and after them; all but the windows themselves is text of one select each.
_BEFORE = {
    "NVTAdj": sql.ratio("`market_cap`", "`transfer_volume_sum_24h_usd`"),
    "adjusted_bdd": sql.ratio("`coindays_destroyed_sum_24h`", "`supply`"),
    "vocd": f"`price_close` * {sql.ratio('`coindays_destroyed_sum_24h`', '`supply`')}",
}
_YEAR = math.sqrt(365)
_STEPS = (
    Calc("_return", "return", "price_close"),
    Roll("_volume_90", "transfer_volume_sum_24h_usd", 90),
    Roll("7_day_ma_price_close", "price_close", 7),
    Roll("50_day_ma_price_close", "price_close", 50),
    Roll("100_day_ma_price_close", "price_close", 100),
    Roll("200_day_ma_price_close", "price_close", 200),
    Roll("200_week_ma_price_close", "price_close", 200 * 7),
    Roll("_std_30", "_return", 30, "std"),
    Roll("_std_180", "_return", 180, "std"),
    Calc("VtyDayRet30d", "scaled", "_std_30", _YEAR),
    Calc("VtyDayRet180d", "scaled", "_std_180", _YEAR),
    Calc("NVTAdj90", "ratio", "market_cap", "_volume_90"),
    Roll("_nvt_730", "NVTAdj", 365 * 2, "median"),
    Roll("_nvt90_365", "NVTAdj90", 365, "median"),
    Calc("_nvt_volume", "times", "_nvt_730", "transfer_volume_sum_24h_usd"),
    Calc("_nvt90_volume", "times", "_nvt90_365", "transfer_volume_sum_24h_usd"),
    Calc("nvt_price", "ratio", "_nvt_volume", "supply"),
    Calc("nvt_price_adj", "ratio", "_nvt90_volume", "supply"),
    Calc("nvt_price_multiple", "ratio", "price_close", "nvt_price"),
    Roll("nvt_price_multiple_ma", "nvt_price_multiple", 14),
    Roll("mvocd", "vocd", 30, "median"),
    Calc("daily_hodl_value", "excess", "price_close", "mvocd"),
    Roll("miner_revenue_1_Year", "coinbase_sum_24h_usd", 365, "sum"),
    Roll("miner_revenue_4_Year", "coinbase_sum_24h_usd", 4 * 365, "sum"),
)
_TOTALS = {
    "RevAllTimeUSD": ("sum", "coalesce(`coinbase_sum_24h_usd`, 0D)"),
    "adjusted_bdd_mean": ("mean", "`adjusted_bdd`"),
    "cumulative_market_cap": ("sum", "`market_cap`"),
}


def _in_coins(name: str) -> str:
    """Values above ten times the supply are in the small unit."""
    return f"(CASE WHEN `{name}` > `supply` * 10 THEN `{name}` / {float(UNITS_PER_COIN)}D ELSE `{name}` END)"


def _after() -> dict[str, str]:
    r = sql.ratio
    held = f"{r('`utxos_over_1y_old_supply`', '`supply`')} * 100"
    average = r("`cumulative_market_cap`", f"`{ROW}`")
    return {
        "sat_per_dollar": r(f"{float(UNITS_PER_COIN)}D", sql.positive("`price_close`")),
        "mvrv_ratio": r("`market_cap`", "`realized_cap`"),
        "CapMVRVCur": r("`market_cap`", "`realized_cap`"),
        "nupl": r("`market_cap` - `realized_cap`", "`market_cap`"),
        "200_day_multiple": r("`price_close`", "`200_day_ma_price_close`"),
        "thermocap_multiple": r("`market_cap`", "`RevAllTimeUSD`"),
        "thermocap_price": r("`RevAllTimeUSD`", "`supply`"),
        **{f"thermocap_price_multiple_{k}": r(f"`RevAllTimeUSD` * {k}", "`supply`") for k in (4, 8, 16, 32)},
        "ss_multiple_1": r("`market_cap`", "`miner_revenue_1_Year`"),
        "ss_price_1": r("`miner_revenue_1_Year`", "`supply`"),
        "ss_multiple_4": r("`market_cap`", "`miner_revenue_4_Year`"),
        "ss_price_4": r("`miner_revenue_4_Year`", "`supply`"),
        **{f"realizedcap_multiple_{k}": r(f"`realized_cap` * {k}", "`supply`") for k in (2, 3, 5, 7)},
        "supply_pct_1_year_plus": held,
        "pct_supply_issued": f"`supply` / {float(MAX_SUPPLY)}D",
        "pct_fee_of_reward": f"{r('`fees_sum_24h`', '`coinbase_sum_24h`')} * 100",
        "illiquid_supply": f"{held} / 100 * `supply`",
        "liquid_supply": f"`supply` - {held} / 100 * `supply`",
        "daily_active_addresses_sending": "`active_addrs_average_24h`",
        "adjusted_bdd_above_avg": "coalesce(`adjusted_bdd` > `adjusted_bdd_mean`, false)",
        "reserve_risk_calc": r("`price_close`", "`hodl_bank_calc`"),
        "days_since_start": f"`{ROW}`",
        "average_cap": average,
        "delta_cap": f"`realized_cap` - {average}",
        "average_cap_price": r(average, "`supply`"),
        "delta_cap_price": r(f"`realized_cap` - {average}", "`supply`"),
        "supply_in_profit_btc": _in_coins("supply_in_profit"),
        "supply_in_loss_btc": _in_coins("supply_in_loss"),
        "supply_in_profit_pct": f"{r(_in_coins('supply_in_profit'), '`supply`')} * 100",
        "supply_in_loss_pct": f"{r(_in_coins('supply_in_loss'), '`supply`')} * 100",
        "realized_price": f"coalesce(`realized_price`, {r('`realized_cap`', '`supply`')})",
    }


#: Names of the derived on-chain columns.
ONCHAIN_METRICS = (*_BEFORE, *(s.out for s in _STEPS if not s.out.startswith("_")), *_TOTALS, "hodl_bank_calc", *_after())


def onchain_metrics(panel: DataFrame, keys: Sequence[str] = KEYS, columns: Sequence[str] | None = None) -> DataFrame:
    """Valuation ratios, price means, thermocap, miner revenue, supply, reserve risk, average cap and volatility.

    All rolling windows, nested ones too, are one Arrow pass over runs of rows with as many rows before each as the windows reach;
    running totals come before it, and after it that of the daily holding value, whose input is settled because a running
    total reads it twice. ``columns`` names the derived columns that are wanted: only what these rest on is read and computed,
    and the result has the keys, the date and these columns. Without it all columns of the panel stay and all are added.
    """
    if columns is not None:
        unknown = sorted(set(columns).difference(ONCHAIN_METRICS))
        if unknown:
            raise ValueError(f"no such metrics: {unknown}")
        return _onchain_metrics(panel, keys, columns).select(*keys, ORDER, *[col(c) for c in columns])
    return beside(panel, ONCHAIN_INPUTS, lambda narrow: _onchain_metrics(narrow, keys, ONCHAIN_METRICS), keys)


def _onchain_metrics(panel: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    after = _after()
    if "realized_price" not in panel.columns:
        after["realized_price"] = sql.ratio("`realized_cap`", "`supply`")
    read = sql.closure([c for c in columns if c in after], after) | set(columns)
    bank = "hodl_bank_calc" in read
    read |= {"daily_hodl_value"} if bank else set()
    steps = needed(_STEPS, read)
    read |= {c for s in steps for c in (s.column, s.other) if isinstance(c, str)}
    totals = {out: spec for out, spec in _TOTALS.items() if out in read}
    read |= {c for _, x in totals.values() for c in sql.columns_in(x)}
    before = {c: x for c, x in _BEFORE.items() if c in read}
    read |= {c for x in before.values() for c in sql.columns_in(x)}

    given = panel.select(*keys, ORDER, *[col(c) for c in panel.columns if c in read and c not in keys and c != ORDER])
    out = sql.derive(given, before) if before else given
    if steps or totals or ROW in read:
        out = running(out, {ROW: ("rows", F.lit(1)), **{c: (kind, F.expr(x)) for c, (kind, x) in totals.items()}}, keys)
        if "cumulative_market_cap" in totals:
            out = out.withColumn("cumulative_market_cap", F.expr("CASE WHEN `market_cap` IS NOT NULL THEN `cumulative_market_cap` END"))
    if steps:
        chunks = Chunked(out, reach_of(steps), keys=keys)
        out = chunks.owned(chunks.roll(chunks.frame, steps, [s.out for s in steps if s.out in read and not s.out.startswith("_")]))
    if bank:
        out = running(settle(out), {"hodl_bank_calc": ("sum", "daily_hodl_value")}, keys)
        out = out.withColumn("hodl_bank_calc", F.expr("CASE WHEN `daily_hodl_value` IS NOT NULL THEN `hodl_bank_calc` END"))
    return sql.derive(out, {c: x for c, x in after.items() if c in columns}).drop(ROW)


def stock_to_flow(panel: DataFrame, keys: Sequence[str] = KEYS, dense: bool = False) -> DataFrame:
    """Supply over its positive 365-row growth, the fixed scarcity line, its price and 365-row mean."""
    return beside(panel, ("supply", "price_close"), lambda narrow: _stock_to_flow(narrow, keys, dense), keys)


def _stock_to_flow(panel: DataFrame, keys: Sequence[str], dense: bool) -> DataFrame:
    chunks = Chunked(panel, reach=365 + 364, keys=keys, dense=dense)
    growth = positive(col("supply") - chunks.lag("supply", 365))
    frame = chunks.frame.withColumn("SF", ratio("supply", growth))
    frame = frame.withColumn("SF_Predicted_Market_Value", F.exp(F.lit(FLOW_INTERCEPT)) * F.pow("SF", F.lit(FLOW_POWER)))
    frame = frame.withColumn("SF_Predicted_Price", ratio("SF_Predicted_Market_Value", "supply"))
    rolled = chunks.owned(chunks.roll(frame, [Roll("SF_Predicted_Price_MA365", "SF_Predicted_Price", 365)]))
    return rolled.withColumn("SF_Multiple", ratio("price_close", "SF_Predicted_Price"))


# --- values another asset or money supply would imply ---------------------------------------------------------------


def slug(name: str) -> str:
    return name.replace(" ", "_")


def fiat_parity(panel: DataFrame, trillions: Mapping[str, float]) -> DataFrame:
    """``{country}_btc_price`` and ``{country}_cap``: the money supply, and it spread over the coin supply."""
    added = {}
    for country, amount in trillions.items():
        added[f"{slug(country)}_btc_price"] = ratio(F.lit(amount * 1e12), "supply")
        added[f"{slug(country)}_cap"] = F.lit(amount * 1e12)
    return panel.withColumns(added)


def dimension_cross(panel: DataFrame, dimension: Mapping[str, float], name: str, value: str) -> DataFrame:
    """Every row once per entry of a small literal dimension (long form); no join is involved."""
    entries = F.array(*[F.struct(F.lit(k).alias(name), F.lit(float(v)).alias(value)) for k, v in dimension.items()])
    return panel.select("*", F.inline(entries))


def metal_caps(panel: DataFrame, ounces: Mapping[str, float], price_columns: Mapping[str, str], keys: Sequence[str] = KEYS) -> DataFrame:
    """``{metal}_marketcap_billion_usd``: supply times the LAST available price, the same on every row (absolute USD)."""
    known = {m: price_columns[m] for m in ounces if price_columns.get(m) in panel.columns}
    newest = panel.groupBy(*keys).agg(
        *[F.max_by(col(p), F.when(col(p).isNotNull(), F.col(ORDER))).alias(f"_last_{m}") for m, p in known.items()]
    )
    joined = panel.join(newest, list(keys), "left")
    caps = {f"{m.lower()}_marketcap_billion_usd": col(f"_last_{m}") * F.lit(float(ounces[m])) for m in known}
    return joined.withColumns(caps).drop(*[f"_last_{m}" for m in known])


def cap_breakdown(panel: DataFrame, shares_pct: Mapping[str, float], metal: str = "gold") -> DataFrame:
    """Share of a metal's cap per use."""
    whole = col(f"{metal}_marketcap_billion_usd")
    return panel.withColumns(
        {f"{metal}_marketcap_{slug(k).lower()}_billion_usd": whole * F.lit(v / 100.0) for k, v in shares_pct.items()}
    )


def metal_parity(panel: DataFrame, shares_pct: Mapping[str, float], keys: Sequence[str] = KEYS) -> DataFrame:
    """Prices at which the coin would match the metal caps; the supply is carried forward and stays so afterwards.

    An entity whose newest supply is zero or missing gets NULL prices.
    """
    filled = ffill(panel, ["supply"], None, keys)
    seen = F.when(F.col("supply").isNotNull(), F.col(ORDER))
    newest = panel.groupBy(*keys).agg(F.max_by("supply", seen).alias("_newest_supply"))
    usable = filled.join(newest, list(keys), "left").withColumn(
        "_supply", F.when(F.col("_newest_supply") != 0, F.col("supply"))
    )
    gold, silver = col("gold_marketcap_billion_usd"), col("silver_marketcap_billion_usd")
    added = {"gold_marketcap_btc_price": ratio(gold, "_supply")}
    added |= {f"gold_{slug(k).lower()}_marketcap_btc_price": ratio(gold * F.lit(v / 100.0), "_supply") for k, v in shares_pct.items()}
    added["silver_marketcap_btc_price"] = ratio(silver, "_supply")
    return usable.withColumns(added).drop("_supply", "_newest_supply")


def asset_parity(panel: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """``{ticker}_mc_btc_price``: a company's value spread over the coin supply."""
    return panel.withColumns({f"{t}_mc_btc_price": ratio(f"{t}_MarketCap", "supply") for t in tickers})


def asset_parity_long(base: DataFrame, caps: DataFrame) -> DataFrame:
    """The same in long form: (asset, date, market_cap) against the base supply of the date."""
    supply = base.select(ORDER, F.col("supply"), F.col("price_close"))
    return caps.join(supply, ORDER).withColumn("parity_price", ratio("market_cap", "supply"))
