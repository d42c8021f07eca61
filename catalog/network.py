"""Queries of the metric, model, energy, segment and share operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import energy, metrics, models, segments, shares, windows
from tidemark.session import settle

from .base import AS_OF, NATIONS, NETWORK, PANEL, nations, network, panel, table
from .case import Case

CASES: dict[str, Case] = {}

# Event dates, cycle boundaries and drawdown windows inside the dates of the order tables.
EVENTS = ("1994-06-01", "1995-09-04", "1997-03-03", "1998-11-02")
STEP = 500
CYCLES = ("1995-01-01", "1996-05-06", "1998-02-03", "1999-12-31")
DRAWDOWNS = (("Drawdown Cycle 1", "1995-02-01", "1996-03-04"), ("Drawdown Cycle 2", "1997-01-02", "1999-01-05"), ("Drawdown Cycle 3", "2000-01-03", None))


def _frame(rows: int, value: str, column: str) -> str:
    w = f"(PARTITION BY entity ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({column}) OVER {w} = {rows} THEN {value} OVER {w} END"


# --- on-chain metrics -----------------------------------------------------------------------------------------------

ALL = "(PARTITION BY entity ORDER BY date ROWS UNBOUNDED PRECEDING)"
METRICS_SQL = (
    NETWORK
    + f"""s1 AS (SELECT *, market_cap / nullif(transfer_volume_sum_24h_usd, 0) AS "NVTAdj", coindays_destroyed_sum_24h / supply AS adjusted_bdd,
  price_close * (coindays_destroyed_sum_24h / supply) AS vocd, price_close / lag(price_close) OVER (PARTITION BY entity ORDER BY date) - 1 AS ret,
  row_number() OVER (PARTITION BY entity ORDER BY date) AS days_since_start FROM net),
s2 AS (SELECT *, sum(coalesce(coinbase_sum_24h_usd, 0)) OVER {ALL} AS "RevAllTimeUSD", avg(adjusted_bdd) OVER {ALL} AS adjusted_bdd_mean,
  sum(market_cap) OVER {ALL} AS cumulative_market_cap,
  market_cap / ({_frame(90, 'avg(transfer_volume_sum_24h_usd)', 'transfer_volume_sum_24h_usd')}) AS "NVTAdj90",
  {_frame(730, 'median("NVTAdj")', '"NVTAdj"')} AS nvt730, {_frame(30, 'median(vocd)', 'vocd')} AS mvocd,
  {_frame(7, 'avg(price_close)', 'price_close')} AS "7_day_ma_price_close", {_frame(50, 'avg(price_close)', 'price_close')} AS "50_day_ma_price_close",
  {_frame(100, 'avg(price_close)', 'price_close')} AS "100_day_ma_price_close", {_frame(200, 'avg(price_close)', 'price_close')} AS "200_day_ma_price_close",
  {_frame(1400, 'avg(price_close)', 'price_close')} AS "200_week_ma_price_close",
  {_frame(365, 'sum(coinbase_sum_24h_usd)', 'coinbase_sum_24h_usd')} AS "miner_revenue_1_Year",
  {_frame(1460, 'sum(coinbase_sum_24h_usd)', 'coinbase_sum_24h_usd')} AS "miner_revenue_4_Year",
  {_frame(30, 'stddev_samp(ret)', 'ret')} * sqrt(365) AS "VtyDayRet30d", {_frame(180, 'stddev_samp(ret)', 'ret')} * sqrt(365) AS "VtyDayRet180d"
  FROM s1),
s3 AS (SELECT *, nvt730 * transfer_volume_sum_24h_usd / supply AS nvt_price,
  ({_frame(365, 'median("NVTAdj90")', '"NVTAdj90"')}) * transfer_volume_sum_24h_usd / supply AS nvt_price_adj,
  price_close / nullif(nvt730 * transfer_volume_sum_24h_usd / supply, 0) AS nvt_price_multiple,
  CASE WHEN mvocd IS NOT NULL THEN greatest(price_close - mvocd, 0) END AS daily_hodl_value FROM s2),
s4 AS (SELECT *, {_frame(14, 'avg(nvt_price_multiple)', 'nvt_price_multiple')} AS nvt_price_multiple_ma,
  CASE WHEN daily_hodl_value IS NOT NULL THEN sum(daily_hodl_value) OVER {ALL} END AS hodl_bank_calc FROM s3),
"""
)


def _metrics(columns, sql: str) -> Case:
    wanted = [c for c in columns if c not in ("entity", "date")]
    return Case(lambda s, d: metrics.onchain_metrics(network(s, d), columns=wanted), columns, sql)


CASES["valuation_ratios"] = _metrics(
    {
        "entity": "s", "date": "d", "NVTAdj": "f6", "NVTAdj90": "f6", "sat_per_dollar": "f6", "mvrv_ratio": "f8", "nupl": "f8",
        "nvt_price": "f3", "nvt_price_adj": "f3", "nvt_price_multiple": "f7", "nvt_price_multiple_ma": "f7",
    },
    METRICS_SQL + """--body
SELECT *, 100000000 / price_close AS sat_per_dollar, market_cap / realized_cap AS mvrv_ratio, (market_cap - realized_cap) / market_cap AS nupl FROM s4""",
)
CASES["price_means"] = _metrics(
    {"entity": "s", "date": "d", **{f"{n}_ma_price_close": "f4" for n in ("7_day", "50_day", "100_day", "200_day", "200_week")}, "200_day_multiple": "f8"},
    METRICS_SQL + '--body\nSELECT *, price_close / "200_day_ma_price_close" AS "200_day_multiple" FROM s4',
)
CASES["thermocap"] = _metrics(
    {"entity": "s", "date": "d", "RevAllTimeUSD": "f1", "thermocap_multiple": "f5", "thermocap_price": "f4", "thermocap_price_multiple_8": "f3", "thermocap_price_multiple_32": "f3"},
    METRICS_SQL + """--body
SELECT *, market_cap / nullif("RevAllTimeUSD", 0) AS thermocap_multiple, "RevAllTimeUSD" / supply AS thermocap_price,
       8 * "RevAllTimeUSD" / supply AS thermocap_price_multiple_8, 32 * "RevAllTimeUSD" / supply AS thermocap_price_multiple_32 FROM s4""",
)
CASES["miner_revenue"] = _metrics(
    {"entity": "s", "date": "d", "miner_revenue_1_Year": "f3", "miner_revenue_4_Year": "f3", "ss_multiple_1": "f6", "ss_price_1": "f5", "ss_multiple_4": "f6", "ss_price_4": "f5"},
    METRICS_SQL + """--body
SELECT *, market_cap / "miner_revenue_1_Year" AS ss_multiple_1, "miner_revenue_1_Year" / supply AS ss_price_1,
       market_cap / "miner_revenue_4_Year" AS ss_multiple_4, "miner_revenue_4_Year" / supply AS ss_price_4 FROM s4""",
)
CASES["realized_cap_multiples"] = _metrics(
    {"entity": "s", "date": "d", "realized_price": "f4", **{f"realizedcap_multiple_{k}": "f4" for k in (2, 3, 5, 7)}},
    METRICS_SQL + """--body
SELECT * REPLACE (coalesce(realized_price, realized_cap / supply) AS realized_price), 2 * realized_cap / supply AS realizedcap_multiple_2,
       3 * realized_cap / supply AS realizedcap_multiple_3, 5 * realized_cap / supply AS realizedcap_multiple_5, 7 * realized_cap / supply AS realizedcap_multiple_7 FROM s4""",
)
CASES["supply_metrics"] = _metrics(
    {
        "entity": "s", "date": "d", "supply_pct_1_year_plus": "f6", "pct_supply_issued": "f8", "pct_fee_of_reward": "f6", "illiquid_supply": "f4", "liquid_supply": "f4",
        "daily_active_addresses_sending": "f0", "supply_in_profit_btc": "f4", "supply_in_loss_btc": "f4", "supply_in_profit_pct": "f6", "supply_in_loss_pct": "f6",
    },
    METRICS_SQL + """u AS (SELECT *, CASE WHEN supply_in_profit > supply * 10 THEN supply_in_profit / 1e8 ELSE supply_in_profit END AS supply_in_profit_btc,
  CASE WHEN supply_in_loss > supply * 10 THEN supply_in_loss / 1e8 ELSE supply_in_loss END AS supply_in_loss_btc FROM s4),
--body
SELECT *, utxos_over_1y_old_supply / supply * 100 AS supply_pct_1_year_plus, supply / 21000000 AS pct_supply_issued,
       fees_sum_24h / coinbase_sum_24h * 100 AS pct_fee_of_reward, utxos_over_1y_old_supply AS illiquid_supply, supply - utxos_over_1y_old_supply AS liquid_supply,
       active_addrs_average_24h AS daily_active_addresses_sending, supply_in_profit_btc / supply * 100 AS supply_in_profit_pct,
       supply_in_loss_btc / supply * 100 AS supply_in_loss_pct FROM u""",
)
CASES["reserve_risk"] = _metrics(
    {
        "entity": "s", "date": "d", "adjusted_bdd": "f8", "adjusted_bdd_mean": "f8", "adjusted_bdd_above_avg": "b", "vocd": "f5", "mvocd": "f5",
        "daily_hodl_value": "f4", "hodl_bank_calc": "f2", "reserve_risk_calc": "f8",
    },
    METRICS_SQL + """--body
SELECT *, coalesce(adjusted_bdd > adjusted_bdd_mean, false) AS adjusted_bdd_above_avg, price_close / nullif(hodl_bank_calc, 0) AS reserve_risk_calc FROM s4""",
)
CASES["average_cap"] = _metrics(
    {"entity": "s", "date": "d", "days_since_start": "i", "average_cap": "f2", "delta_cap": "f2", "average_cap_price": "f4", "delta_cap_price": "f4", "VtyDayRet30d": "f6", "VtyDayRet180d": "f6"},
    METRICS_SQL + """--body
SELECT *, cumulative_market_cap / days_since_start AS average_cap, realized_cap - cumulative_market_cap / days_since_start AS delta_cap,
       cumulative_market_cap / days_since_start / supply AS average_cap_price,
       (realized_cap - cumulative_market_cap / days_since_start) / supply AS delta_cap_price FROM s4""",
)
CASES["moving_averages"] = Case(
    lambda s, d: windows.moving_averages(network(s, d).select("entity", "date", "hash_rate", "subsidy_sum_24h", "coinbase_sum_24h_usd"), ["hash_rate", "subsidy_sum_24h", "coinbase_sum_24h_usd"]),
    {"entity": "s", "date": "d", "7_day_ma_subsidy_sum_24h": "f6", "30_day_ma_coinbase_sum_24h_usd": "f4", "365_day_ma_coinbase_sum_24h_usd": "f4", "30_day_ma_subsidy_sum_24h": "f6"},
    NETWORK + f"""--body
SELECT entity, date, {_frame(7, 'avg(subsidy_sum_24h)', 'subsidy_sum_24h')} AS "7_day_ma_subsidy_sum_24h",
  {_frame(30, 'avg(coinbase_sum_24h_usd)', 'coinbase_sum_24h_usd')} AS "30_day_ma_coinbase_sum_24h_usd",
  {_frame(365, 'avg(coinbase_sum_24h_usd)', 'coinbase_sum_24h_usd')} AS "365_day_ma_coinbase_sum_24h_usd",
  {_frame(30, 'avg(subsidy_sum_24h)', 'subsidy_sum_24h')} AS "30_day_ma_subsidy_sum_24h" FROM net""",
)

# --- parity ---------------------------------------------------------------------------------------------------------

FIAT = {"United States": 5.73, "United Kingdom": 1.09, "Global Fiat Supply": 26.1}
METALS = {"Gold": 6_100_000_000, "Silver": 30_900_000_000}
GOLD_SPLIT = {"Jewellery": 47.0, "Private Investment": 22.0, "Official Country Holdings": 17.0, "Other": 14.0}

CASES["fiat_parity"] = Case(
    lambda s, d: metrics.fiat_parity(network(s, d), FIAT),
    {"entity": "s", "date": "d", "United_States_btc_price": "f1", "United_Kingdom_cap": "f0", "Global_Fiat_Supply_btc_price": "f0"},
    NETWORK + """--body
SELECT entity, date, 5.73 * 1e12 / supply AS "United_States_btc_price", 1.09 * 1e12 AS "United_Kingdom_cap",
       26.1 * 1e12 / supply AS "Global_Fiat_Supply_btc_price" FROM net""",
)
CASES["dimension_cross"] = Case(
    lambda s, d: metrics.dimension_cross(network(s, d), FIAT, "country", "trillions").withColumn("parity", F.col("trillions") * 1e12 / F.col("supply")),
    {"entity": "s", "date": "d", "country": "s", "parity": "f0"},
    NETWORK + """--body
SELECT entity, date, country, trillions * 1e12 / supply AS parity
FROM net, (VALUES ('United States', 5.73::DOUBLE), ('United Kingdom', 1.09::DOUBLE), ('Global Fiat Supply', 26.1::DOUBLE)) t(country, trillions)""",
)


def _metal_panel(spark, sf):
    gap = lambda name, keep: F.when(keep, F.col("price_close") / 1000).alias(name)
    return network(spark, sf).select(
        "entity", "date", "price_close", F.when(F.dayofmonth("date") != 9, F.col("supply")).alias("supply"),
        gap("gold_close", F.col("date") < "2001-05-01"), gap("silver_close", F.dayofmonth("date") > 20),
    )


METAL_SQL = NETWORK + """metal AS (SELECT entity, date, price_close, CASE WHEN day(date) <> 9 THEN supply END AS supply,
  CASE WHEN date < DATE '2001-05-01' THEN price_close / 1000 END AS gold_close, CASE WHEN day(date) > 20 THEN price_close / 1000 END AS silver_close FROM net),
caps AS (SELECT entity, 6100000000 * arg_max(gold_close, date) FILTER (WHERE gold_close IS NOT NULL) AS gold,
  30900000000 * arg_max(silver_close, date) FILTER (WHERE silver_close IS NOT NULL) AS silver FROM metal GROUP BY 1),
filled AS (SELECT entity, date, last_value(supply IGNORE NULLS) OVER (PARTITION BY entity ORDER BY date ROWS UNBOUNDED PRECEDING) AS supply FROM metal),
"""


def _metal(spark, sf):
    caps = metrics.metal_caps(_metal_panel(spark, sf), METALS, {"Gold": "gold_close", "Silver": "silver_close"})
    return metrics.metal_parity(metrics.cap_breakdown(caps, GOLD_SPLIT), GOLD_SPLIT)


CASES["metal_caps"] = Case(
    _metal,
    {"entity": "s", "date": "d", "gold_marketcap_billion_usd": "f0", "silver_marketcap_billion_usd": "f0", "gold_marketcap_private_investment_billion_usd": "f0"},
    METAL_SQL + """--body
SELECT m.entity, m.date, c.gold AS gold_marketcap_billion_usd, c.silver AS silver_marketcap_billion_usd,
       c.gold * (22.0::DOUBLE / 100) AS gold_marketcap_private_investment_billion_usd FROM metal m JOIN caps c ON c.entity = m.entity""",
)
CASES["metal_parity"] = Case(
    _metal,
    {"entity": "s", "date": "d", "supply": "f0", "gold_marketcap_btc_price": "f1", "gold_jewellery_marketcap_btc_price": "f1", "silver_marketcap_btc_price": "f1"},
    METAL_SQL + """--body
SELECT f.entity, f.date, f.supply, c.gold / f.supply AS gold_marketcap_btc_price, c.gold * 0.47::DOUBLE / f.supply AS gold_jewellery_marketcap_btc_price,
       c.silver / f.supply AS silver_marketcap_btc_price FROM filled f JOIN caps c ON c.entity = f.entity""",
)


def _asset_parity(spark, sf):
    wide = network(spark, sf).withColumn("ACME_MarketCap", F.col("transfer_volume_sum_24h_usd") * 100)
    return metrics.asset_parity(wide, ["ACME"])


CASES["asset_parity"] = Case(
    _asset_parity,
    {"entity": "s", "date": "d", "ACME_mc_btc_price": "f4"},
    NETWORK + '--body\nSELECT entity, date, transfer_volume_sum_24h_usd * 100 / supply AS "ACME_mc_btc_price" FROM net',
)


def _asset_parity_long(spark, sf):
    base = network(spark, sf)
    caps = base.select(F.col("entity").alias("asset"), "date", "market_cap")
    return metrics.asset_parity_long(base.filter("entity = 'BUILDING'"), caps)


CASES["asset_parity_long"] = Case(
    _asset_parity_long,
    {"asset": "s", "date": "d", "market_cap": "f2", "parity_price": "f4"},
    NETWORK + """--body
SELECT a.entity AS asset, a.date, a.market_cap, a.market_cap / b.supply AS parity_price FROM net a JOIN net b ON b.entity = 'BUILDING' AND b.date = a.date""",
)

# --- models ---------------------------------------------------------------------------------------------------------

ORIGIN = "1994-01-03"
CASES["stock_to_flow"] = Case(
    lambda s, d: metrics.stock_to_flow(network(s, d).select("entity", "date", "supply", "price_close")),
    {"entity": "s", "date": "d", "SF": "f8", "SF_Predicted_Price": "f3", "SF_Predicted_Price_MA365": "f3", "SF_Multiple": "f8"},
    NETWORK + f"""f1 AS (SELECT *, supply / nullif(greatest(supply - lag(supply, 365) OVER (PARTITION BY entity ORDER BY date), 0), 0) AS "SF" FROM net),
f2 AS (SELECT *, exp(14.6) * power("SF", 3.3) / supply AS p FROM f1),
--body
SELECT entity, date, "SF", p AS "SF_Predicted_Price", {_frame(365, 'avg(p)', 'p')} AS "SF_Predicted_Price_MA365", price_close / p AS "SF_Multiple" FROM f2""",
)

FIT_SQL = NETWORK + f"""age AS (SELECT *, CAST(date - DATE '{ORIGIN}' AS DOUBLE) AS age FROM net),
fit AS (SELECT entity, regr_slope(ln(price_close), ln(age)) AS exponent, exp(regr_intercept(ln(price_close), ln(age))) AS scale
  FROM age WHERE date <= DATE '{AS_OF}' AND price_close > 0 AND age > 0 GROUP BY entity),
"""
CASES["power_law"] = Case(
    lambda s, d: models.fit_power_law(network(s, d), AS_OF, origin=ORIGIN),
    {"entity": "s", "date": "d", "days_since_genesis": "f0", "power_law_exponent": "f8", "power_law_scale": "f3", "power_law_price": "f3", "power_law_price_multiple": "f8"},
    FIT_SQL + """--body
SELECT a.entity, a.date, a.age AS days_since_genesis, f.exponent AS power_law_exponent, f.scale AS power_law_scale,
       f.scale * power(a.age, f.exponent) AS power_law_price, a.price_close / (f.scale * power(a.age, f.exponent)) AS power_law_price_multiple
FROM age a JOIN fit f ON f.entity = a.entity""",
)
BANDS = {"any_balance": "addr_count", "0p001_btc": "addrs_over_100k_sats_addr_count", "0p01_btc": "addrs_over_1m_sats_addr_count", "0p1_btc": "addrs_over_10m_sats_addr_count"}
CASES["metcalfe"] = Case(
    lambda s, d: models.fit_metcalfe(network(s, d), AS_OF),
    {"entity": "s", "date": "d", **{f"metcalfe_scale_{b}": "f2" for b in BANDS}, **{f"metcalfe_value_{b}": "f3" for b in BANDS}, "metcalfe_price_multiple": "f8"},
    NETWORK
    + "scales AS (SELECT entity, "
    + ", ".join(f"exp(avg(ln(price_close * supply) - 2 * ln({c})) FILTER (WHERE {c} > 0)) AS s{i}" for i, c in enumerate(BANDS.values()))
    + f" FROM net WHERE date <= DATE '{AS_OF}' GROUP BY entity),\n--body\nSELECT n.entity, n.date, "
    + ", ".join(f's{i} AS "metcalfe_scale_{b}", s{i} * power({c}, 2) / supply AS "metcalfe_value_{b}"' for i, (b, c) in enumerate(BANDS.items()))
    + ", price_close / nullif(s0 * power(addr_count, 2) / supply, 0) AS metcalfe_price_multiple FROM net n JOIN scales s ON s.entity = n.entity",
)
CASES["hash_ribbons"] = Case(
    lambda s, d: models.ribbons(network(s, d).select("entity", "date", (F.col("hash_rate") / 1e9).alias("hash_rate"))),
    {"entity": "s", "date": "d", "30_day_ma_hash_rate": "f4", "60_day_ma_hash_rate": "f4", "hash_ribbon_ratio": "f8", "hash_ribbon_capitulation": "b"},
    NETWORK + f"""m AS (SELECT entity, date, {_frame(30, 'avg(hash_rate / 1e9)', 'hash_rate')} AS f, {_frame(60, 'avg(hash_rate / 1e9)', 'hash_rate')} AS s FROM net),
--body
SELECT entity, date, f AS "30_day_ma_hash_rate", s AS "60_day_ma_hash_rate", f / nullif(s, 0) AS hash_ribbon_ratio,
       CASE WHEN f IS NOT NULL AND s <> 0 THEN f < s END AS hash_ribbon_capitulation FROM m""",
)

ENERGY_SQL = NETWORK + f"""pos AS (SELECT *, greatest((date >= DATE '1995-09-04')::INT + (date >= DATE '1997-03-03')::INT + (date >= DATE '1998-11-02')::INT
  + CASE WHEN date >= DATE '1998-11-02' THEN (date - DATE '1998-11-02') // {STEP} ELSE 0 END, 0) AS halvings FROM net),
e AS (SELECT *, 50.0 / power(2, halvings) AS block_reward, hash_rate / 1e9 * cm_efficiency_j_gh AS w, hash_rate / 1e9 * cm_efficiency_j_gh * 24 / 1000 AS kwh,
  subsidy_sum_24h + fees_sum_24h AS rev FROM pos),
h AS (SELECT *, 0.05::DOUBLE * 24 * cm_efficiency_j_gh * (hash_rate / 1e12) / nullif(hash_rate * 86400 * block_reward / (difficulty * 4294967296), 0) AS hayes,
  hash_rate / 1e12 * (cm_efficiency_j_gh * 1000) / nullif(inflation_rate / 100 / 31557600, 0) * 2e-15 AS ev FROM e),
"""


def _energy(spark, sf):
    return energy.energy(network(spark, sf), dates=EVENTS, step_days=STEP)


CASES["electricity_cost"] = Case(
    _energy,
    {
        "entity": "s", "date": "d", "network_power_watts": "f2", "daily_electricity_consumption_kwh": "f4", "miner_revenue_btc": "f4",
        **{f"Electricity_Cost_{c}c": "f5" for c in (3, 4, 5, 6, 7)}, "power_only_breakeven_tariff_usd_per_kwh": "f6",
        "Electricity_Cost_PUE_Subsidy_Only": "f5", "Bitcoin_Production_Cost": "f5",
    },
    ENERGY_SQL
    + "--body\nSELECT *, w AS network_power_watts, kwh AS daily_electricity_consumption_kwh, rev AS miner_revenue_btc, "
    + ", ".join(f'kwh * 0.0{c}::DOUBLE / nullif(rev, 0) AS "Electricity_Cost_{c}c"' for c in (3, 4, 5, 6, 7))
    + """, price_close * rev / nullif(kwh, 0) AS power_only_breakeven_tariff_usd_per_kwh,
  kwh * 0.05::DOUBLE * 1.1::DOUBLE / nullif(subsidy_sum_24h, 0) AS "Electricity_Cost_PUE_Subsidy_Only",
  kwh * 0.05::DOUBLE * 1.1::DOUBLE / nullif(subsidy_sum_24h, 0) / 0.6::DOUBLE AS "Bitcoin_Production_Cost" FROM h""",
)
CASES["energy_value"] = Case(
    _energy,
    {
        "entity": "s", "date": "d", "block_reward": "f6", "Hayes_Network_Price_Per_BTC": "f5", "Hayes_Network_Price_Multiple": "f5",
        "Energy_Value": "f8", "Energy_Value_Multiple": "f3", "CM_Energy_Value": "f8",
    },
    ENERGY_SQL + """--body
SELECT *, hayes AS "Hayes_Network_Price_Per_BTC", price_close / nullif(hayes, 0) AS "Hayes_Network_Price_Multiple", ev AS "Energy_Value",
       price_close / nullif(ev, 0) AS "Energy_Value_Multiple", ev AS "CM_Energy_Value" FROM h""",
)
CASES["tariff_scenarios"] = Case(
    lambda s, d: energy.tariff_scenarios(_energy(s, d)),
    {"entity": "s", "date": "d", "tariff": "f2", "expense": "f5"},
    ENERGY_SQL + """--body
SELECT entity, date, tariff, kwh * tariff / nullif(rev, 0) AS expense FROM h, (VALUES (0.03::DOUBLE), (0.04::DOUBLE), (0.05::DOUBLE), (0.06::DOUBLE), (0.07::DOUBLE)) t(tariff)""",
)

# --- segments -------------------------------------------------------------------------------------------------------

CASES["event_schedule"] = Case(
    lambda s, d: segments.schedule(nations(s, d), EVENTS, STEP),
    {"entity": "s", "position": "i", "event_date": "d"},
    NATIONS + f"""e AS (SELECT entity, max(date) AS through FROM panel GROUP BY 1),
proj AS (SELECT entity, 4 + k AS position, DATE '1998-11-02' + {STEP} * (k + 1)::INT AS event_date, through FROM e, generate_series(0, 20) t(k)),
--body
SELECT entity, position, event_date FROM e, (VALUES (0, DATE '{EVENTS[0]}'), (1, DATE '{EVENTS[1]}'), (2, DATE '{EVENTS[2]}'), (3, DATE '{EVENTS[3]}')) v(position, event_date)
UNION ALL SELECT entity, position, event_date FROM proj WHERE event_date - {STEP} <= through""",
)
CASES["step_schedule"] = Case(
    lambda s, d: panel(s, d).select("entity", "date", segments.step_value(F.col("date"), EVENTS, STEP).alias("reward")),
    {"entity": "s", "date": "d", "reward": "f6"},
    ENERGY_SQL + "--body\nSELECT entity, date, block_reward AS reward FROM e",
)
WINDOWS_SQL = "wins(cycle, a, b) AS (VALUES " + ", ".join(
    f"('{n}', DATE '{a}', {f"DATE '{b}'" if b else "DATE '9999-01-01'"})" for n, a, b in DRAWDOWNS
) + "),\n"
CASES["drawdowns"] = Case(
    lambda s, d: segments.drawdowns(panel(s, d), "price", DRAWDOWNS),
    {"entity": "s", "days_since_ath": "i", "drawdown_pct": "f6", "Cycle": "s"},
    PANEL + WINDOWS_SQL + """--body
SELECT entity, date - a AS days_since_ath, (price / max(price) OVER (PARTITION BY entity, cycle ORDER BY date) - 1) * 100 AS drawdown_pct, cycle AS "Cycle"
FROM panel JOIN wins ON date BETWEEN a AND b""",
)
CYCLE_SQL = "cyc(cycle, a, b) AS (VALUES " + ", ".join(
    f"('Market Cycle {i + 1}', DATE '{a}', DATE '{CYCLES[i + 1] if i + 1 < len(CYCLES) else '9999-01-01'}')" for i, a in enumerate(CYCLES)
) + "),\n"
CASES["cycle_lows"] = Case(
    lambda s, d: segments.cycle_lows(panel(s, d), "price", CYCLES),
    {"entity": "s", "days_since_cycle_low": "i", "index_value": "f8", "Cycle": "s"},
    PANEL + CYCLE_SQL + """rows AS (SELECT * FROM panel JOIN cyc ON date >= a AND date < b),
low AS (SELECT entity, cycle, date AS low_date, price AS low FROM rows WHERE price > 0
  QUALIFY row_number() OVER (PARTITION BY entity, cycle ORDER BY price, date) = 1),
--body
SELECT r.entity, r.date - l.low_date AS days_since_cycle_low, r.price / l.low AS index_value, r.cycle AS "Cycle"
FROM rows r JOIN low l ON l.entity = r.entity AND l.cycle = r.cycle AND r.date >= l.low_date""",
)
CASES["event_eras"] = Case(
    lambda s, d: segments.eras(panel(s, d), "price", EVENTS, STEP),
    {"entity": "s", "days_since_halving": "i", "index_value": "f8", "Era": "s"},
    PANEL + f"""starts AS (SELECT 0 AS p, DATE '{EVENTS[0]}' AS a UNION ALL SELECT 1, DATE '{EVENTS[1]}' UNION ALL SELECT 2, DATE '{EVENTS[2]}'
  UNION ALL SELECT 3 + k, DATE '{EVENTS[3]}' + {STEP} * k::INT FROM generate_series(0, 6) t(k)),
rows AS (SELECT n.*, s.p, s.a FROM panel n ASOF JOIN starts s ON s.a <= n.date),
--body
SELECT r.entity, r.date - r.a AS days_since_halving, r.price / o.price AS index_value,
       CASE r.p WHEN 0 THEN 'Genesis Era' WHEN 1 THEN '2nd Era' WHEN 2 THEN '3rd Era' ELSE (r.p + 1) || 'th Era' END AS "Era"
FROM rows r JOIN panel o ON o.entity = r.entity AND o.date = r.a AND o.price > 0""",
)

# --- shares ---------------------------------------------------------------------------------------------------------


def share_inputs(spark, sf):
    """Per brand: monthly mean retail price as close, monthly order lines as share counts, and two splits per brand.

    A split doubles (or triples) the reported counts from its month on; every month also has an earlier, stale candidate.
    """
    lines = table(spark, sf, "lineitem")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    sold = lines.groupBy("l_partkey", F.trunc("l_shipdate", "month").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    joined = sold.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    base = settle(
        joined.groupBy(F.col("p_brand").alias("entity"), "date").agg(
            (F.sum(F.col("p_retailprice").cast("decimal(18,2)") * F.col("n")).cast("double") / F.sum("n")).alias("close"),
            F.sum("n").cast("double").alias("n"),
        )
    )
    factor = F.when(F.col("date") >= "1999-02-01", 6.0).when(F.col("date") >= "1997-05-01", 2.0).otherwise(1.0)
    level = (F.lit(100_000.0) + F.col("n")) * factor
    current = base.select("entity", "date", level.alias("shares"), F.lit(1).alias("seq"))
    behind = F.when(F.col("date") == "1997-05-01", 2.0).when(F.col("date") == "1999-02-01", 3.0).otherwise(1.01)
    stale = base.select("entity", "date", (level / behind).alias("shares"), F.lit(0).alias("seq"))
    counts = current.unionByName(stale).withColumn("symbol", F.col("entity"))
    entities = base.select("entity").distinct()
    splits = entities.select(
        "entity",
        F.inline(
            F.array(
                F.struct(F.lit("1997-05-01").cast("date").alias("date"), F.lit(2.0).alias("ratio")),
                F.struct(F.lit("1999-02-01").cast("date").alias("date"), F.lit(3.0).alias("ratio")),
                F.struct(F.lit("1998-01-01").cast("date").alias("date"), F.lit(1.0).alias("ratio")),
            )
        ),
    )
    return base, counts, splits


SHARES_SQL = """base AS (
  SELECT p.p_brand AS entity, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS date,
         CAST(SUM(CAST(p.p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS close, CAST(COUNT(*) AS DOUBLE) AS n
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1, 2),
cnt AS (SELECT entity, date, close, 100000 + n AS unsplit, CASE WHEN date >= DATE '1999-02-01' THEN 6 WHEN date >= DATE '1997-05-01' THEN 2 ELSE 1 END AS factor FROM base),
"""


def _selected(spark, sf):
    _, counts, splits = share_inputs(spark, sf)
    return shares.select_observations(counts.withColumn("alias_position", F.lit(0)), splits)


CASES["share_observations"] = Case(
    _selected,
    {"entity": "s", "date": "d", "shares": "f2"},
    SHARES_SQL + "--body\nSELECT entity, date, unsplit * factor AS shares FROM cnt",
)
def _transitions(spark, sf):
    _, _, splits = share_inputs(spark, sf)
    return shares.split_transitions(_selected(spark, sf), splits)


CASES["split_transitions"] = Case(
    _transitions,
    {"entity": "s", "date": "d", "ratio": "f2", "transition": "d"},
    SHARES_SQL + """steps AS (SELECT entity, date, unsplit * factor / lag(unsplit * factor) OVER (PARTITION BY entity ORDER BY date) AS step FROM cnt),
sp AS (SELECT DISTINCT entity, d.date, d.ratio FROM base, (VALUES (DATE '1997-05-01', 2.0::DOUBLE), (DATE '1999-02-01', 3.0::DOUBLE)) d(date, ratio)),
near AS (SELECT sp.entity, sp.date, sp.ratio, s.date AS seen, s.step FROM sp LEFT JOIN steps s ON s.entity = sp.entity AND abs(s.date - sp.date) <= 60 AND s.step IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY sp.entity, sp.date ORDER BY abs(ln(s.step / sp.ratio)), s.date) = 1),
--body
SELECT entity, date, ratio, CASE WHEN abs(step / ratio - 1) <= 0.35 THEN seen ELSE date END AS transition FROM near""",
)
CASES["share_spikes"] = Case(
    lambda s, d: shares.drop_spikes(nations(s, d).select("entity", "date", F.col("price").alias("shares"))),
    {"entity": "s", "date": "d", "shares": "f4"},
    NATIONS + """l AS (SELECT entity, date, price, ln(price) AS x, lag(ln(price)) OVER w AS a, lead(ln(price)) OVER w AS b FROM panel WINDOW w AS (PARTITION BY entity ORDER BY date)),
--body
SELECT entity, date, price AS shares FROM l
WHERE NOT coalesce(abs(x - a) > ln(1.2) AND abs(x - b) > ln(1.2) AND abs(b - a) < ln(1.1), false)""",
)


def _market_cap(spark, sf):
    base, counts, splits = share_inputs(spark, sf)
    listings = (
        table(spark, sf, "part")
        .select(F.col("p_brand").alias("entity"))
        .distinct()
        .withColumns({"cap_first": F.lit(None).cast("double"), "cap_second": F.lit(1234.0)})
    )
    late = counts.filter((F.col("date") >= "1996-01-01") & (F.col("entity") != "Brand#11"))
    fx = base.filter("entity = 'Brand#12'").select(F.lit("XYZUSD").alias("pair"), "date", (F.col("close") / 1000).alias("close"))
    return shares.market_cap(
        listings, base, late, splits, "1995-06-01", "2000-12-31", fx=fx, fx_pairs={"Brand#13": "XYZUSD"}, history_start="1995-09-01"
    )


CASES["market_cap"] = Case(
    _market_cap,
    {"entity": "s", "date": "d", "market_cap": "f1"},
    SHARES_SQL + """days AS (SELECT entity, CAST(unnest(generate_series(DATE '1995-06-01', DATE '2000-12-31', INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT DISTINCT p_brand AS entity FROM part)),
inside AS (SELECT * FROM cnt WHERE date BETWEEN DATE '1995-09-01' AND DATE '2000-12-31'),
adjusted AS (SELECT entity, date, unsplit * 6 AS shares FROM inside WHERE date >= DATE '1996-01-01' AND entity <> 'Brand#11'),
fx AS (SELECT date, close / 1000 AS rate FROM inside WHERE entity = 'Brand#12'),
merged AS (SELECT date, rate FROM fx UNION ALL SELECT date, NULL FROM inside WHERE entity = 'Brand#13' AND date NOT IN (SELECT date FROM fx)),
carried AS (SELECT date, last_value(rate IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS rate FROM merged),
valued AS (SELECT i.entity, i.date, i.close * a.shares * CASE WHEN i.entity = 'Brand#13' THEN f.rate ELSE 1 END AS market_cap
  FROM inside i ASOF JOIN adjusted a ON a.entity = i.entity AND a.date <= i.date LEFT JOIN carried f ON f.date = i.date),
--body
SELECT d.entity, d.date, CASE WHEN d.entity = 'Brand#11' AND d.date = DATE '2000-12-31' THEN 1234.0 ELSE v.market_cap END AS market_cap
FROM days d LEFT JOIN valued v ON v.entity = d.entity AND v.date = d.date""",
)
