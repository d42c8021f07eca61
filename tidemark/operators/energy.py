"""Electricity cost, production cost and energy value of a network."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sql
from ..functions.expressions import positive, ratio
from .chunks import ORDER
from .segments import EVENT_DATES, EVENT_STEP_DAYS, step_value

# Fixed values.
TARIFFS = (0.03, 0.04, 0.05, 0.06, 0.07)
BASE_TARIFF = 0.05
POWER_OVERHEAD = 1.1
POWER_SHARE_OF_COST = 0.6
FIAT_FACTOR = 2.0e-15
SECONDS_PER_DAY = 86_400
SECONDS_PER_YEAR = 365.25 * SECONDS_PER_DAY
HASHES_PER_DIFFICULTY = 2**32


def cents(tariff: float) -> int:
    return int(round(tariff * 100))


def energy(panel: DataFrame, tariffs: Sequence[float] = TARIFFS, base: float = BASE_TARIFF, dates: Sequence[str] = EVENT_DATES, step_days: int = EVENT_STEP_DAYS) -> DataFrame:
    """Row-wise energy models from hash rate, efficiency, difficulty, issuance and price."""
    r, above, price = sql.ratio, sql.positive, "`price_close`"
    power = sql.derive(
        panel.withColumn("block_reward", step_value(F.col(ORDER), dates, step_days)),
        {
            "network_power_watts": "`hash_rate` / 1e9D * `cm_efficiency_j_gh`",
            "daily_electricity_consumption_kwh": "`hash_rate` / 1e9D * `cm_efficiency_j_gh` * 24 / 1000",
            "miner_revenue_btc": "`subsidy_sum_24h` + `fees_sum_24h`",
        },
    )
    kwh, earned = "`daily_electricity_consumption_kwh`", above("`miner_revenue_btc`")
    legacy = r(f"{kwh} * {sql.literal(base)} * {sql.literal(POWER_OVERHEAD)}", above("`subsidy_sum_24h`"))
    expected = r(f"`hash_rate` * {SECONDS_PER_DAY} * `block_reward`", f"`difficulty` * {HASHES_PER_DIFFICULTY}")
    hayes = r(f"{sql.literal(base * 24)} * `cm_efficiency_j_gh` * (`hash_rate` / 1e12D)", above(expected))
    value = f"{r('`hash_rate` / 1e12D * (`cm_efficiency_j_gh` * 1000)', f'`inflation_rate` / 100 / {sql.literal(SECONDS_PER_YEAR)}')} * {sql.literal(FIAT_FACTOR)}"
    # The costs are named columns first, so that their multiples stay small expressions.
    costs = sql.derive(
        power,
        {
            **{f"Electricity_Cost_{cents(t)}c": r(f"{kwh} * {sql.literal(t)}", earned) for t in tariffs},
            "Electricity_Cost": r(f"{kwh} * {sql.literal(base)}", earned),
            "power_only_breakeven_tariff_usd_per_kwh": r(f"{price} * `miner_revenue_btc`", above(kwh)),
            "Electricity_Cost_PUE_Subsidy_Only": legacy,
            "Hayes_Network_Price_Per_BTC": hayes,
            "Energy_Value": value,
        },
    )
    return sql.derive(
        costs,
        {
            "Bitcoin_Production_Cost": f"`Electricity_Cost_PUE_Subsidy_Only` / {sql.literal(POWER_SHARE_OF_COST)}",
            "Hayes_Network_Price_Multiple": r(price, "`Hayes_Network_Price_Per_BTC`"),
            "Energy_Value_Multiple": r(price, "`Energy_Value`"),
            "Lagged_Energy_Value": "`Energy_Value`",
            "CM_Energy_Value": "`Energy_Value`",
        },
    )


def tariff_scenarios(panel: DataFrame, tariffs: Sequence[float] = TARIFFS) -> DataFrame:
    """Long form: one row per (entity, date, tariff) with the power expense per coin earned."""
    rates = F.explode(F.array(*[F.lit(t) for t in tariffs])).alias("tariff")
    rows = panel.select("entity", ORDER, "daily_electricity_consumption_kwh", "miner_revenue_btc", rates)
    return rows.withColumn(
        "expense", ratio(F.col("daily_electricity_consumption_kwh") * F.col("tariff"), positive("miner_revenue_btc"))
    )
