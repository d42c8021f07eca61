"""Fitted network models: price on age in log-log space, network value on users squared, and hash ribbons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sql
from ..functions.expressions import col, positive, ratio
from .chunks import KEYS, ORDER, Roll
from .windows import rolling

# First day of the age axis, user bands and their output suffixes, ribbon windows.
ORIGIN = "2009-01-03"
BANDS = {
    "addr_count": "any_balance",
    "addrs_over_100k_sats_addr_count": "0p001_btc",
    "addrs_over_1m_sats_addr_count": "0p01_btc",
    "addrs_over_10m_sats_addr_count": "0p1_btc",
}
FAST, SLOW = 30, 60


def _age(origin: str) -> Column:
    return F.datediff(F.col(ORDER), F.lit(origin).cast("date")).cast("double")


def _in_fit(fit_end) -> Column:
    return F.lit(True) if fit_end is None else F.col(ORDER) <= F.lit(fit_end).cast("date")


def power_law_fit(panel: DataFrame, fit_end=None, price: str = "price_close", origin: str = ORIGIN, keys: Sequence[str] = KEYS) -> DataFrame:
    """(entity, exponent, scale, rows) of ln(price) on ln(age); fewer than two usable rows leave NULL coefficients."""
    x, y = F.ln(positive(_age(origin))), F.ln(positive(price))
    used = panel.filter(_in_fit(fit_end)).select(*keys, x.alias("_x"), y.alias("_y")).filter("_x IS NOT NULL AND _y IS NOT NULL")
    return used.groupBy(*keys).agg(
        F.regr_slope("_y", "_x").alias("power_law_exponent"),
        F.exp(F.regr_intercept("_y", "_x")).alias("power_law_scale"),
        F.count(F.lit(1)).alias("fit_rows"),
    )


def fit_power_law(panel: DataFrame, fit_end=None, price: str = "price_close", origin: str = ORIGIN, keys: Sequence[str] = KEYS) -> DataFrame:
    """Fit on rows up to ``fit_end``, evaluate on all rows of positive age."""
    return apply_power_law(panel, power_law_fit(panel, fit_end, price, origin, keys), price, origin, keys)


def apply_power_law(panel: DataFrame, fitted: DataFrame, price: str = "price_close", origin: str = ORIGIN, keys: Sequence[str] = KEYS) -> DataFrame:
    joined = panel.withColumn("days_since_genesis", _age(origin)).join(fitted.drop("fit_rows"), list(keys), "left")
    model = F.col("power_law_scale") * F.pow(positive("days_since_genesis"), F.col("power_law_exponent"))
    return joined.withColumn("power_law_price", model).withColumn(
        "power_law_price_multiple", ratio(price, positive("power_law_price"))
    )


def metcalfe_fit(panel: DataFrame, fit_end=None, bands: Mapping[str, str] = BANDS, price: str = "price_close", supply: str = "supply", keys: Sequence[str] = KEYS) -> DataFrame:
    """(entity, one scale per band): exp of the mean of ln(price x supply) - 2 ln(n) over positive rows."""
    value = F.ln(positive(col(price) * col(supply)))
    held = positive(supply).isNotNull()
    logs = [F.when(held, value - 2 * F.ln(positive(n))) for n in bands]
    scales = [F.exp(F.avg(x)).alias(f"metcalfe_scale_{suffix}") for x, suffix in zip(logs, bands.values())]
    return panel.filter(_in_fit(fit_end)).groupBy(*keys).agg(*scales)


def fit_metcalfe(panel: DataFrame, fit_end=None, bands: Mapping[str, str] = BANDS, price: str = "price_close", supply: str = "supply", keys: Sequence[str] = KEYS) -> DataFrame:
    """Value per coin, scale x n^2 / supply, for every band; the first band gives the headline value and multiple."""
    return apply_metcalfe(panel, metcalfe_fit(panel, fit_end, bands, price, supply, keys), bands, price, supply, keys)


def apply_metcalfe(panel: DataFrame, scales: DataFrame, bands: Mapping[str, str] = BANDS, price: str = "price_close", supply: str = "supply", keys: Sequence[str] = KEYS) -> DataFrame:
    joined = panel.join(scales, list(keys), "left")
    values = {
        f"metcalfe_value_{suffix}": ratio(F.col(f"metcalfe_scale_{suffix}") * F.pow(col(n), F.lit(2)), positive(supply))
        for n, suffix in bands.items()
    }
    headline = f"metcalfe_value_{next(iter(bands.values()))}"
    out = joined.withColumns(values).withColumn("metcalfe_value", F.col(headline))
    return out.withColumn("metcalfe_price_multiple", ratio(price, positive("metcalfe_value")))


def ribbons(panel: DataFrame, column: str = "hash_rate", fast: int = FAST, slow: int = SLOW, keys: Sequence[str] = KEYS, dense: bool = False) -> DataFrame:
    """Fast and slow means, their ratio, and fast < slow where both are known and slow is not zero."""
    quick, calm = f"{fast}_day_ma_{column}", f"{slow}_day_ma_{column}"
    rolled = rolling(panel.drop(quick, calm), [Roll(quick, column, fast), Roll(calm, column, slow)], keys, dense)
    return rolled.withColumns(
        {
            "hash_ribbon_ratio": ratio(quick, calm),
            "hash_ribbon_capitulation": F.when(col(quick).isNotNull() & (col(calm) != 0), col(quick) < col(calm)),
        }
    )


def network_models(panel: DataFrame, fit_end=None, keys: Sequence[str] = KEYS, origin: str = ORIGIN) -> DataFrame:
    """Power law, user-squared values and ribbons; required columns are checked first.

    All fits come from one pass over the rows up to ``fit_end`` and are joined back once, one row per network.
    """
    required = {"price_close", "market_cap", "supply", "hash_rate", *BANDS}
    missing = sorted(required.difference(panel.columns))
    if missing:
        raise ValueError(f"network models need columns: {missing}")
    price, supply, q, ratio_ = "`price_close`", "`supply`", sql.q, sql.ratio
    age = f"CAST(datediff(`{ORDER}`, DATE '{origin}') AS DOUBLE)"
    in_fit = "true" if fit_end is None else f"`{ORDER}` <= DATE '{fit_end}'"
    both = f"{in_fit} AND {sql.positive(age)} IS NOT NULL AND {sql.positive(price)} IS NOT NULL"
    x, y = f"CASE WHEN {both} THEN ln({age}) END", f"CASE WHEN {both} THEN ln({price}) END"
    value = sql.positive(f"({price} * {supply})")
    held = f"{in_fit} AND {sql.positive(supply)} IS NOT NULL"
    fits = panel.groupBy(*keys).agg(
        *map(
            F.expr,
            [
                f"regr_slope({y}, {x}) AS power_law_exponent",
                f"exp(regr_intercept({y}, {x})) AS power_law_scale",
                *[f"exp(avg(CASE WHEN {held} THEN ln({value}) - 2 * ln({sql.positive(q(n))}) END)) AS metcalfe_scale_{suffix}" for n, suffix in BANDS.items()],
            ],
        )
    )
    made = {"power_law_exponent", "power_law_scale", *[f"metcalfe_scale_{suffix}" for suffix in BANDS.values()]}
    rolled = ribbons(panel.drop(*made), keys=keys)
    values = {f"metcalfe_value_{suffix}": ratio_(f"`metcalfe_scale_{suffix}` * pow({q(n)}, 2D)", sql.positive(supply)) for n, suffix in BANDS.items()}
    headline = next(iter(values.values()))
    law = f"`power_law_scale` * pow({sql.positive(age)}, `power_law_exponent`)"
    return sql.derive(
        rolled.join(fits, list(keys), "left"),
        {
            "days_since_genesis": age,
            "power_law_price": law,
            "power_law_price_multiple": ratio_(price, sql.positive(f"({law})")),
            **values,
            "metcalfe_value": headline,
            "metcalfe_price_multiple": ratio_(price, sql.positive(headline)),
        },
    )
