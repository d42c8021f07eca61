"""Rolling, cumulative and row-lag functions over a panel.

A rolling value is NULL unless every row of its frame is present and non-NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import col, finite, ratio
from .chunks import KEYS, ORDER, Chunked, Roll, beside, number_rows, running

__all__ = [
    "Roll",
    "cumulative",
    "differences",
    "expanding_mean",
    "lags",
    "log_neighbours",
    "moving_averages",
    "number_rows",
    "returns",
    "rolling",
    "rolling_correlation",
    "volatility",
]


def rolling(panel: DataFrame, specs: Sequence[Roll], keys: Sequence[str] = KEYS, dense: bool = False) -> DataFrame:
    """Rolling mean, sum, std, min, max, median or corr columns over the last n rows.

    Rows are copied between runs and long frames travel through Arrow, so a wide panel is rolled on the columns the
    frames read and joined back on its key.
    """
    inputs = {c for s in specs for c in (s.column, s.other) if c is not None}
    return beside(panel, inputs, lambda narrow: _rolled(narrow, specs, keys, dense), keys)


def _rolled(panel: DataFrame, specs: Sequence[Roll], keys: Sequence[str], dense: bool) -> DataFrame:
    chunks = Chunked(panel, max(s.rows for s in specs) - 1, keys=keys, dense=dense)
    return chunks.owned(chunks.roll(chunks.frame, specs))


def moving_averages(panel: DataFrame, metrics: Sequence[str], windows: Sequence[int] = (7, 30, 365), keys: Sequence[str] = KEYS, dense: bool = False) -> DataFrame:
    """``{n}_day_ma_{metric}`` for every metric and window."""
    return rolling(panel, [Roll(f"{n}_day_ma_{m}", m, n) for n in windows for m in metrics], keys, dense)


def cumulative(panel: DataFrame, columns: Sequence[str], how: str = "sum", suffix: str = "_cum", keys: Sequence[str] = KEYS) -> DataFrame:
    """Running sum, max or min; a NULL row stays NULL while the total continues."""
    out = running(panel, {f"{c}{suffix}": (how, c) for c in columns}, keys)
    return out.withColumns({f"{c}{suffix}": F.when(col(c).isNotNull(), col(f"{c}{suffix}")) for c in columns})


def expanding_mean(panel: DataFrame, columns: Sequence[str], suffix: str = "_mean", keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean of all values so far; also given on NULL rows once a value was seen."""
    return running(panel, {f"{c}{suffix}": ("mean", c) for c in columns}, keys)


def lags(panel: DataFrame, columns: Sequence[str], rows: Sequence[int], keys: Sequence[str] = KEYS, dense: bool = False) -> DataFrame:
    """Values ``n`` ROWS back."""
    chunks = Chunked(panel, max(rows), keys=keys, dense=dense)
    out = chunks.frame.withColumns({f"{c}_lag_{n}": chunks.lag(c, n) for c in columns for n in rows})
    return chunks.owned(out)


def differences(panel: DataFrame, columns: Sequence[str], rows: int, keys: Sequence[str] = KEYS, dense: bool = False) -> DataFrame:
    """Value minus the value ``rows`` rows back."""
    chunks = Chunked(panel, rows, keys=keys, dense=dense)
    return chunks.owned(chunks.frame.withColumns({f"{c}_diff_{rows}": col(c) - chunks.lag(c, rows) for c in columns}))


def returns(panel: DataFrame, columns: Sequence[str], suffix: str = "_return", keys: Sequence[str] = KEYS, dense: bool = False) -> DataFrame:
    """One-row simple return; a NULL on either side gives NULL, gaps are never padded."""
    chunks = Chunked(panel, 1, keys=keys, dense=dense)
    out = chunks.frame.withColumns({f"{c}{suffix}": ratio(c, chunks.lag(c)) - F.lit(1.0) for c in columns})
    return chunks.owned(out)


def log_neighbours(panel: DataFrame, column: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Logarithm of a value and of its neighbours one row back and ahead."""
    chunks = Chunked(panel, 1, ahead=1, keys=keys)
    here = F.ln(col(column))
    out = chunks.frame.withColumns(
        {"ln_value": here, "ln_previous": F.lag(here).over(chunks.window), "ln_following": F.lead(here).over(chunks.window)}
    )
    return chunks.owned(out)


def volatility(panel: DataFrame, column: str, windows: Sequence[int] = (30, 180), days_per_year: int = 365, keys: Sequence[str] = KEYS, dense: bool = False) -> DataFrame:
    """Annualised standard deviation of one-row returns."""
    chunks = Chunked(panel, max(windows), keys=keys, dense=dense)
    frame = chunks.frame.withColumn("_r", ratio(column, chunks.lag(column)) - F.lit(1.0))
    rolled = chunks.roll(frame, [Roll(f"volatility_{n}", "_r", n, "std") for n in windows])
    scale = F.sqrt(F.lit(float(days_per_year)))
    return chunks.owned(rolled.withColumns({f"volatility_{n}": col(f"volatility_{n}") * scale for n in windows})).drop("_r")


def rolling_correlation(panel: DataFrame, column: str, benchmark: str, windows: Sequence[int] = (7, 30, 90, 365), keys: Sequence[str] = KEYS, dense: bool = False) -> DataFrame:
    """Correlation of one-row returns with the benchmark entity's returns on the same dates.

    NULL wherever either side has a NULL return in the window. The benchmark is one series, joined by date.
    """
    leader = panel.filter(col(keys[0]) == F.lit(benchmark)).select(ORDER, col(column).alias("_bench"))
    chunks = Chunked(panel.join(leader, ORDER, "left"), max(windows), keys=keys, dense=dense)
    frame = chunks.frame.withColumns(
        {"_r": finite(ratio(column, chunks.lag(column))) - 1.0, "_b": finite(ratio("_bench", chunks.lag("_bench"))) - 1.0}
    )
    rolled = chunks.roll(frame, [Roll(f"corr_{n}", "_r", n, "corr", "_b") for n in windows])
    return chunks.owned(rolled).drop("_r", "_b", "_bench")
