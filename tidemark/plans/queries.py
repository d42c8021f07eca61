"""Reporting queries over published tables.

Every function takes the published tables it reads as DataFrames. A table holds one report per ``entity``; a query answers for
all of them, each from its own rows. ``place`` is the order in which a report shows its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.chunks import KEYS

BENCHMARK = "Bitcoin - [BTC]"

# Headline series of the summary history: view -> (metric, unit, column).
HEADLINES = {
    "btc_price": ("Bitcoin Price USD", 1, "price"),
    "btc_marketcap": ("Bitcoin Marketcap", 1e12, "marketcap"),
    "sats_per_dollar": ("Sats Per Dollar", 1, "sats"),
    "btc_supply": ("Bitcoin Supply", 1, "supply"),
    "btc_miner_revenue": ("Bitcoin Miner Revenue", 1e6, "revenue"),
    "btc_tx_volume": ("Bitcoin Transaction Volume", 1e9, "volume"),
}
SCALARS = {
    "btc_dominance": ("Bitcoin Dominance", "try_cast(Value AS DOUBLE)", "dominance"),
    "btc_sentiment": ("Bitcoin Market Sentiment", "Value", "sentiment"),
    "btc_valuation": ("Bitcoin Valuation", "Value", "valuation"),
}
PERFORMANCE_VIEWS = {
    "equity_perf": "Equity Market Indexes",
    "sector_perf": "Sectors",
    "macro_perf": "Macro Asset Classes",
    "bitcoin_industry_perf": "Bitcoin Industry Performance",
}
MONTHS = "Jan, Feb, Mar, Apr, May, Jun, Jul, Aug, Sep, Oct, Nov, Dec, Yearly"


def _sql(df: DataFrame, text: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    return df.sparkSession.sql(text, args or {}, **tables)


def data_date(summary_history: DataFrame, metric: str = "Bitcoin Price USD") -> DataFrame:
    return _sql(
        summary_history,
        """
        SELECT entity, date_format(max(CAST(date AS DATE)), 'MMMM dd, yyyy') AS date_label,
               date_format(max(CAST(date AS DATE)), 'MMMM') AS month_name,
               date_format(max(CAST(date AS DATE)), 'yyyy') AS year_label
        FROM {t} WHERE Metric = :metric GROUP BY entity
        """,
        {"metric": metric},
        t=summary_history,
    )


def headline(summary_history: DataFrame, metric: str, unit: float = 1, column: str = "price") -> DataFrame:
    """A daily series with its fractional change against exactly 30 days before, newest first."""
    return _sql(
        summary_history,
        f"""
        WITH src AS (
          SELECT entity, CAST(date AS DATE) AS date, Value / CAST(:unit AS DOUBLE) AS {column}
          FROM {{t}} WHERE Metric = :metric
        )
        SELECT cur.entity, cur.date, cur.{column}, (cur.{column} - prior.{column}) / nullif(prior.{column}, 0) AS pct_change
        FROM src cur LEFT JOIN src prior ON prior.entity = cur.entity AND prior.date = date_sub(cur.date, 30)
        ORDER BY cur.entity, cur.date DESC
        """,
        {"metric": metric, "unit": float(unit)},
        t=summary_history,
    )


def scalar(summary_table: DataFrame, name: str) -> DataFrame:
    metric, expression, column = SCALARS[name]
    return _sql(summary_table, f"SELECT entity, {expression} AS {column} FROM {{t}} WHERE Metric = :metric", {"metric": metric}, t=summary_table)


def performance_view(performance_table: DataFrame, category: str, benchmark: str = BENCHMARK, keys: Sequence[str] = ()) -> DataFrame:
    """Assets of a category and the benchmark; benchmark first, then by 7-day return. ``place`` counts from 1.

    ``keys`` name the columns that tell reports apart, where the table holds several.
    """
    by = "".join(f"{k}, " for k in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return _sql(
        performance_table,
        f"""
        SELECT {by}Asset, Price AS price, `7 Day Return (%)` AS return_7d, `MTD Return (%)` AS return_mtd,
               `YTD Return (%)` AS return_ytd, `90 Day Return (%)` AS return_90d,
               row_number() OVER ({part} ORDER BY CASE WHEN Asset = :benchmark THEN 0 ELSE 1 END, `7 Day Return (%)` DESC NULLS LAST, Asset) AS place
        FROM {{t}}
        WHERE Category = :category OR Asset = :benchmark
        ORDER BY {by}place
        """,
        {"category": category, "benchmark": benchmark},
        t=performance_table,
    )


def with_models(onchain_price_models: DataFrame) -> DataFrame:
    """The last four years of model rows and one empty row at the end of the newest year."""
    return _sql(
        onchain_price_models,
        """
        WITH history AS (
          SELECT entity, CAST(date AS DATE) AS date, `BTC Price`, `Electricity Cost` AS `Power Expense ($0.05/kWh)`,
                 `STH Realized Price`, `Realized Price`, `3x Realized Price`
          FROM {t}
        ),
        bounds AS (
          SELECT entity, max(date) AS max_date, date_sub(add_months(trunc(max(date), 'YEAR'), 12), 1) AS year_end FROM history GROUP BY entity
        )
        SELECT h.* FROM history h JOIN bounds b ON b.entity = h.entity WHERE h.date >= add_months(b.max_date, -48)
        UNION ALL
        SELECT entity, year_end, NULL, NULL, NULL, NULL, NULL FROM bounds
        ORDER BY entity, date
        """,
        t=onchain_price_models,
    )


def models_latest(onchain_price_models: DataFrame) -> DataFrame:
    """The newest row with a price as labelled points. Only that row is looked for; the four years are not built."""
    return _sql(
        onchain_price_models,
        """
        WITH latest AS (
          SELECT entity, max_by(struct(CAST(date AS DATE) AS date, `BTC Price`, `Realized Price`, `STH Realized Price`,
                                       `Electricity Cost` AS `Power Expense ($0.05/kWh)`, `3x Realized Price`), CAST(date AS DATE)) AS r
          FROM {t} WHERE `BTC Price` IS NOT NULL GROUP BY entity
        )
        SELECT entity, series, date AS x, y, '$' || format_number(y, 0) AS label
        FROM (SELECT entity, r.* FROM latest) UNPIVOT INCLUDE NULLS (y FOR series IN (
          `BTC Price`, `Realized Price`, `STH Realized Price`, `Power Expense ($0.05/kWh)`, `3x Realized Price`))
        """,
        t=onchain_price_models,
    )


def price_outlook(outlook: DataFrame) -> DataFrame:
    return _sql(
        outlook,
        """
        SELECT label AS name, label || ' - $' || format_number(CAST(price AS DOUBLE), 0) AS label,
               CAST(price AS DOUBLE) AS price, type, color
        FROM {t}
        """,
        t=outlook,
    )


def outlook_cases(outlook: DataFrame) -> DataFrame:
    return _sql(
        outlook,
        """
        SELECT max(CASE WHEN label = 'Bear Case' THEN price END) AS bear,
               max(CASE WHEN label = 'Base Case' THEN price END) AS base,
               max(CASE WHEN label = 'Bull Case' THEN price END) AS bull
        FROM {t}
        """,
        t=outlook,
    )


def relative_value(relative_value_comparison: DataFrame, benchmark: str = "Bitcoin") -> DataFrame:
    """Caps in trillions and the benchmark cap as a percentage of each, the largest cap first. ``place`` counts from 1."""
    return _sql(
        relative_value_comparison,
        """
        WITH parsed AS (
          SELECT entity, Asset, `Market Cap (USD)` / 1e12D AS market_cap, `Market Cap BTC Price` AS implied_price,
                 `BTC % Move to Marketcap BTC Price` AS implied_return
          FROM {t}
        ),
        lead AS (SELECT entity, max(market_cap) AS own FROM parsed WHERE Asset = :benchmark GROUP BY entity)
        SELECT p.entity, Asset, market_cap, implied_price, implied_return,
               CASE WHEN Asset <> :benchmark THEN own / nullif(market_cap, 0) * 100 END AS btc_pct_of_mcap,
               row_number() OVER (PARTITION BY p.entity ORDER BY market_cap DESC NULLS LAST, Asset) AS place
        FROM parsed p LEFT JOIN lead l ON l.entity = p.entity ORDER BY p.entity, place
        """,
        {"benchmark": benchmark},
        t=relative_value_comparison,
    )


def monthly_aggregates(monthly_heatmap_data: DataFrame) -> DataFrame:
    return _sql(
        monthly_heatmap_data,
        f"""
        SELECT h.entity, CASE WHEN h.time = '4-Year Average' THEN '4 Year Avg' ELSE h.time END AS time, {MONTHS},
               CASE h.time WHEN 'Average' THEN 1 WHEN 'Median' THEN 2 ELSE 3 END AS place
        FROM {{t}} h WHERE h.time IN ('Average', 'Median', '4-Year Average')
        ORDER BY h.entity, place
        """,
        t=monthly_heatmap_data,
    )


def monthly_years(monthly_heatmap_data: DataFrame) -> DataFrame:
    """Year rows, newest first; the newest is marked as unfinished. ``place`` counts from 1."""
    return _sql(
        monthly_heatmap_data,
        f"""
        WITH years AS (
          SELECT *, row_number() OVER (PARTITION BY entity ORDER BY try_cast(time AS INT) DESC) AS place
          FROM {{t}} WHERE try_cast(time AS INT) IS NOT NULL)
        SELECT entity, CASE WHEN place = 1 THEN y.time || ' (YTD)' ELSE y.time END AS time, {MONTHS}, place
        FROM years y ORDER BY entity, place
        """,
        t=monthly_heatmap_data,
    )


def bucket_view(buckets: DataFrame, size: int, around: float | None = None, excluded: Sequence[str] = ()) -> DataFrame:
    """Counts split into the current range and the others; a price on a boundary marks both neighbours."""
    keep = "TRUE" if around is None else f"low_bound BETWEEN `Current Price` - {float(around)} AND `Current Price` + {float(around)}"
    return _sql(
        buckets,
        f"""
        WITH parsed AS (
          SELECT entity, `Price Range ($)`, Count, `Current Price`,
                 CAST(replace(replace(split_part(`Price Range ($)`, '-', 1), '$', ''), 'K', '') AS BIGINT) * 1000 AS low_bound
          FROM {{t}}
          WHERE NOT array_contains(:excluded, `Price Range ($)`)
        )
        SELECT entity, `Price Range ($)`,
               CASE WHEN `Current Price` BETWEEN low_bound AND low_bound + {int(size)} THEN Count END AS Current,
               CASE WHEN `Current Price` BETWEEN low_bound AND low_bound + {int(size)} THEN NULL ELSE Count END AS Other
        FROM parsed WHERE {keep}
        """,
        {"excluded": list(excluded) or [""]},
        t=buckets,
    )


def roi_view(roi_table: DataFrame) -> DataFrame:
    return _sql(roi_table, "SELECT entity, `Time Frame` AS time_frame, `ROI (%)` AS roi_pct, `BTC Price` AS start_price FROM {t}", t=roi_table)


def fundamentals_view(fundamentals_table: DataFrame) -> DataFrame:
    return _sql(
        fundamentals_table,
        """
        SELECT entity, Section AS Category, Metric, `Current Value`, `7 Days Ago`, `7 Day Change (%)`, Monday, Tuesday, Wednesday,
               Thursday, Friday, Saturday, Sunday, `52W Low`, `52W High`
        FROM {t}
        """,
        t=fundamentals_table,
    )


def history_view(history: DataFrame, position: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Year columns only, in position order; the stored aggregates are left out."""
    return history.drop("Median", "Average").orderBy(*keys, F.col(position).cast("int"))
