"""The reporting queries over published tables, one report per segment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import queries, returns, tables

from . import reports
from .base import AS_OF, NETWORK, PANEL, network, panel
from .case import Case

CASES: dict[str, Case] = {}
ONE = "BUILDING"

# --- headline series ------------------------------------------------------------------------------------------------


def _headline_history(spark, sf):
    series = network(spark, sf).withColumn("sat_per_dollar", F.lit(1e8) / F.col("price_close"))
    return tables.summary_history(series, AS_OF, {metric: tables.SUMMARY_METRICS[metric] for metric, _, _ in queries.HEADLINES.values()}, 60)


HISTORY_SQL = NETWORK + f"""newest AS (SELECT entity, max(date) AS d FROM net WHERE date <= DATE '{AS_OF}' GROUP BY 1),
near AS (SELECT net.* FROM net JOIN newest USING (entity) WHERE date BETWEEN d - 60 AND d),
hist AS (SELECT entity, 'Bitcoin Price USD' AS metric, date, price_close AS v FROM near UNION ALL SELECT entity, 'Bitcoin Marketcap', date, market_cap FROM near
  UNION ALL SELECT entity, 'Bitcoin Supply', date, supply FROM near UNION ALL SELECT entity, 'Sats Per Dollar', date, 1e8 / price_close FROM near
  UNION ALL SELECT entity, 'Bitcoin Miner Revenue', date, coinbase_sum_24h_usd FROM near WHERE coinbase_sum_24h_usd IS NOT NULL
  UNION ALL SELECT entity, 'Bitcoin Transaction Volume', date, transfer_volume_sum_24h_usd FROM near WHERE transfer_volume_sum_24h_usd IS NOT NULL),
"""
CASES["query_data_date"] = Case(
    lambda s, d: queries.data_date(_headline_history(s, d)),
    {"entity": "s", "date_label": "s", "month_name": "s", "year_label": "s"},
    HISTORY_SQL + """--body
SELECT entity, strftime(max(date), '%B %d, %Y') AS date_label, strftime(max(date), '%B') AS month_name, strftime(max(date), '%Y') AS year_label
FROM hist WHERE metric = 'Bitcoin Price USD' GROUP BY entity""",
)
for _name, (_metric, _unit, _column) in queries.HEADLINES.items():
    _digits = {1: "f4", 1e6: "f8", 1e9: "f10", 1e12: "f10"}[_unit]
    CASES[f"query_{_name}"] = Case(
        (lambda m, u, c: lambda s, d: queries.headline(_headline_history(s, d), m, u, c))(_metric, _unit, _column),
        {"entity": "s", "date": "d", _column: _digits, "pct_change": "f8"},
        HISTORY_SQL + f"""--body
SELECT c.entity, c.date, c.v / {_unit:.0f}::DOUBLE AS {_column}, (c.v - p.v) / nullif(p.v, 0) AS pct_change
FROM hist c LEFT JOIN hist p ON p.entity = c.entity AND p.metric = c.metric AND p.date = c.date - INTERVAL 30 DAY WHERE c.metric = '{_metric}'""",
    )


def _summary(spark, sf):
    given = reports._summary_panel(spark, sf).withColumn("bitcoin_dominance", F.dayofmonth("date") * 2.5)
    return tables.summary_table(given, AS_OF)


def _scalars(spark, sf):
    summary = _summary(spark, sf)
    parts = [queries.scalar(summary, f"btc_{n}") for n in ("valuation", "sentiment", "dominance")]
    return parts[0].join(parts[1], "entity").join(parts[2], "entity")


CASES["query_scalars"] = Case(
    _scalars,
    {"entity": "s", "valuation": "s", "sentiment": "s", "dominance": "f4"},
    NETWORK + f"""r AS (SELECT entity, market_cap / realized_cap AS m, day(date) * 3.0 AS fg, day(date) * 2.5 AS dom FROM net WHERE date <= DATE '{AS_OF}'
  QUALIFY row_number() OVER (PARTITION BY entity ORDER BY date DESC) = 1),
--body
SELECT entity, CASE WHEN m < 1 THEN 'Undervalued' WHEN m < 2 THEN 'Fair Value' WHEN m < 3 THEN 'Overvalued' ELSE 'Extremely Overvalued' END AS valuation,
  CASE WHEN entity = 'BUILDING' THEN 'Given' WHEN fg <= 24 THEN 'Extreme Fear' WHEN fg <= 44 THEN 'Fear' WHEN fg <= 54 THEN 'Neutral' WHEN fg <= 74 THEN 'Greed' ELSE 'Extreme Greed' END AS sentiment,
  dom AS dominance FROM r""",
)

# --- performance, models, outlook, valuation ------------------------------------------------------------------------


def _performance(spark, sf):
    return tables.combined_performance(reports.performance_rows(spark, sf)).drop("place")


PERFORMANCE_COLUMNS = {"place": "i", "Asset": "s", "price": "f4", "return_7d": "f6", "return_mtd": "f6", "return_ytd": "f6", "return_90d": "f6"}
for _name, _category in queries.PERFORMANCE_VIEWS.items():
    CASES[f"query_{_name}"] = Case(
        (lambda c: lambda s, d: queries.performance_view(_performance(s, d), c, "Building - [B]"))(_category),
        PERFORMANCE_COLUMNS,
        reports.PERF_SQL + reports.COMBINED_SQL + f"""--body
SELECT row_number() OVER (ORDER BY CASE WHEN "Asset" = 'Building - [B]' THEN 0 ELSE 1 END, "7 Day Return (%)" DESC NULLS LAST, "Asset") AS place,
  "Asset", "Price" AS price, "7 Day Return (%)" AS return_7d, "MTD Return (%)" AS return_mtd, "YTD Return (%)" AS return_ytd, "90 Day Return (%)" AS return_90d
FROM combined WHERE "Category" = '{_category}' OR "Asset" = 'Building - [B]'""",
    )

MODEL_SQL = reports.PRICE_MODEL_SQL + """b AS (SELECT entity, max(date) AS m FROM pm GROUP BY 1),
wm AS (SELECT pm.entity, date, "BTC Price", "Electricity Cost" AS "Power Expense ($0.05/kWh)", "STH Realized Price", "Realized Price", "3x Realized Price"
  FROM pm JOIN b USING (entity) WHERE date >= m - INTERVAL 4 YEAR
  UNION ALL SELECT entity, date_trunc('year', m) + INTERVAL 1 YEAR - INTERVAL 1 DAY, NULL, NULL, NULL, NULL, NULL FROM b),
"""
CASES["query_price_with_models"] = Case(
    lambda s, d: queries.with_models(reports.price_models(s, d)),
    {"entity": "s", "date": "d", "BTC Price": "f4", "Power Expense ($0.05/kWh)": "f5", "STH Realized Price": "f4", "Realized Price": "f4", "3x Realized Price": "f4"},
    MODEL_SQL + "--body\nSELECT * FROM wm",
)
CASES["query_models_latest"] = Case(
    lambda s, d: queries.models_latest(reports.price_models(s, d)),
    {"entity": "s", "series": "s", "x": "d", "y": "f4", "label": "s"},
    MODEL_SQL + """l AS (SELECT * FROM wm WHERE "BTC Price" IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity ORDER BY date DESC) = 1),
u AS (SELECT entity, 'BTC Price' AS series, date AS x, "BTC Price" AS y FROM l UNION ALL SELECT entity, 'Realized Price', date, "Realized Price" FROM l
  UNION ALL SELECT entity, 'STH Realized Price', date, "STH Realized Price" FROM l
  UNION ALL SELECT entity, 'Power Expense ($0.05/kWh)', date, "Power Expense ($0.05/kWh)" FROM l UNION ALL SELECT entity, '3x Realized Price', date, "3x Realized Price" FROM l),
--body
SELECT entity, series, x, y, '$' || format('{:,.0f}', y) AS label FROM u""",
)


def _outlook(spark, sf):
    """Price levels from the segments: the highest and lowest price of each as cases; those of one are the named cases."""
    rows = panel(spark, sf).groupBy("entity").agg(F.max("price").alias("hi"), F.min("price").alias("lo"))
    level = lambda name, price, kind: F.struct(name.alias("label"), F.floor(price).cast("string").alias("price"), F.lit(kind).alias("type"), F.lit("#9ca3af").alias("color"))
    own = F.col("entity") == ONE
    cases = F.array(
        level(F.when(own, F.lit("Bull Case")).otherwise(F.concat(F.lit("High "), "entity")), F.col("hi"), "case"),
        level(F.when(own, F.lit("Bear Case")).otherwise(F.concat(F.lit("Low "), "entity")), F.col("lo"), "case"),
    )
    return rows.select(F.inline(cases))


OUTLOOK_SQL = PANEL + f"""lv AS (SELECT CASE WHEN entity = '{ONE}' THEN 'Bull Case' ELSE 'High ' || entity END AS name, floor(max(price)) AS price FROM panel GROUP BY entity
  UNION ALL SELECT CASE WHEN entity = '{ONE}' THEN 'Bear Case' ELSE 'Low ' || entity END, floor(min(price)) FROM panel GROUP BY entity),
"""
CASES["query_price_outlook"] = Case(
    lambda s, d: queries.price_outlook(_outlook(s, d)),
    {"name": "s", "label": "s", "price": "f0", "type": "s"},
    OUTLOOK_SQL + "--body\nSELECT name, name || ' - $' || format('{:,.0f}', price) AS label, price, 'case' AS type FROM lv",
)
CASES["query_outlook_cases"] = Case(
    lambda s, d: queries.outlook_cases(_outlook(s, d)).select(F.col("bear").cast("double").alias("bear"), F.col("base").cast("double").alias("base"), F.col("bull").cast("double").alias("bull")),
    {"bear": "f0", "base": "f0", "bull": "f0"},
    OUTLOOK_SQL + "--body\nSELECT max(price) FILTER (WHERE name = 'Bear Case') AS bear, NULL::DOUBLE AS base, max(price) FILTER (WHERE name = 'Bull Case') AS bull FROM lv",
)

CASES["query_relative_value"] = Case(
    lambda s, d: queries.relative_value(reports.valuation(s, d)),
    {"entity": "s", "place": "i", "Asset": "s", "market_cap": "f8", "implied_price": "f3", "implied_return": "f4", "btc_pct_of_mcap": "f8"},
    reports.VALUATION_SQL + """o AS (SELECT *, "Market Cap (USD)" / 1e12 AS mc FROM val),
--body
SELECT o.entity, row_number() OVER (PARTITION BY o.entity ORDER BY mc DESC NULLS LAST, "Asset") AS place, "Asset", mc AS market_cap, "Market Cap BTC Price" AS implied_price,
       "BTC % Move to Marketcap BTC Price" AS implied_return,
       CASE WHEN "Asset" <> 'Bitcoin' THEN (SELECT max(l.mc) FROM o l WHERE l."Asset" = 'Bitcoin' AND l.entity = o.entity) / nullif(mc, 0) * 100 END AS btc_pct_of_mcap FROM o""",
)

# --- heatmap, buckets, tables ---------------------------------------------------------------------------------------


def _heat(spark, sf):
    return returns.heatmap(panel(spark, sf), AS_OF, "price", reports.FIRST_YEAR)


HEAT = reports._heat_sql(reports.FIRST_YEAR)
HEAT_VIEW = {"entity": "s", "place": "i", **reports.HEAT_COLUMNS}
CASES["query_monthly_aggregates"] = Case(
    lambda s, d: queries.monthly_aggregates(_heat(s, d)),
    HEAT_VIEW,
    HEAT + """--body
SELECT * REPLACE (CASE time WHEN '4-Year Average' THEN '4 Year Avg' ELSE time END AS time), CASE time WHEN 'Average' THEN 1 WHEN 'Median' THEN 2 ELSE 3 END AS place
FROM heat WHERE time IN ('Average', 'Median', '4-Year Average')""",
)
CASES["query_monthly_years"] = Case(
    lambda s, d: queries.monthly_years(_heat(s, d)),
    HEAT_VIEW,
    HEAT + """--body
SELECT * REPLACE (CASE time WHEN '2000' THEN '2000 (YTD)' ELSE time END AS time), 2001 - CAST(time AS INTEGER) AS place FROM heat WHERE try_cast(time AS INTEGER) IS NOT NULL""",
)
for _table, _size, _around, _skip in (("1k_bucket_table", 1000, 12000, ()), ("5k_bucket_table", 5000, None, ("$0K-$5K", "$5K-$10K"))):
    _keep = f'AND low BETWEEN "Current Price" - {_around} AND "Current Price" + {_around}' if _around else f"""AND "Price Range ($)" NOT IN ('$0K-$5K', '$5K-$10K')"""
    CASES[f"query_bucket_{_size // 1000}k"] = Case(
        (lambda z, a, k: lambda s, d: queries.bucket_view(tables.price_buckets(panel(s, d), z, AS_OF, "price"), z, a, k))(_size, _around, _skip),
        {"entity": "s", "Price Range ($)": "s", "Current": "f0", "Other": "f0"},
        PANEL + reports._bucket_sql(_size) + f"""p AS (SELECT *, CAST(replace(replace(split_part("Price Range ($)", '-', 1), '$', ''), 'K', '') AS INTEGER) * 1000 AS low FROM buckets),
--body
SELECT entity, "Price Range ($)", CASE WHEN "Current Price" BETWEEN low AND low + {_size} THEN "Count" END AS "Current",
       CASE WHEN "Current Price" BETWEEN low AND low + {_size} THEN NULL ELSE "Count" END AS "Other" FROM p WHERE true {_keep}""",
    )

CASES["query_roi"] = Case(
    lambda s, d: queries.roi_view(returns.roi(panel(s, d), AS_OF, "price")),
    {"entity": "s", "time_frame": "s", "roi_pct": "f6", "start_price": "f4"},
    reports.CASES["roi_table"].sql.replace("t.n_name AS entity", "c.c_mktsegment AS entity").replace("JOIN nation t ON c.c_nationkey = t.n_nationkey", "").replace(
        'w.name AS "Time Frame"', "w.name AS time_frame"
    ).replace('AS "ROI (%)"', "AS roi_pct").replace('AS "BTC Price"', "AS start_price"),
)
CASES["query_fundamentals"] = Case(
    lambda s, d: queries.fundamentals_view(tables.fundamentals(reports._fundamental_panel(s, d), reports.TEMPLATE, AS_OF)),
    {"entity": "s", "Category": "s", "Metric": "s", "Current Value": "s", "7 Days Ago": "s", "Monday": "s", "Sunday": "s", "52W High": "s"},
    reports.CASES["fundamentals_table"].sql.replace('sec AS "Section"', 'sec AS "Category"'),
)
for _period, _name, _position in (("month", "mtd", "day"), ("year", "ytd", "day_of_year")):
    _case = reports.CASES[f"indexed_history_{_name}"]
    CASES[f"query_{_name}_history"] = Case(
        (lambda p, c: lambda s, d: queries.history_view(returns.indexed_history_wide(panel(s, d), AS_OF, p, "price", reports.FIRST_YEAR), c))(_period, _position),
        {c: k for c, k in _case.columns.items() if c not in ("Median", "Average")},
        _case.sql,
    )
