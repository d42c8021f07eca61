"""Queries of the report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import changes, energy, metrics, models, prepare
from tidemark.plans import returns, tables
from tidemark.session import settle

from .base import AS_OF, CALENDAR, CANDLES, NATIONS, NETWORK, PANEL, candles, full_calendar, nations, nations_with_users, network, panel, table
from .case import Case
from .network import ENERGY_SQL, EVENTS, FIT_SQL, ORIGIN, STEP
from .series import _snap_corr

CASES: dict[str, Case] = {}
FIRST_YEAR = 1996

# --- period returns -------------------------------------------------------------------------------------------------


def _history_sql(period: str) -> str:
    position = "day(date)" if period == "month" else (
        "CASE WHEN month(date) = 2 AND day(date) = 29 THEN NULL WHEN month(date) > 2 AND year(date) % 4 = 0 THEN dayofyear(date) - 1 ELSE dayofyear(date) END"
    )
    where = "AND month(date) = 6" if period == "month" else ""
    return PANEL + f"""p AS (SELECT entity, date, price, year(date) AS year, {position} AS position FROM panel WHERE price > 0 AND date <= DATE '{AS_OF}'),
sel AS (SELECT * FROM p WHERE position IS NOT NULL {where}),
based AS (SELECT s.entity, s.year, s.position, s.price, b.price AS base FROM sel s ASOF JOIN p b ON b.entity = s.entity AND b.date < date_trunc('{period}', s.date)),
cur AS (SELECT entity, max(base) AS current_base FROM based WHERE year = 2000 GROUP BY 1),
hist AS (SELECT b.entity, position, year, price / base * current_base AS value FROM based b JOIN cur USING (entity) WHERE year >= {FIRST_YEAR}
  UNION ALL SELECT DISTINCT b.entity, 0, year, current_base FROM based b JOIN cur USING (entity) WHERE year >= {FIRST_YEAR}),
"""


def _history(period):
    return lambda s, d: returns.indexed_history(panel(s, d), AS_OF, period, "price", FIRST_YEAR)


def _wide(period, name):
    columns = {"entity": "s", name: "i", **{str(y): "f4" for y in range(FIRST_YEAR, 2001)}, "Median": "f4", "Average": "f4"}
    years = ", ".join(f'max(value) FILTER (WHERE year = {y}) AS "{y}"' for y in range(FIRST_YEAR, 2001))
    sql = _history_sql(period) + f"""--body
SELECT entity, position AS {name}, {years}, median(value) FILTER (WHERE year < 2000) AS "Median", avg(value) FILTER (WHERE year < 2000) AS "Average"
FROM hist GROUP BY entity, position"""
    return Case(lambda s, d: returns.indexed_history_wide(panel(s, d), AS_OF, period, "price", FIRST_YEAR), columns, sql)


CASES["indexed_history_mtd"] = _wide("month", "day")
CASES["indexed_history_ytd"] = _wide("year", "day_of_year")
CASES["visible_year_aggregates"] = Case(
    lambda s, d: returns.history_aggregates(_history("year")(s, d), 2000, [1997], 365),
    {"entity": "s", "position": "i", "Median": "f4", "Average": "f4"},
    _history_sql("year") + """--body
SELECT entity, position, median(value) FILTER (WHERE year < 2000 AND year <> 1997) AS "Median", avg(value) FILTER (WHERE year < 2000 AND year <> 1997) AS "Average"
FROM hist WHERE position <= 365 GROUP BY 1, 2""",
)


def _latest_points(spark, sf):
    history = settle(_history("month")(spark, sf))
    return returns.latest_points(history, returns.history_aggregates(history, 2000), 2000)


CASES["latest_points"] = Case(
    _latest_points,
    {"entity": "s", "series": "s", "x": "i", "y": "f4", "label": "s"},
    _history_sql("month") + """agg AS (SELECT entity, position, median(value) FILTER (WHERE year < 2000) AS med, avg(value) FILTER (WHERE year < 2000) AS mean FROM hist GROUP BY 1, 2),
ends AS (SELECT * FROM agg WHERE med IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity ORDER BY position DESC) = 1),
pts AS (SELECT entity, 'current' AS series, position AS x, value AS y FROM hist WHERE year = 2000 QUALIFY row_number() OVER (PARTITION BY entity ORDER BY position DESC) = 1
  UNION ALL SELECT entity, 'median', position, med FROM ends UNION ALL SELECT entity, 'average', position, mean FROM ends),
--body
SELECT *, '$' || format('{:,}', CAST(round(y) AS BIGINT)) AS label FROM pts""",
)

CASES["roi_table"] = Case(
    lambda s, d: returns.roi(nations(s, d), AS_OF, "price"),
    {"entity": "s", "Time Frame": "s", "ROI (%)": "f6", "Start Date": "d", "BTC Price": "f4"},
    NATIONS + f"""newest AS (SELECT entity, date, price FROM panel WHERE date <= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY entity ORDER BY date DESC) = 1),
wanted AS (SELECT entity, price AS now, name, CAST(date - step AS DATE) AS target FROM newest, (VALUES ('1 day', INTERVAL 1 DAY), ('3 day', INTERVAL 3 DAY), ('7 day', INTERVAL 7 DAY),
  ('30 day', INTERVAL 30 DAY), ('90 day', INTERVAL 90 DAY), ('1 Year', INTERVAL 1 YEAR), ('2 Year', INTERVAL 2 YEAR), ('4 Year', INTERVAL 4 YEAR), ('5 Year', INTERVAL 5 YEAR), ('10 Year', INTERVAL 10 YEAR)) t(name, step)),
--body
SELECT w.entity, w.name AS "Time Frame", (w.now / nullif(p.price, 0) - 1) * 100 AS "ROI (%)", coalesce(p.date, w.target) AS "Start Date", p.price AS "BTC Price"
FROM wanted w ASOF LEFT JOIN panel p ON p.entity = w.entity AND p.date <= w.target""",
)


def _heat_sql(first: int) -> str:
    names = [*returns.MONTHS, "Yearly"]
    pivot = ", ".join(f'max(f) FILTER (WHERE cell = {i}) * 100 AS "{n}"' for i, n in enumerate(names, 1))
    return PANEL + f"""p AS (SELECT * FROM panel WHERE price > 0 AND date <= DATE '{AS_OF}'),
lastm AS (SELECT entity, date_trunc('month', date) AS period, month(max(date)) AS cell, arg_max(price, date) AS close FROM p GROUP BY 1, 2),
lasty AS (SELECT entity, date_trunc('year', date) AS period, 13 AS cell, arg_max(price, date) AS close FROM p GROUP BY 1, 2),
cells AS (SELECT c.entity, year(c.period) AS yr, c.cell, c.close / b.price - 1 AS f FROM (SELECT * FROM lastm UNION ALL SELECT * FROM lasty) c
  ASOF JOIN p b ON b.entity = c.entity AND b.date < c.period WHERE year(c.period) >= {first}),
newest AS (SELECT entity, max(date) AS d FROM p GROUP BY 1),
kept AS (SELECT c.* FROM cells c JOIN newest n USING (entity) WHERE NOT (yr = year(d) AND (cell = 13 OR (cell = month(d) AND d <> last_day(d))))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY entity, cell ORDER BY yr DESC) AS rn FROM kept),
stat AS (SELECT entity, cell, avg(f) FILTER (WHERE rn <= 4) AS four, median(f) AS med, avg(f) AS mean FROM ranked GROUP BY 1, 2),
long AS (SELECT entity, CAST(yr AS VARCHAR) AS time, cell, f FROM cells UNION ALL SELECT entity, '4-Year Average', cell, four FROM stat
  UNION ALL SELECT entity, 'Median', cell, med FROM stat UNION ALL SELECT entity, 'Average', cell, mean FROM stat),
heat AS (SELECT entity, time, {pivot} FROM long GROUP BY entity, time),
"""


HEAT_COLUMNS = {"time": "s", **{m: "f6" for m in (*returns.MONTHS, "Yearly")}}
CASES["monthly_heatmap"] = Case(
    lambda s, d: returns.heatmap(panel(s, d), AS_OF, "price", FIRST_YEAR),
    {"entity": "s", **HEAT_COLUMNS},
    _heat_sql(FIRST_YEAR) + "--body\nSELECT * FROM heat",
)


def _comparison_sql(period: str) -> str:
    same = "day(date) = 15" + ("" if period == "month" else " AND month(date) = 6")
    where = "WHERE month(period) = 6" if period == "month" else ""
    return PANEL + f"""p AS (SELECT * FROM panel WHERE price > 0 AND date <= DATE '{AS_OF}'),
per AS (SELECT entity, date_trunc('{period}', date) AS period, arg_max(price, date) AS close, max(price) FILTER (WHERE {same}) AS same FROM p GROUP BY 1, 2),
yrs AS (SELECT r.entity, year(r.period) AS yr, b.price AS base, r.close, (r.close / b.price - 1) * 100 AS full_, (r.same / b.price - 1) * 100 AS todate
  FROM (SELECT * FROM per {where}) r ASOF JOIN p b ON b.entity = r.entity AND b.date < r.period),
med AS (SELECT entity, median(full_) AS mf, median(todate) AS mt FROM yrs WHERE yr < 2000 AND yr >= {FIRST_YEAR} GROUP BY 1),
cmp AS (SELECT entity, '2000' AS "Year", base AS "Start Price ($)", close AS "End Price ($)", full_ AS "Return (%)", todate AS "Report Date Return (%)" FROM yrs WHERE yr = 2000
  UNION ALL SELECT y.entity, 'Median Projection', base, base * (1 + mf / 100), mf, mt FROM yrs y LEFT JOIN med USING (entity) WHERE yr = 2000),
"""


COMPARISON_COLUMNS = {"entity": "s", "Year": "s", "Start Price ($)": "f4", "End Price ($)": "f4", "Return (%)": "f6", "Report Date Return (%)": "f6"}
for _name, _period in (("mtd_comparison", "month"), ("ytd_comparison", "year")):
    CASES[_name] = Case(
        (lambda period: lambda s, d: returns.period_comparison(panel(s, d), AS_OF, period, "price", FIRST_YEAR))(_period),
        COMPARISON_COLUMNS,
        _comparison_sql(_period) + "--body\nSELECT * FROM cmp",
    )

# --- snapshots ------------------------------------------------------------------------------------------------------


def _bucket_sql(size: int, source: str = "panel") -> str:
    return f"""bk AS (SELECT entity, CAST(floor(price / {size}) AS BIGINT) AS b, count(*) AS n FROM {source} WHERE price > 0 AND date <= DATE '{AS_OF}' GROUP BY 1, 2),
curp AS (SELECT entity, arg_max(price, date) AS cur FROM {source} WHERE price > 0 AND date <= DATE '{AS_OF}' GROUP BY 1),
rng AS (SELECT entity, unnest(generate_series(0, max(b))) AS b FROM bk GROUP BY 1),
buckets AS (SELECT r.entity, '$' || (r.b * {size} // 1000) || 'K-$' || ((r.b + 1) * {size} // 1000) || 'K' AS "Price Range ($)", coalesce(bk.n, 0) AS "Count",
  cur >= r.b * {size} AND cur < (r.b + 1) * {size} AS "Is Current Bucket", cur AS "Current Price"
  FROM rng r JOIN curp c USING (entity) LEFT JOIN bk ON bk.entity = r.entity AND bk.b = r.b),
"""


BUCKET_COLUMNS = {"Price Range ($)": "s", "Count": "i", "Is Current Bucket": "b", "Current Price": "f4"}
for _size in (1000, 5000):
    CASES[f"price_buckets_{_size // 1000}k"] = Case(
        (lambda size: lambda s, d: tables.price_buckets(panel(s, d), size, AS_OF, "price"))(_size),
        {"entity": "s", **BUCKET_COLUMNS},
        PANEL + _bucket_sql(_size) + "--body\nSELECT * FROM buckets",
    )


def _intraday_buckets(spark, sf):
    events = table(spark, sf, "events").select(F.col("event_type").alias("entity"), "ts", "event_id", (F.col("value") * 100).alias("price"))
    one = events.groupBy("entity", "ts").agg(F.max("price").alias("price"))
    return tables.price_buckets(one, 5000, "2024-01-20", "price", ts="ts")


CASES["price_buckets_first_of_day"] = Case(
    _intraday_buckets,
    {"entity": "s", **BUCKET_COLUMNS},
    """ev AS (SELECT event_type AS entity, ts, max(value * 100) AS price FROM events GROUP BY 1, 2),
daily AS (SELECT entity, CAST(ts AS DATE) AS date, arg_min(price, ts) AS price FROM ev WHERE price > 0 GROUP BY 1, 2),
""" + _bucket_sql(5000, "daily").replace(AS_OF, "2024-01-20") + "--body\nSELECT * FROM buckets",
)

METRIC_MAP = {"Price": "price", "Volume": "volume", "Users above 300K": "users_c"}
CASES["summary_history"] = Case(
    lambda s, d: tables.summary_history(nations_with_users(s, d).withColumn("users_c", F.when(F.col("users_c") > 0, F.col("users_c"))), AS_OF, METRIC_MAP),
    {"entity": "s", "Metric": "s", "date": "d", "Value": "f4"},
    NATIONS + f"""newest AS (SELECT entity, max(date) AS d FROM panel WHERE date <= DATE '{AS_OF}' GROUP BY 1),
near AS (SELECT p.* FROM panel p JOIN newest n USING (entity) WHERE p.date BETWEEN n.d - 30 AND n.d),
--body
SELECT entity, 'Price' AS "Metric", date, price AS "Value" FROM near UNION ALL SELECT entity, 'Volume', date, volume FROM near
UNION ALL SELECT entity, 'Users above 300K', date, users_c FROM near WHERE users_c > 0""",
)

TEMPLATE = {
    "Activity": {"Price": ("price_close", "currency"), "Users": ("addr_count", "number"), "Volume": ("transfer_volume_sum_24h_usd", "currency")},
    "Security": {"Hash Rate": ("hash_rate", "hashrate_ehs"), "Difficulty": ("difficulty", "difficulty_t"), "Issued": ("inflation_rate", "percent_point"), "Share": ("share", "percent_ratio"), "Velocity": ("velocity", "number2")},
}


def _fundamental_panel(spark, sf):
    gap = F.when(F.dayofmonth("date") < 13, F.col("transfer_volume_sum_24h_usd"))
    return network(spark, sf).withColumns(
        {"transfer_volume_sum_24h_usd": gap, "share": F.col("addr_count") / 7, "velocity": F.col("addr_count") / 0.0007, "hash_rate": F.col("hash_rate") * 1e5}
    )


FUND_KINDS = {
    "price_close": "'$' || format('{:,.0f}', x)", "addr_count": "format('{:,.0f}', x)", "volume": "'$' || format('{:,.0f}', x)", "hash": "format('{:,.2f}', x / 1e18) || ' EH/s'",
    "difficulty": "format('{:,.2f}', x / 1e12) || 'T'", "inflation": "format('{:.2f}', x) || '%'", "share": "format('{:.2f}', x * 100) || '%'", "velocity": "format('{:,.2f}', x)",
}


def _cell(x: str, name: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {e.replace('x', x) if k != 'hash' else e.replace('x / 1e18', x + ' / 1e18')}" for k, e in FUND_KINDS.items())
    return f"coalesce(CASE kind {cases} END, '') AS \"{name}\""


DAYS = tables.WEEKDAYS
CASES["fundamentals_table"] = Case(
    lambda s, d: tables.fundamentals(_fundamental_panel(s, d), TEMPLATE, AS_OF),
    {"entity": "s", "Section": "s", "Metric": "s", "Current Value": "s", "7 Days Ago": "s", "7 Day Change (%)": "f6", **{d: "s" for d in DAYS}, "52W Low": "s", "52W High": "s"},
    NETWORK + f"""src AS (SELECT entity, date, unnest([
  {{'s': 'Activity', 'm': 'Price', 'kind': 'price_close', 'v': price_close}}, {{'s': 'Activity', 'm': 'Users', 'kind': 'addr_count', 'v': addr_count}},
  {{'s': 'Activity', 'm': 'Volume', 'kind': 'volume', 'v': CASE WHEN day(date) < 13 THEN transfer_volume_sum_24h_usd END}}, {{'s': 'Security', 'm': 'Hash Rate', 'kind': 'hash', 'v': hash_rate * 1e5}},
  {{'s': 'Security', 'm': 'Difficulty', 'kind': 'difficulty', 'v': difficulty}}, {{'s': 'Security', 'm': 'Issued', 'kind': 'inflation', 'v': inflation_rate}},
  {{'s': 'Security', 'm': 'Share', 'kind': 'share', 'v': addr_count / 7}}, {{'s': 'Security', 'm': 'Velocity', 'kind': 'velocity', 'v': addr_count / 0.0007}}]) AS e
  FROM net WHERE date <= DATE '{AS_OF}'),
lng AS (SELECT entity, date, e.s AS sec, e.m AS met, e.kind AS kind, e.v AS v FROM src WHERE e.v IS NOT NULL),
wk AS (SELECT entity, date_trunc('week', max(date)) AS w FROM net WHERE date <= DATE '{AS_OF}' GROUP BY 1),
rk AS (SELECT l.*, w, row_number() OVER (PARTITION BY l.entity, met ORDER BY date DESC) AS rn, max(date) OVER (PARTITION BY l.entity, met) AS lastd FROM lng l JOIN wk USING (entity)),
agg AS (SELECT entity, sec, met, kind, arg_max(v, date) AS c0, arg_max(v, date) FILTER (WHERE date <= lastd - 7) AS c7, min(v) FILTER (WHERE rn <= 365) AS lo, max(v) FILTER (WHERE rn <= 365) AS hi,
  {', '.join(f"max(v) FILTER (WHERE date = w + INTERVAL {i} DAY) AS d{i}" for i in range(7))} FROM rk GROUP BY 1, 2, 3, 4),
--body
SELECT entity, sec AS "Section", met AS "Metric", {_cell('c0', 'Current Value')}, {_cell('c7', '7 Days Ago')}, (c0 / nullif(c7, 0) - 1) * 100 AS "7 Day Change (%)",
  {', '.join(_cell(f'd{i}', n) for i, n in enumerate(DAYS))}, {_cell('lo', '52W Low')}, {_cell('hi', '52W High')} FROM agg""",
)


def _summary_panel(spark, sf):
    return network(spark, sf).withColumns(
        {
            "bitcoin_dominance": F.lit(None).cast("double"),
            "fear_greed_value": F.dayofmonth("date").cast("double") * 3,
            "fear_greed_classification": F.when(F.col("entity") == "BUILDING", F.lit("Given")),
            "mvrv_ratio": F.col("market_cap") / F.col("realized_cap"),
        }
    )


CASES["summary_table"] = Case(
    lambda s, d: tables.summary_table(_summary_panel(s, d), AS_OF).withColumn("Text", F.when(F.col("Number").isNull(), F.col("Value"))),
    {"entity": "s", "Metric": "s", "Category": "s", "Number": "f4", "Text": "s"},
    NETWORK + f"""r AS (SELECT *, day(date) * 3.0 AS fg, market_cap / realized_cap AS mvrv FROM net WHERE date <= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY entity ORDER BY date DESC) = 1),
--body
SELECT entity, 'Bitcoin Price USD' AS "Metric", 'Market Data' AS "Category", price_close AS "Number", NULL::VARCHAR AS "Text" FROM r
UNION ALL SELECT entity, 'Bitcoin Marketcap', 'Market Data', market_cap, NULL FROM r
UNION ALL SELECT entity, 'Sats Per Dollar', 'Market Data', 1e8 / price_close, NULL FROM r
UNION ALL SELECT entity, 'Bitcoin Supply', 'On-chain Data', supply, NULL FROM r
UNION ALL SELECT entity, 'Bitcoin Miner Revenue', 'On-chain Data', coinbase_sum_24h_usd, NULL FROM r
UNION ALL SELECT entity, 'Bitcoin Transaction Volume', 'On-chain Data', transfer_volume_sum_24h_usd, NULL FROM r
UNION ALL SELECT entity, 'Bitcoin Dominance', 'Investor Sentiment', NULL, NULL FROM r
UNION ALL SELECT entity, 'Bitcoin Fear & Greed Index', 'Investor Sentiment', fg, NULL FROM r
UNION ALL SELECT entity, 'Bitcoin Market Sentiment', 'Investor Sentiment', NULL,
  CASE WHEN entity = 'BUILDING' THEN 'Given' WHEN fg <= 24 THEN 'Extreme Fear' WHEN fg <= 44 THEN 'Fear' WHEN fg <= 54 THEN 'Neutral' WHEN fg <= 74 THEN 'Greed' ELSE 'Extreme Greed' END FROM r
UNION ALL SELECT entity, 'Bitcoin Valuation', 'Investor Sentiment', NULL, CASE WHEN mvrv < 1 THEN 'Undervalued' WHEN mvrv < 2 THEN 'Fair Value' WHEN mvrv < 3 THEN 'Overvalued' ELSE 'Extremely Overvalued' END FROM r""",
)

ASSETS = [
    ("Equity Market Indexes", "Building - [B]", "BUILDING"),
    ("Equity Market Indexes", "Machinery - [M]", "MACHINERY"),
    ("Sectors", "Building - [B]", "BUILDING"),
    ("Sectors", "Furniture - [F]", "FURNITURE"),
    ("Sectors", "Household - [H]", "HOUSEHOLD"),
    ("Macro Asset Classes", "Building - [B]", "BUILDING"),
    ("Macro Asset Classes", "Automobile - [A]", "AUTOMOBILE"),
    ("Bitcoin Industry Performance", "Building - [B]", "BUILDING"),
    ("Bitcoin Industry Performance", "Tools - [T]", "MACHINERY"),
    ("Bitcoin Industry Performance", "Chairs - [C]", "FURNITURE"),
]


def performance_rows(spark, sf):
    daily = settle(prepare.ffill(full_calendar(spark, sf).select("entity", "date", "price"), ["price"], 5, dense=True))
    snapshot = changes.correlation_snapshot(daily, "price", "BUILDING", AS_OF)
    return tables.performance(daily, ASSETS, AS_OF, snapshot, "price", "BUILDING")


PERF_SQL = CALENDAR + f"""f AS (SELECT entity, date, last_value(price IGNORE NULLS) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS price FROM cal),
lead_rows AS (SELECT date, price / lag(price) OVER (ORDER BY date) - 1 AS b, lag(date) OVER (ORDER BY date) AS prior FROM f WHERE entity = 'BUILDING' AND price IS NOT NULL AND date <= DATE '{AS_OF}'),
numbered AS (SELECT *, row_number() OVER (ORDER BY date DESC) AS back FROM lead_rows),
pairs AS (SELECT c.entity, l.back, c.price / p.price - 1 AS r, l.b FROM numbered l JOIN f c ON c.date = l.date LEFT JOIN f p ON p.entity = c.entity AND p.date = l.prior),
corr AS (SELECT entity, {_snap_corr(90)} FROM pairs GROUP BY entity),
good AS (SELECT * FROM f WHERE price > 0),
chg AS (SELECT x.entity, x.date, x.price, (x.price / lag(x.price, 7) OVER w - 1) * 100 AS c7, (x.price / lag(x.price, 90) OVER w - 1) * 100 AS c90,
  (x.price / m.price - 1) * 100 AS cm, (x.price / y.price - 1) * 100 AS cy FROM f x ASOF LEFT JOIN good m ON m.entity = x.entity AND m.date < date_trunc('month', x.date)
  ASOF LEFT JOIN good y ON y.entity = x.entity AND y.date < date_trunc('year', x.date) WINDOW w AS (PARTITION BY x.entity ORDER BY x.date)),
spread AS (SELECT entity, max(price) AS hi, min(price) AS lo FROM f WHERE date BETWEEN DATE '{AS_OF}' - 365 AND DATE '{AS_OF}' GROUP BY 1),
assets(place, cat, label, entity) AS (VALUES {', '.join(f"({i}, '{c}', '{l}', '{e}')" for i, (c, l, e) in enumerate(ASSETS))}),
perf AS (SELECT place, cat AS "Category", label AS "Asset", price AS "Price", c7 AS "7 Day Return (%)", cm AS "MTD Return (%)", cy AS "YTD Return (%)", c90 AS "90 Day Return (%)",
  hi AS "52 Week High", lo AS "52 Week Low", CASE WHEN a.entity = 'BUILDING' THEN 1.0 ELSE corr_90 END AS "90 Day BTC Correlation"
  FROM assets a JOIN chg ON chg.entity = a.entity AND chg.date = DATE '{AS_OF}' JOIN spread s ON s.entity = a.entity JOIN corr k ON k.entity = a.entity),
"""
PERF_COLUMNS = {
    "Category": "s", "Asset": "s", "Price": "f4", "7 Day Return (%)": "f6", "MTD Return (%)": "f6", "YTD Return (%)": "f6", "90 Day Return (%)": "f6",
    "52 Week High": "f4", "52 Week Low": "f4", "90 Day BTC Correlation": "f6",
}
CASES["performance_rows"] = Case(performance_rows, {"place": "i", **PERF_COLUMNS}, PERF_SQL + "--body\nSELECT * FROM perf")
LATE = [*ASSETS, ("Sectors", "Ghost - [G]", "GHOST")]


def _late_asset(spark, sf):
    """One segment has no rows after May 29, and one configured asset has none at all."""
    daily = prepare.ffill(full_calendar(spark, sf).select("entity", "date", "price"), ["price"], 5, dense=True)
    daily = settle(daily.filter((F.col("entity") != "FURNITURE") | (F.col("date") <= "2000-05-29")))
    return tables.performance(daily, LATE, AS_OF, changes.correlation_snapshot(daily, "price", "BUILDING", AS_OF), "price", "BUILDING")


CASES["performance_late_asset"] = Case(
    _late_asset,
    {"place": "i", **PERF_COLUMNS},
    PERF_SQL + f"""old AS (SELECT max(price) AS hi, min(price) AS lo FROM f WHERE entity = 'FURNITURE' AND date BETWEEN DATE '{AS_OF}' - 365 AND DATE '2000-05-29'),
--body
SELECT place, "Category", "Asset", CASE WHEN NOT e THEN "Price" END AS "Price", CASE WHEN NOT e THEN "7 Day Return (%)" END AS "7 Day Return (%)", CASE WHEN NOT e THEN "MTD Return (%)" END AS "MTD Return (%)",
  CASE WHEN NOT e THEN "YTD Return (%)" END AS "YTD Return (%)", CASE WHEN NOT e THEN "90 Day Return (%)" END AS "90 Day Return (%)", CASE WHEN e THEN hi ELSE "52 Week High" END AS "52 Week High",
  CASE WHEN e THEN lo ELSE "52 Week Low" END AS "52 Week Low", CASE WHEN NOT e THEN "90 Day BTC Correlation" END AS "90 Day BTC Correlation"
FROM (SELECT perf.*, "Asset" IN ('Furniture - [F]', 'Chairs - [C]') AS e FROM perf), old
UNION ALL SELECT {len(ASSETS)}, 'Sectors', 'Ghost - [G]', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL""",
)
COMBINED_SQL = """combined AS (SELECT p.* REPLACE (first_place AS place) FROM (SELECT *, min(place) OVER (PARTITION BY "Asset") AS first_place,
  row_number() OVER (PARTITION BY "Asset" ORDER BY place DESC) AS rn FROM perf) p WHERE rn = 1),
"""
CASES["performance_combined"] = Case(
    lambda s, d: tables.combined_performance(performance_rows(s, d)),
    {"place": "i", **PERF_COLUMNS},
    PERF_SQL + COMBINED_SQL + "--body\nSELECT * FROM combined",
)

CASES["weekly_candles"] = Case(
    lambda s, d: tables.weekly_candles(candles(s, d)),
    {"entity": "s", "Time": "d", "Open": "f4", "High": "f4", "Low": "f4", "Close": "f4"},
    CANDLES + """--body
SELECT entity, date_trunc('week', "Time") AS "Time", arg_min("Open", c."Time") AS "Open", max("High") AS "High", min("Low") AS "Low", arg_max("Close", c."Time") AS "Close"
FROM candles c GROUP BY entity, date_trunc('week', c."Time")""",
)


def _dirty(spark, sf):
    bad = F.when(F.col("Low") < 0.2, F.lit(float("inf"))).when(F.col("High") > 300, None).otherwise(F.col("Open"))
    return candles(spark, sf).withColumn("Open", bad.cast("string"))


CASES["clean_candles"] = Case(
    lambda s, d: tables.clean_candles(_dirty(s, d)),
    {"entity": "s", "Time": "d", "Open": "f4", "High": "f4", "Low": "f4", "Close": "f4"},
    CANDLES + '--body\nSELECT * FROM candles WHERE "Low" >= 0.2 AND "High" <= 300',
)
CASES["candle_summary"] = Case(
    lambda s, d: tables.candle_summary(candles(s, d), "2024-01-20"),
    {
        "entity": "s", "Report Date": "d", "Daily Open": "f4", "Daily High": "f4", "Daily Low": "f4", "Daily Close": "f4", "Week Start": "d", "Week-to-Date Open": "f4",
        "Week-to-Date High": "f4", "Week-to-Date Low": "f4", "Week-to-Date Close": "f4", "Week-to-Date Days": "i",
    },
    CANDLES + """d AS (SELECT * FROM candles WHERE "Time" <= DATE '2024-01-20' QUALIFY row_number() OVER (PARTITION BY entity ORDER BY "Time" DESC) = 1),
--body
SELECT d.entity, d."Time" AS "Report Date", d."Open" AS "Daily Open", d."High" AS "Daily High", d."Low" AS "Daily Low", d."Close" AS "Daily Close", date_trunc('week', d."Time") AS "Week Start",
  arg_min(c."Open", c."Time") AS "Week-to-Date Open", max(c."High") AS "Week-to-Date High", min(c."Low") AS "Week-to-Date Low", d."Close" AS "Week-to-Date Close", count(*) AS "Week-to-Date Days"
FROM d JOIN candles c ON c.entity = d.entity AND c."Time" BETWEEN date_trunc('week', d."Time") AND d."Time" GROUP BY ALL""",
)

# --- exports --------------------------------------------------------------------------------------------------------


def network_models(spark, sf):
    return models.network_models(network(spark, sf), AS_OF, origin=ORIGIN)


USERS = (("Any Balance", "addr_count", "Non-Zero Address Count"), *[(f"{n}+ BTC", f"addrs_over_{c}_sats_addr_count", f"Addresses Holding {n}+ BTC") for n, c in (("0.001", "100k"), ("0.01", "1m"), ("0.1", "10m"))])
MODEL_SQL = FIT_SQL + f"""scales AS (SELECT entity, {', '.join(f"exp(avg(ln(price_close * supply) - 2 * ln({c})) FILTER (WHERE {c} > 0)) AS s{i}" for i, (_, c, _) in enumerate(USERS))} FROM net WHERE date <= DATE '{AS_OF}' GROUP BY 1),
mod AS (SELECT a.*, f.exponent, f.scale, f.scale * power(a.age, f.exponent) AS law, s.s0, s.s1, s.s2, s.s3, s.s0 * power(addr_count, 2) / supply AS met,
  CASE WHEN row_number() OVER w >= 30 THEN avg(hash_rate) OVER (PARTITION BY a.entity ORDER BY a.date ROWS 29 PRECEDING) END AS fast,
  CASE WHEN row_number() OVER w >= 60 THEN avg(hash_rate) OVER (PARTITION BY a.entity ORDER BY a.date ROWS 59 PRECEDING) END AS slow
  FROM age a JOIN fit f ON f.entity = a.entity JOIN scales s ON s.entity = a.entity WINDOW w AS (PARTITION BY a.entity ORDER BY a.date)),
"""
CASES["network_export"] = Case(
    lambda s, d: tables.network_export(network_models(s, d), AS_OF),
    {
        "entity": "s", "date": "d", "BTC Price": "f4", "Bitcoin Market Cap": "f2", "Bitcoin Supply": "f2", **{n: "f0" for _, _, n in USERS},
        **{f"Metcalfe Value ({b})": "f3" for b, _, _ in USERS}, **{f"Metcalfe Scale ({b})": "f2" for b, _, _ in USERS}, "BTC Price / Metcalfe Value": "f8",
        "Power Law Price": "f3", "BTC Price / Power Law Price": "f8", "Days Since Genesis": "f0", "Power Law Exponent": "f8", "Power Law Scale": "f3",
        "Hash Rate (H/s)": "f-2", "Hash Rate 30-Day MA (H/s)": "f-4", "Hash Rate 60-Day MA (H/s)": "f-4", "Hash Ribbon 30D / 60D": "f8", "Hash Ribbon Capitulation": "b",
    },
    MODEL_SQL + f"""--body
SELECT entity, date, price_close AS "BTC Price", market_cap AS "Bitcoin Market Cap", supply AS "Bitcoin Supply", {', '.join(f'{c} AS "{n}"' for _, c, n in USERS)},
  {', '.join(f's{i} * power({c}, 2) / supply AS "Metcalfe Value ({b})", s{i} AS "Metcalfe Scale ({b})"' for i, (b, c, _) in enumerate(USERS))},
  price_close / nullif(met, 0) AS "BTC Price / Metcalfe Value", law AS "Power Law Price", price_close / law AS "BTC Price / Power Law Price", age AS "Days Since Genesis",
  exponent AS "Power Law Exponent", scale AS "Power Law Scale", hash_rate AS "Hash Rate (H/s)", fast AS "Hash Rate 30-Day MA (H/s)", slow AS "Hash Rate 60-Day MA (H/s)",
  fast / slow AS "Hash Ribbon 30D / 60D", CASE WHEN slow <> 0 THEN fast < slow END AS "Hash Ribbon Capitulation" FROM mod WHERE date <= DATE '{AS_OF}' AND price_close > 0""",
)


def electricity(spark, sf):
    cut = F.when(F.dayofmonth("date") != 5, F.col("subsidy_sum_24h"))
    return tables.electricity_export(energy.energy(network(spark, sf).withColumn("subsidy_sum_24h", cut), dates=EVENTS, step_days=STEP), AS_OF)


_POWER = {f"Power Expense ($0.0{c}/kWh)": f"kwh * 0.0{c}::DOUBLE / rev" for c in (3, 4, 5, 6, 7)}
CASES["electricity_export"] = Case(
    electricity,
    {
        "entity": "s", "date": "d", "BTC Price": "f4", "Fleet Efficiency (J/GH)": "f6", "Network Power Draw (W)": "f2", "Daily Electricity Consumption (kWh)": "f4", "Subsidy (BTC)": "f4",
        "Fees (BTC)": "f4", "Miner Revenue (BTC)": "f4", **{n: "f5" for n in _POWER}, "Power-Only Break-Even Tariff ($/kWh)": "f6", "Legacy PUE/Subsidy-Only Cost": "f5",
        "Bitcoin Production Cost": "f5", "Hayes Network Price": "f5", "Energy Value": "f8",
    },
    ENERGY_SQL + f"""--body
SELECT entity, date, price_close AS "BTC Price", cm_efficiency_j_gh AS "Fleet Efficiency (J/GH)", w AS "Network Power Draw (W)", kwh AS "Daily Electricity Consumption (kWh)",
  subsidy_sum_24h AS "Subsidy (BTC)", fees_sum_24h AS "Fees (BTC)", rev AS "Miner Revenue (BTC)", {', '.join(f'{e} AS "{n}"' for n, e in _POWER.items())},
  price_close * rev / kwh AS "Power-Only Break-Even Tariff ($/kWh)", kwh * 0.05::DOUBLE * 1.1::DOUBLE / nullif(subsidy_sum_24h, 0) AS "Legacy PUE/Subsidy-Only Cost",
  kwh * 0.05::DOUBLE * 1.1::DOUBLE / nullif(subsidy_sum_24h, 0) / 0.6::DOUBLE AS "Bitcoin Production Cost", hayes AS "Hayes Network Price", ev AS "Energy Value"
FROM h WHERE day(date) <> 5 AND date <= DATE '{AS_OF}'""",
)


def price_models(spark, sf):
    return price_models_of(network_models(spark, sf))


def price_models_of(modelled):
    modelled = modelled.withColumns({"sth_realized_price": F.col("realized_price") * 1.1, "lth_realized_price": F.col("realized_price") * 0.9})
    return tables.price_model_export(energy.energy(modelled, dates=EVENTS, step_days=STEP), AS_OF)


PRICE_MODEL_SQL = MODEL_SQL + f"""pm AS (SELECT entity, date, price_close AS "BTC Price", hash_rate / 1e9 * cm_efficiency_j_gh * 24 / 1000 * 0.05::DOUBLE / (subsidy_sum_24h + fees_sum_24h) AS "Electricity Cost",
  met AS "Metcalfe Value", law AS "Power Law Price", realized_price * 1.1::DOUBLE AS "STH Realized Price", realized_price * 0.9::DOUBLE AS "LTH Realized Price", realized_price AS "Realized Price",
  realized_price * 3 AS "3x Realized Price" FROM mod WHERE date <= DATE '{AS_OF}'),
"""
CASES["price_model_export"] = Case(
    price_models,
    {"entity": "s", "date": "d", "BTC Price": "f4", "Electricity Cost": "f5", "Metcalfe Value": "f3", "Power Law Price": "f3", "STH Realized Price": "f4", "LTH Realized Price": "f4", "Realized Price": "f4", "3x Realized Price": "f4"},
    PRICE_MODEL_SQL + "--body\nSELECT * FROM pm",
)


def _year_end(spark, sf):
    net = network(spark, sf).withColumn("mvrv_ratio", F.col("market_cap") / F.col("realized_cap"))
    return tables.year_end_table(net, changes.cagr(net, ["price_close", "realized_price"], (4,)), AS_OF)


CASES["year_end_table"] = Case(
    _year_end,
    {"entity": "s", "date": "d", "price_close": "f4", "realized_price": "f4", "mvrv_ratio": "f8", "price_close_4_Year_CAGR": "f6", "realized_price_4_Year_CAGR": "f6"},
    NETWORK + f"""g AS (SELECT entity, date, price_close, realized_price, market_cap / realized_cap AS mvrv_ratio, (power(price_close / lag(price_close, 1460) OVER w, 0.25) - 1) * 100 AS "price_close_4_Year_CAGR",
  (power(realized_price / lag(realized_price, 1460) OVER w, 0.25) - 1) * 100 AS "realized_price_4_Year_CAGR" FROM net WINDOW w AS (PARTITION BY entity ORDER BY date)),
--body
SELECT * FROM g WHERE date <= DATE '{AS_OF}'""",
)

VALUED = [("Bitcoin", "price_close", "market_cap"), ("US M0", "United_States_btc_price", "United_States_cap"), ("Acme", "ACME_mc_btc_price", "ACME_MarketCap"), ("Absent", "none", "none_cap")]


def valuation(spark, sf):
    wide = network(spark, sf).withColumn("ACME_MarketCap", F.col("transfer_volume_sum_24h_usd") * 100)
    full = metrics.asset_parity(metrics.fiat_parity(wide, {"United States": 5.73}), ["ACME"])
    return tables.asset_valuation(full, VALUED, AS_OF)


VALUATION_SQL = NETWORK + f"""r AS (SELECT * FROM net WHERE date <= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY entity ORDER BY date DESC) = 1),
v AS (SELECT entity, price_close AS p, 'Bitcoin' AS "Asset", market_cap AS cap, price_close AS implied FROM r
  UNION ALL SELECT entity, price_close, 'US M0', 5.73::DOUBLE * 1e12, 5.73::DOUBLE * 1e12 / supply FROM r
  UNION ALL SELECT entity, price_close, 'Acme', transfer_volume_sum_24h_usd * 100, transfer_volume_sum_24h_usd * 100 / supply FROM r
  UNION ALL SELECT entity, price_close, 'Absent', NULL, NULL FROM r),
val AS (SELECT entity, "Asset", cap AS "Market Cap (USD)", implied AS "Market Cap BTC Price", (implied - p) / p * 100 AS "BTC % Move to Marketcap BTC Price" FROM v),
"""
CASES["asset_valuation"] = Case(
    valuation,
    {"entity": "s", "Asset": "s", "Market Cap (USD)": "f1", "Market Cap BTC Price": "f3", "BTC % Move to Marketcap BTC Price": "f4"},
    VALUATION_SQL + "--body\nSELECT * FROM val",
)
